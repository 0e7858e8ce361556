"""Descriptors of the things to keep in step: tables and topics."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import Column, functions as F

# Fields of a table job and of a stream job, in record order.
TABLE_FIELDS = (
    "host port user password db table alias bookmark primaryKey conntype fullTableSchema "
    "numOfPartitions toDruid druidMetrics druidDims runFrequency treatment"
).split()
STREAM_FIELDS = (
    "cluster topic alias groupName reset_offset_on_start auto_offset_reset bookmark bookmarkformat "
    "primaryKey partitionCol druidMetrics druidDims treatment"
).split()


class _Spec:
    @classmethod
    def from_json(cls, record: str):
        """Read a job record; single quotes stand for double quotes."""
        values = json.loads(record.replace("'", '"'))
        return cls(**{f.name: values[f.name] for f in fields(cls) if f.name in values})


@dataclass(frozen=True)
class TableSpec(_Spec):
    """One relational table to sync.  Connection details come from the caller."""

    db: str
    table: str
    alias: str
    bookmark: str
    primaryKey: str
    fullTableSchema: str = ""
    conntype: str = ""
    host: str = ""
    port: str = ""
    user: str = ""
    password: str = ""
    numOfPartitions: str = "8"
    toDruid: bool = False
    druidMetrics: str = ""
    druidDims: str = ""
    runFrequency: str = "1 day"
    treatment: str = "skip"

    @property
    def key(self) -> str:
        """Name of the bookmark: tables of equal names on other hosts have their own."""
        return "_".join(part for part in (self.host, self.port, self.qualified) if part)

    @property
    def qualified(self) -> str:
        return f"{self.alias}_{self.db}_{self.table}"

    @property
    def columns(self) -> list[str]:
        return [c.strip() for c in self.fullTableSchema.split(",") if c.strip()]

    @property
    def buckets(self) -> int:
        return int(self.numOfPartitions)


@dataclass(frozen=True)
class StreamSpec(_Spec):
    """One topic, or several separated by commas."""

    topic: str
    alias: str
    bookmark: str
    primaryKey: str
    cluster: str = ""
    groupName: str = ""
    reset_offset_on_start: str = ""
    auto_offset_reset: str = ""
    bookmarkformat: str = ""
    partitionCol: str = ""
    druidMetrics: str = ""
    druidDims: str = ""
    treatment: str = "skip"

    @property
    def topics(self) -> list[str]:
        return sorted({t.strip() for t in self.topic.split(",") if t.strip()})

    @property
    def partition_source(self) -> str:
        """Column whose prefix names the partition: the bookmark unless another is given."""
        return self.partitionCol or self.bookmark


def parse_record(c: Column, names: list[str]) -> Column:
    """Job record text as a struct, for a whole column of records."""
    kinds = ", ".join(f"`{n}` {'boolean' if n == 'toDruid' else 'string'}" for n in names)
    return F.from_json(F.replace(c, F.lit("'"), F.lit('"')), kinds)
