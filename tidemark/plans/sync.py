"""Incremental table sync."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.buckets import md5_bucket
from tidemark.functions.convert import REPORT, conversion_targets, convert_target_types, rejects
from tidemark.plans.control import DEFAULT_BOOKMARK, FAILED, PASSED, STARTED, ControlStore
from tidemark.plans.lake import LakeTable
from tidemark.session import scratch, written
from tidemark.sources import jdbc
from tidemark.specs import TableSpec


UNSUPPORTED = "the db connection type provided is not supported"


def bookmark_between(df: DataFrame, column: str, previous: str | None, current: str) -> Column:
    """Rows from the previous to the current bookmark, both included.

    The bounds are literals of the column's own type, so the comparison is
    typed and reaches the scan.  Without a previous bookmark there is no
    lower bound, whatever values the column holds.
    """
    kind = df.schema[column].dataType.simpleString()
    c = F.col(column)
    upper = c <= F.lit(current).cast(kind)
    if previous is None or (previous == DEFAULT_BOOKMARK and kind not in ("int", "bigint", "double", "string")):
        return upper
    return (c >= F.lit(previous).cast(kind)) & upper


class FrameSource:
    """A table that Spark can already read, behind the same calls as a database."""

    def __init__(self, df: DataFrame, spec: TableSpec):
        self.df, self.spec = df, spec

    def current_bookmark(self) -> str | None:
        return self.df.agg(F.max(self.spec.bookmark).cast("string")).first()[0]

    def read_range(self, previous: str | None, current: str) -> DataFrame:
        picked = self.df.filter(bookmark_between(self.df, self.spec.bookmark, previous, current))
        return picked.select(*(self.spec.columns or self.df.columns))


class JdbcSource:
    def __init__(self, spark, spec: TableSpec, split: jdbc.ParallelRead | None = None):
        self.spark, self.spec, self.split = spark, spec, split

    def current_bookmark(self) -> str | None:
        return jdbc.current_bookmark(self.spark, self.spec, None)

    def read_range(self, previous: str | None, current: str) -> DataFrame:
        return jdbc.read_range(self.spark, self.spec, previous, current, self.split)


def lake_table(spec: TableSpec, path: str, bookmark_type: str = "string", name: str | None = None) -> LakeTable:
    """Target of a sync: rows bucketed by the md5 of the primary key, a table of the catalog.

    Bookmarks are stored as the type rules say (mostly text) but compared
    as ``bookmark_type``, the type they have in the source.
    """
    return LakeTable(
        path=path,
        keys=(spec.primaryKey,),
        bucket=md5_bucket(spec.primaryKey, spec.buckets).cast("string"),
        order_by=F.col(spec.bookmark).try_cast(bookmark_type),
        name=name,
    )


def sync_table(
    source,
    spec: TableSpec,
    control: ControlStore,
    path: str,
    newer_wins: bool = False,
    on_rows: Callable[[DataFrame], None] | None = None,
    name: str | None = None,
) -> int:
    """Bring the target up to the source's newest bookmark; returns the number of changed keys.

    One staged batch and one upsert job over all touched buckets, which the catalog then points to their new files; the
    table's ``name`` there is made of the path if none is given.  The bookmark moves only after that; a repeated range is
    harmless.  A source without a bookmark (an empty one) is left alone, and so is the saved one.  Types widen as the
    table's rules say; any other change of a column fails the run and leaves table and bookmark as they were.
    ``on_rows`` receives the staged batch, e.g. to send it to a topic; its files go with the run.
    """
    run = secrets.token_hex(5)
    control.log(spec, run, STARTED)
    try:
        current = source.current_bookmark()
        if current is None:
            control.log(spec, run, PASSED)
            return 0
        rows = source.read_range(control.bookmark(spec.key, None), current)
        count, problem = 0, None
        if not rows.columns:
            problem = UNSUPPORTED
        else:
            overrides = control.overrides(spec.qualified)
            with scratch(control.spark):
                if spec.treatment.lower() == REPORT:
                    rows = report_rejects(rows, spec, overrides, control, run)
                typed = convert_target_types(rows, overrides, treatment=spec.treatment)
                target = lake_table(spec, path, rows.schema[spec.bookmark].dataType.simpleString(), name)
                batch = target.stage(typed)
                count = batch.count()
                if count:
                    target.upsert(batch, newer_wins, staged=True)
                    if on_rows:
                        on_rows(batch)
        control.save_bookmark(spec.key, current)
        control.log(spec, run, PASSED, problem)
        return count
    except Exception as error:
        control.log(spec, run, FAILED, str(error))
        raise


def report_rejects(
    rows: DataFrame, spec: TableSpec, overrides: dict[str, str], control: ControlStore, run: str
) -> DataFrame:
    """Store the values that cannot be converted; returns the batch to go on with.

    The batch is fixed on shared storage first, as the source is read once.
    """
    fixed = written(rows, "source")
    targets = conversion_targets(fixed, overrides)
    if targets:
        bad = rejects(fixed, targets, [spec.primaryKey]).select(
            F.lit(spec.qualified).alias("tablename"),
            F.lit(run).alias("hash"),
            F.col(spec.primaryKey).cast("string").alias("primarykey"),
            "colname", "target", "value",
        )
        bad.write.mode("append").parquet(f"{control.root}/rejects")
    return fixed
