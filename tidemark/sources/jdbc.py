"""Relational sources over Spark's JDBC reader.

Connection details are parameters of the spec; nothing is built in.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.specs import TableSpec

# The supported databases, found by name in the driver class.
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{db}?zeroDateTimeBehavior=convertToNull",
    "postgres": "jdbc:postgresql://{host}:{port}/{db}",
    "sqlserver": "jdbc:sqlserver://{host}:{port};databaseName={db}",
}
DEFAULT_BOOKMARK = "0"


def database_kind(conntype: str) -> str | None:
    """``mysql``, ``postgres`` or ``sqlserver``, or ``None`` for anything else."""
    return next((kind for kind in URLS if kind in conntype.lower()), None)


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def alias_of(spec: TableSpec) -> str:
    return "_".join(re.sub("[^a-zA-Z]", "", part) for part in (spec.alias, spec.db, spec.table))


def range_query(spec: TableSpec, previous: str | None, current: str) -> str:
    """The rows between two bookmarks, both ends included; a first load has no lower bound."""
    lower = "" if previous is None else f"{spec.bookmark} >= {quote(previous)} and "
    return (
        f"(select {','.join(spec.columns) or '*'} from {spec.table}"
        f" where {lower}{spec.bookmark} <= {quote(current)})"
        f" range_{alias_of(spec)}"
    )


def max_query(spec: TableSpec) -> str:
    """The newest bookmark, computed by the source."""
    return f"(select max({spec.bookmark}) as {spec.bookmark} from {spec.table}) top_{alias_of(spec)}"


@dataclass(frozen=True)
class ParallelRead:
    """Split of a JDBC read by a numeric, date or timestamp column."""

    column: str
    lower: str
    upper: str
    partitions: int


#: Rows that one connection reads, and connections at most; a source is not to be flooded.
ROWS_PER_READ = 250_000
MOST_READS = 64


def bounds_query(spec: TableSpec, previous: str | None, current: str) -> str:
    """The lowest and the highest key of a range of bookmarks and its rows, computed by the source in one pass."""
    key = spec.primaryKey
    return (
        f"(select min({key}) as low, max({key}) as high, count(*) as n"
        f" from {range_query(spec, previous, current)}) bounds_{alias_of(spec)}"
    )


def split_predicates(column: str, low, high, rows: int, per_read: int = ROWS_PER_READ, most: int = MOST_READS) -> list[str]:
    """Conditions that cut the rows into parts of about equal width, each row in exactly one.

    The outer parts are open, so rows beyond the bounds, added meanwhile, are
    read too, and rows without a key have a part of their own.  Nothing to
    split gives no condition: few rows, one key, or keys that are no numbers,
    dates or times.
    """
    parts = min(most, -(-rows // per_read))
    if parts < 2 or isinstance(low, bool) or not isinstance(low, (int, float, Decimal, date)) or not low < high:
        return []

    def cut(n: int) -> str:
        if isinstance(low, int):
            return str(low + (high - low) * n // parts)
        if isinstance(low, datetime):
            return quote((low + (high - low) * n / parts).isoformat(" "))
        if isinstance(low, date):
            return quote((low + timedelta(days=(high - low).days * n // parts)).isoformat())
        return str(low + (high - low) * n / parts)

    cuts = list(dict.fromkeys(cut(n) for n in range(1, parts)))
    inner = [f"{column} >= {a} and {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]}", *inner, f"{column} >= {cuts[-1]}", f"{column} is null"]


def planned_split(spark: SparkSession, spec: TableSpec, previous: str | None, current: str) -> list[str]:
    """Ask the source for the bounds of a range and split it by the primary key."""
    row = spark.read.format("jdbc").options(**options(spec, bounds_query(spec, previous, current))).load().first()
    return split_predicates(spec.primaryKey, row["low"], row["high"], int(row["n"]))


def options(spec: TableSpec, dbtable: str, split: ParallelRead | None = None, fetch: int = 10000) -> dict[str, str]:
    kind = database_kind(spec.conntype)
    if kind is None:
        raise ValueError(f"unsupported connection type: {spec.conntype}")
    found = {
        "driver": spec.conntype,
        "url": URLS[kind].format(host=spec.host, port=spec.port, db=spec.db),
        "user": spec.user,
        "password": spec.password,
        "dbtable": dbtable,
        "fetchsize": str(fetch),
    }
    if split:
        found |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.partitions),
        }
    return found


def read_range(
    spark: SparkSession, spec: TableSpec, previous: str | None, current: str, split: ParallelRead | None = None
) -> DataFrame:
    """Changed rows of a table; an unsupported database gives an empty frame.

    Without a given split the source's own bounds decide: a large range is
    read over several connections, by the primary key.
    """
    if database_kind(spec.conntype) is None:
        return spark.createDataFrame([], StructType())
    query = range_query(spec, previous, current)
    if split is None:
        parts = planned_split(spark, spec, previous, current)
        if parts:
            found = options(spec, query)
            url, dbtable = found.pop("url"), found.pop("dbtable")
            return spark.read.jdbc(url, dbtable, predicates=parts, properties=found)
    return spark.read.format("jdbc").options(**options(spec, query, split)).load()


def current_bookmark(
    spark: SparkSession, spec: TableSpec, default: str | None = DEFAULT_BOOKMARK
) -> str | None:
    """Newest bookmark as text; the default when the table is empty."""
    if database_kind(spec.conntype) is None:
        return DEFAULT_BOOKMARK
    row = spark.read.format("jdbc").options(**options(spec, max_query(spec))).load().first()
    return default if row is None or row[0] is None else str(row[0])


def list_tables(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Columns of every table that has a primary key."""
    query = (
        "(select c.table_name, c.column_name, c.data_type from information_schema.columns c"
        " join information_schema.table_constraints k"
        " on k.table_schema = c.table_schema and k.table_name = c.table_name"
        f" where k.constraint_type = 'PRIMARY KEY' and c.table_schema = {quote(spec.db)}) listed"
    )
    return spark.read.format("jdbc").options(**options(spec, query)).load()


def write_table(df: DataFrame, spec: TableSpec, name: str | None = None, mode: str = "overwrite") -> None:
    found = options(spec, name or spec.table)
    df.write.format("jdbc").options(**found).option("truncate", "true").mode(mode).save()
