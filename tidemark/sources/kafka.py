"""Kafka topics.  The connector package must be on the class path to run these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.specs import StreamSpec


def read_options(spec: StreamSpec) -> dict[str, str]:
    """Options of the stream reader; ``cluster`` is the list of brokers."""
    found = {"kafka.bootstrap.servers": spec.cluster, "subscribe": ",".join(spec.topics)}
    start = {"smallest": "earliest", "largest": "latest"}.get(spec.auto_offset_reset, spec.auto_offset_reset)
    if start:
        found["startingOffsets"] = start
    if spec.groupName:
        found["kafka.group.id"] = spec.groupName
    return found


def read_topic(spark: SparkSession, spec: StreamSpec) -> DataFrame:
    """Record values of a topic as text."""
    stream = spark.readStream.format("kafka").options(**read_options(spec)).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def row_json(*columns: Column | str) -> Column:
    """A row as JSON text, NULL fields included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def change_records(df: DataFrame, db: str, table: str, key: Column | None = None) -> DataFrame:
    """``topic``, ``key``, ``value`` rows for the change topic of a table.

    The key is the database name unless another is given; a per-row key
    spreads a busy table over the partitions of its topic.
    """
    return df.select(
        F.lit(f"TOPIC_{db}_{table}").alias("topic"),
        (F.lit(db) if key is None else key.cast("string")).alias("key"),
        row_json(*[F.col(f"`{c}`") for c in df.columns]).alias("value"),
    )


def write_records(records: DataFrame, brokers: str) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", brokers).save()
