"""Hourly rollup of an event stream with a bound on lateness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.aggregates import rollup_counts
from tidemark.plans.lake import LakeTable
from tidemark.session import scratch
from tidemark.streaming.upsert import trigger

# Segment length and how late an event may come.
SEGMENT = "1 hour"
LATENESS = "10 minutes"


def file_stream(spark: SparkSession, path: str, schema: StructType, per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)


def hourly(events: DataFrame, time: str, dims: list[str], sums: dict[str, Column]) -> DataFrame:
    """Count and sums per hour and dimension set; the same for batch and stream.

    On a stream the watermark drops events that come too late and lets the
    state of closed hours go.
    """
    timed = events.withColumn("__time", F.col(time).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("__time", LATENESS)
    rolled = rollup_counts(timed, [F.window("__time", SEGMENT).alias("__w"), *dims], sums)
    return rolled.select(
        F.col("__w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("__w.end").cast("timestamp_ntz").alias("window_end"),
        *dims, "cnt", *sums,
    )


def append_closed(rolled: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append each hour to Parquet once no more events can change it."""
    return (
        rolled.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once))
        .start(path)
    )


def rollup_table(path: str, dims: list[str]) -> LakeTable:
    """Rollup target, one bucket per hour; a later count of an hour replaces the earlier.

    A batch holds the hours it changed and no others, and none behind the
    watermark, so the files of a closed hour are never written again.
    """
    hour = F.date_format("window_start", "yyyy_MM_dd_HH")
    return LakeTable(path=path, keys=("window_start", *dims), bucket=hour, order_by="cnt")


def update_table(rolled: DataFrame, table: LakeTable, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Keep a table of all hours up to date, open ones included.

    Each batch sends only the groups it changed, so neither the sink nor the
    state holds the whole history.  A stream with state plans without AQE,
    and without it ``rebalance`` does nothing: every task would write a file
    of every hour.  So the batch is staged and the table changed by the
    session that the stream came from.
    """
    spark = rolled.sparkSession

    def write(batch: DataFrame, _: int) -> None:
        with scratch(spark):
            table.upsert(table.stage(batch, spark), staged=True)

    return (
        rolled.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once))
        .start()
    )
