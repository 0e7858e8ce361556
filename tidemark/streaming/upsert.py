"""Stream upsert: JSON records into a bucketed lake table, batch by batch."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from tidemark.functions.buckets import prefix_value
from tidemark.functions.convert import REPORT, conversion_targets, convert_overrides, rejects
from tidemark.plans.control import FAILED, PASSED, STARTED, ControlStore
from tidemark.plans.lake import LakeTable
from tidemark.specs import StreamSpec

# Fixed value: seconds between micro-batches.
BATCH_SECONDS = 120
BAD_RECORD = "__bad_record"


def stream_table(spec: StreamSpec, path: str) -> LakeTable:
    """Target of a stream: one bucket per prefix of the partition column."""
    return LakeTable(
        path=path,
        keys=(spec.primaryKey,),
        bucket=prefix_value(spec.partition_source),
        order_by=spec.bookmark,
    )


def parse_records(values: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Typed rows from JSON text, with the schema given once for the whole stream.

    ``BAD_RECORD`` holds the text of a record that is not valid (an empty
    text for a null one) and is null for all others.
    """
    marked = StructType([*schema.fields]).add(BAD_RECORD, StringType())
    parsed = F.from_json(column, marked, {"columnNameOfCorruptRecord": BAD_RECORD})
    bad = F.when(F.col("r").isNull() | (F.trim(column) == ""), F.coalesce(F.col(column), F.lit(""))).otherwise(F.col(f"r.{BAD_RECORD}"))
    rows = values.select(column, parsed.alias("r"))
    return rows.select(*[F.col(f"r.`{n}`") for n in schema.names], bad.alias(BAD_RECORD))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream with its checkpoint; a new checkpoint is a new stream."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
    return json.loads("".join(r["value"] for r in lines))["id"]


def batch_writer(
    spec: StreamSpec, schema: StructType, table: LakeTable, overrides: dict[str, str], newer_wins: bool,
    reject_path: str, checkpoint: str | None = None, control: ControlStore | None = None,
) -> Callable[[DataFrame, int], None]:
    """The per-batch function: parse, set bad records aside, convert, upsert.

    Only columns with an override change their type, so the bookmark is
    compared as what it is declared to be.  The number of each batch is noted
    with the table once the batch is published, so a batch that is replayed
    after that starts no upsert; one that was stopped before changes nothing
    twice, and its rejects replace those of the same batch.  The parsed
    records are kept by the executors while the batch lasts; what the upsert
    reads several times is written to shared storage once and deleted with the
    batch.  With ``control``, each batch is entered in the stream log.
    """
    def run(batch: DataFrame, number: int, mark: tuple[str, int] | None) -> None:
        records = parse_records(batch, schema).persist(StorageLevel.DISK_ONLY)
        try:
            good = records.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
            bad = records.filter(F.col(BAD_RECORD).isNotNull()).select(
                F.lit(None).cast("string").alias("primarykey"), F.lit(None).cast("string").alias("colname"),
                F.lit("json").alias("target"), F.col(BAD_RECORD).alias("value"),
            )
            targets = conversion_targets(good, overrides)
            if targets and spec.treatment.lower() == REPORT:
                values = rejects(good, targets, [spec.primaryKey]).withColumnRenamed(spec.primaryKey, "primarykey")
                bad = bad.unionByName(values.withColumn("primarykey", F.col("primarykey").cast("string")))
            bad.write.mode("overwrite").parquet(f"{reject_path}/batch={number}")
            table.upsert(convert_overrides(good, overrides, spec.treatment), newer_wins, mark=mark)
        finally:
            records.unpersist()

    def write(batch: DataFrame, number: int) -> None:
        mark = None
        if checkpoint:
            mark = (f"batch.{stream_id(batch.sparkSession, checkpoint)}", number)
            done = table.noted(batch.sparkSession, mark[0])
            if done is not None and number <= done:
                return
        if control is None:
            run(batch, number, mark)
            return
        key = f"{number}"
        control.log_stream(spec, key, STARTED)
        try:
            run(batch, number, mark)
        except Exception as error:
            control.log_stream(spec, key, FAILED, str(error))
            raise
        control.log_stream(spec, key, PASSED)

    return write


def trigger(once: bool, seconds: int = BATCH_SECONDS) -> dict:
    return {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}


def upsert_stream(
    values: DataFrame,
    spec: StreamSpec,
    schema: StructType,
    table: LakeTable,
    checkpoint: str,
    overrides: dict[str, str] | None = None,
    newer_wins: bool = True,
    once: bool = False,
    reject_path: str | None = None,
    control: ControlStore | None = None,
) -> StreamingQuery:
    """Start the stream.  State lives in the table, offsets in the checkpoint.

    Malformed records, and with the ``report`` treatment values that cannot
    be converted, go to ``reject_path`` (``<checkpoint>-rejects`` if none is
    given) as ``primarykey, colname, target, value``, one folder per batch.
    A spec with ``reset_offset_on_start`` begins anew, at its
    ``auto_offset_reset``, with a checkpoint of its own beside the given path.
    With ``control``, every batch is logged under its number as started, passed
    or failed.

    ``newer_wins`` is on: a batch that is replayed after later ones cannot
    put an older row back.
    """
    reject_path = reject_path or checkpoint.rstrip("/") + "-rejects"
    if spec.reset_offset_on_start.strip().lower() == "true":
        checkpoint = f"{checkpoint.rstrip('/')}-{time.time_ns()}"
    writer = batch_writer(spec, schema, table, overrides or {}, newer_wins, reject_path, checkpoint, control)
    return (
        values.writeStream.foreachBatch(writer)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once))
        .start()
    )


def stop_gracefully(query: StreamingQuery) -> None:
    """Finish what has arrived, then stop."""
    query.processAllAvailable()
    query.stop()
