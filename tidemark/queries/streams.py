"""Streaming queries over the events table, run to the end of the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.queries import query
from tidemark.session import list_path, scratch_path
from tidemark.sources.files import table
from tidemark.specs import StreamSpec
from tidemark.streaming import rollup, upsert

DIMS = ["event_type", "user_id"]


def cents():
    return {"cents": F.round(F.col("value") * 100).cast("bigint")}


ROLLUP_SQL = """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  event_type, user_id, count(*) AS cnt, sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY ALL"""


FILES = 8  # that the events come in, one per micro-batch
DELAY = "5 minutes"  # by which every third event is late; the streams wait longer


def delivered(spark, folder) -> str:
    """The events as files in the order of their delivery, which late events follow with a later file.

    The events' span is cut into equal parts, one file each; files are taken
    by their time, which is set.
    """
    events = table(spark, folder, "events")
    moment = F.col("ts").cast("timestamp")
    came = F.unix_micros(F.when(F.col("event_id") % 3 == 0, moment + F.expr(f"INTERVAL {DELAY}")).otherwise(moment))
    low, high = events.agg(F.min(F.unix_micros(moment)), F.max(F.unix_micros(moment))).first()
    part = F.least(F.lit(FILES - 1), F.floor((came - low) * FILES / ((high or 0) - (low or 0) + 1)))
    path = scratch_path(spark, "events")
    placed = events.withColumn("part", part).repartition(FILES, "part")
    placed.write.partitionBy("part").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for number in range(FILES):
        for name in list_path(spark, f"{path}/part={number}"):
            files.setTimes(place(f"{path}/part={number}/{name}"), 1_700_000_000_000 + 60_000 * number, -1)
    return path


def event_stream(spark, folder, per_batch=1):
    schema = table(spark, folder, "events").schema
    return rollup.file_stream(spark, f"{delivered(spark, folder)}/part=*", schema, per_batch)


def finished(stream) -> None:
    stream.awaitTermination()
    if stream.exception():
        raise stream.exception()


@query("batch_rollup", ROLLUP_SQL)
def batch_rollup(spark, folder):
    return rollup.hourly(table(spark, folder, "events"), "ts", DIMS, cents())


@query("stream_rollup", ROLLUP_SQL)
def stream_rollup(spark, folder):
    """All hours, kept up to date in a table as batches arrive."""
    rolled = rollup.hourly(event_stream(spark, folder), "ts", DIMS, cents())
    target = rollup.rollup_table(scratch_path(spark, "rollup"), DIMS)
    finished(rollup.update_table(rolled, target, scratch_path(spark, "offsets"), once=True))
    return target.read(spark).drop(target.partition)


@query(
    "stream_rollup_append",
    f"""SELECT * FROM ({ROLLUP_SQL}) WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def stream_rollup_append(spark, folder):
    """Only the hours that no later event can change."""
    rolled = rollup.hourly(event_stream(spark, folder), "ts", DIMS, cents())
    path = scratch_path(spark, "closed")
    finished(rollup.append_closed(rolled, path, scratch_path(spark, "offsets"), once=True))
    return spark.read.schema(rolled.schema).parquet(path)


EVENT_SPEC = StreamSpec(topic="events", alias="lake", bookmark="ts", primaryKey="user_id")


@query(
    "stream_upsert",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type,
              strftime(ts, '%Y_%m_%d') AS "partition" FROM events
       QUALIFY row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), user_id ORDER BY ts DESC, event_id) = 1""",
)
def stream_upsert(spark, folder):
    """JSON records, newest per user within each day's partition."""
    record = F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type")
    values = event_stream(spark, folder, per_batch=3).select(F.to_json(record).alias("value"))
    schema = spark.createDataFrame([], "event_id bigint, ts string, user_id bigint, event_type string").schema
    target = upsert.stream_table(EVENT_SPEC, scratch_path(spark, "users"))
    finished(
        upsert.upsert_stream(
            values, EVENT_SPEC, schema, target, scratch_path(spark, "offsets"), {"event_id": "bigint"}, once=True
        )
    )
    return target.read(spark)
