"""Time the one-job upsert against a loop with one job per bucket, and the stream rollup.

    python tools/bench_upsert.py [folder]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.buckets import md5_bucket  # noqa: E402
from tidemark.operators.merge import upsert  # noqa: E402
from tidemark.plans.lake import PARTITION, LakeTable  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.streaming import rollup  # noqa: E402


def loop_upsert(table: LakeTable, changes) -> None:
    """One job per touched bucket, in sequence: the plan this library replaces."""
    spark = changes.sparkSession
    batch = changes.withColumn(PARTITION, table.bucket)
    for (bucket,) in batch.select(PARTITION).distinct().collect():
        rows = batch.filter(F.col(PARTITION) == bucket).drop(PARTITION)
        place = f"{table.path}/{PARTITION}={bucket}"
        old = spark.read.parquet(place)
        upsert(old, rows, list(table.keys), table.order_by).write.mode("overwrite").parquet(f"{place}_new")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 2)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("bench", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    dates = orders.agg(F.expr("percentile(unix_seconds(cast(o_orderdate as timestamp)), array(0.9, 0.99))")).first()[0]
    found = {}
    for buckets in (8, 64):
        for share, bound in (("10 %", dates[0]), ("1 %", dates[1])):
            table = LakeTable(
                scratch_path(spark, "t"), ("o_orderkey",), md5_bucket("o_orderkey", buckets).cast("string"), "o_orderdate"
            )
            table.upsert(orders)
            changes = orders.filter(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) >= F.lit(bound))
            found[f"{buckets} buckets, {share}: loop"] = timed(lambda: loop_upsert(table, changes))
            found[f"{buckets} buckets, {share}: one job"] = timed(lambda: table.upsert(changes))
    events = spark.read.parquet(f"{folder}/events.parquet")
    files = scratch_path(spark, "events")
    events.repartitionByRange(20, "ts").write.parquet(files)
    stream = rollup.file_stream(spark, files, events.schema, per_batch=5)
    rolled = rollup.hourly(stream, "ts", ["event_type"], {"total": F.round(F.col("value") * 100).cast("bigint")})

    def run():
        rollup.append_closed(rolled, scratch_path(spark, "out"), scratch_path(spark, "c"), once=True).awaitTermination()

    found["stream rollup rows/s"] = round(events.count() / timed(run))
    print(json.dumps(found))


if __name__ == "__main__":
    main()
