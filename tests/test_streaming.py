"""Streams over several files: equality with the batch result, lateness, replays."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.specs import StreamSpec
from tidemark.streaming import rollup, upsert

SCHEMA = "id bigint, ts timestamp_ntz, kind string, n bigint"
START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def add_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def rolled(events):
    return rollup.hourly(events, "ts", ["kind"], {"total": F.col("n")})


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def folder(spark, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    return place


def stream_of(spark, folder):
    return rollup.file_stream(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, per_batch=1)


def test_rollup_table_equals_batch(spark, tmp_path, folder):
    target = rollup.rollup_table(str(tmp_path / "t"), ["kind"])
    for part in range(4):
        add_file(spark, folder, [(i, at(i * 17 + part), "ab"[i % 2], i) for i in range(part * 10, part * 10 + 10)])
        # stop and start again: offsets and state come from the checkpoint
        run(rollup.update_table(rolled(stream_of(spark, folder)), target, str(tmp_path / "c"), once=True))
    want = rows_of(rolled(spark.read.parquet(str(folder))))
    assert rows_of(target.read(spark).drop("partition")) == want


def test_closed_hours_are_not_written_again(spark, tmp_path, folder):
    target = rollup.rollup_table(str(tmp_path / "t"), ["kind"])

    def files():
        return {r[0]: r[1] for r in target.read(spark).select("partition", F.col("_metadata.file_path")).distinct().collect()}

    for rows in ([(1, at(5), "a", 1), (2, at(70), "a", 2)], [(3, at(75), "a", 4), (4, at(130), "a", 1)], [(5, at(128), "b", 8)]):
        before = files() if target.exists(spark) else {}
        add_file(spark, folder, rows)
        run(rollup.update_table(rolled(stream_of(spark, folder)), target, str(tmp_path / "c"), once=True))
        changed = {hour for hour, name in files().items() if before.get(hour, name) != name}
        assert changed <= {r["partition"] for r in target.read(spark).filter(F.col("window_start") >= at(60)).collect()}
    assert files().keys() == {"2024_01_01_00", "2024_01_01_01", "2024_01_01_02"}
    assert rows_of(target.read(spark).drop("partition")) == rows_of(rolled(spark.read.parquet(str(folder))))


def test_reset_begins_anew(spark, tmp_path, folder):
    spec = StreamSpec(topic="t", alias="a", bookmark="ts", primaryKey="id", reset_offset_on_start="true")
    table = upsert.stream_table(spec, str(tmp_path / "t"))
    add_records(spark, folder, [("1", "2024-01-01 10:00", "a")])
    for _ in range(2):
        run(start(spark, folder, table, str(tmp_path / "c"), spec))
    assert len([p for p in tmp_path.glob("c-*") if p.name != "c-rejects"]) == 2
    assert table.read(spark).count() == 1


def test_late_events_are_dropped_and_open_hours_kept_back(spark, tmp_path, folder):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for rows in (
        [(1, at(5), "a", 1), (2, at(50), "a", 2)],
        [(3, at(75), "a", 4)],  # watermark reaches 1:05, the first hour closes
        [(4, at(20), "a", 100), (5, at(66), "a", 8)],  # the first is too late, the second is not
        [(6, at(200), "a", 16)],
    ):
        add_file(spark, folder, rows)
        run(rollup.append_closed(rolled(stream_of(spark, folder)), out, checkpoint, once=True))
    found = rows_of(spark.read.parquet(out).select("window_start", "kind", "cnt", "total"))
    assert found == [(at(0), "a", 2, 3), (at(60), "a", 2, 12)]


SPEC = StreamSpec(topic="t", alias="a", bookmark="ts", primaryKey="id")
RECORD = "id string, ts string, v string"


def add_records(spark, folder, rows):
    df = spark.createDataFrame(rows, RECORD)
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").text(str(folder))


def record_stream(spark, folder):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(str(folder))


def start(spark, folder, table, checkpoint, spec=SPEC):
    schema = spark.createDataFrame([], RECORD).schema
    return upsert.upsert_stream(record_stream(spark, folder), spec, schema, table, checkpoint, once=True)


def test_stream_upsert_keeps_the_newest_row_per_day(spark, tmp_path, folder):
    table = upsert.stream_table(SPEC, str(tmp_path / "t"))
    for rows in (
        [("1", "2024-01-01 10:00", "old"), ("1", "2024-01-01 11:00", "new"), ("2", "2024-01-02 09:00", "x")],
        [("1", "2024-01-01 09:00", "older"), ("2", "2024-01-02 10:00", "y"), ("1", "2024-01-02 08:00", "next day")],
        [("3", "", "no time"), ("4", None, "no time")],
    ):
        add_records(spark, folder, rows)
        run(start(spark, folder, table, str(tmp_path / "c")))
    found = {(r["id"], r["partition"]): r["v"] for r in table.read(spark).collect()}
    assert found == {
        ("1", "2024_01_01"): "new", ("2", "2024_01_02"): "y", ("1", "2024_01_02"): "next day",
        ("3", "defaultNullPartition"): "no time", ("4", "defaultNullPartition"): "no time",
    }


def test_replay_of_a_stream_changes_nothing(spark, tmp_path, folder):
    table = upsert.stream_table(SPEC, str(tmp_path / "t"))
    add_records(spark, folder, [("1", "2024-01-01 10:00", "a"), ("2", "2024-01-01 10:00", "b")])
    add_records(spark, folder, [("1", "2024-01-01 12:00", "c")])
    run(start(spark, folder, table, str(tmp_path / "c1")))
    once = rows_of(table.read(spark))
    # a new checkpoint: every record is read again
    run(start(spark, folder, table, str(tmp_path / "c2")))
    assert rows_of(table.read(spark)) == once


def test_numeric_bookmark_and_bad_records(spark, tmp_path, folder):
    spec = StreamSpec(topic="t", alias="a", bookmark="v", primaryKey="k", partitionCol="p", treatment="report")
    schema = spark.createDataFrame([], "k string, v bigint, p string, n string").schema
    table = upsert.stream_table(spec, str(tmp_path / "t"))
    for texts in (
        ['{"k":"a","v":9,"p":"x","n":"1"}', '{"k":"a","v":', "", "none"],
        ['{"k":"a","v":10,"p":"x","n":"two"}', '{"k":"b","v":1,"p":"x"}'],
        ['{"k":"a","v":8,"p":"x","n":"3"}'],
    ):
        rows = spark.createDataFrame([(t,) for t in texts], "value string")
        rows.coalesce(1).write.mode("append").text(str(folder))
        run(upsert.upsert_stream(
            record_stream(spark, folder), spec, schema, table, str(tmp_path / "c"), {"n": "int"}, once=True
        ))
    assert rows_of(table.read(spark)) == [("a", 10, "x", None, "x"), ("b", 1, "x", None, "x")]
    found = spark.read.parquet(str(tmp_path / "c-rejects")).select("primarykey", "target", "value").collect()
    assert {tuple(r) for r in found} == {
        (None, "json", '{"k":"a","v":'), (None, "json", ""), (None, "json", "none"), ("a", "int", "two")
    }


def test_replayed_batch_starts_no_upsert(spark, tmp_path, folder, monkeypatch):
    from tidemark.plans import lake
    from tidemark.plans.control import ControlStore

    store, table, checkpoint = ControlStore(spark, str(tmp_path / "log")), upsert.stream_table(SPEC, str(tmp_path / "t")), str(tmp_path / "c")
    schema = spark.createDataFrame([], RECORD).schema

    def go():
        run(upsert.upsert_stream(record_stream(spark, folder), SPEC, schema, table, checkpoint, once=True, control=store))

    staged, stage = [], lake.LakeTable.stage
    monkeypatch.setattr(lake.LakeTable, "stage", lambda self, changes: staged.append(1) or stage(self, changes))
    for n in range(3):
        add_records(spark, folder, [("1", "2024-01-01 1%d:00" % n, "v%d" % n)])
        go()
    assert len(staged) == 2  # each batch after the first load is written to the shared folder once
    once, log = rows_of(table.read(spark)), store.read("stream_log").count()
    # the driver stopped after the publish, before the batch was committed
    for name in ("2", ".2.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    go()
    assert len(staged) == 2 and rows_of(table.read(spark)) == once
    log = store.read("stream_log").collect()
    assert sorted((r["hash"], r["notes"]) for r in log) == sorted(
        (str(n), note) for n in range(3) for note in ("started the run", "the last run passed")
    )
    # a new checkpoint is a new stream: its batches count from zero and are not skipped
    add_records(spark, folder, [("2", "2024-01-01 10:00", "late")])
    run(start(spark, folder, table, str(tmp_path / "c2")))
    assert {r["id"] for r in table.read(spark).collect()} == {"1", "2"}


def test_partition_column_given(spark, tmp_path, folder):
    spec = StreamSpec(topic="t", alias="a", bookmark="ts", primaryKey="id", partitionCol="v")
    table = upsert.stream_table(spec, str(tmp_path / "t"))
    add_records(spark, folder, [("1", "2024-01-01 10:00", "north/1"), ("1", "2024-01-01 11:00", "south")])
    run(start(spark, folder, table, str(tmp_path / "c"), spec))
    assert {r["partition"] for r in table.read(spark).collect()} == {"north_1", "south"}


def test_graceful_stop(spark, tmp_path, folder):
    table = upsert.stream_table(SPEC, str(tmp_path / "t"))
    add_records(spark, folder, [("1", "2024-01-01 10:00", "a")])
    schema = spark.createDataFrame([], RECORD).schema
    query = upsert.upsert_stream(record_stream(spark, folder), SPEC, schema, table, str(tmp_path / "c"))
    upsert.stop_gracefully(query)
    assert not query.isActive and table.read(spark).count() == 1


def test_trigger():
    assert upsert.trigger(False) == {"processingTime": "120 seconds"}
    assert upsert.trigger(True) == {"availableNow": True}


def test_rollup_writes_an_hour_by_one_task(spark, tmp_path, folder):
    """A stream with state plans without AQE, where every task wrote a file of every hour."""
    target = rollup.rollup_table(str(tmp_path / "t"), ["kind"])
    for part in range(2):
        add_file(spark, folder, [(i, at(i * 7 + part), f"k{i}", i) for i in range(60)])
    run(rollup.update_table(rolled(stream_of(spark, folder)), target, str(tmp_path / "c"), once=True))
    files = target.read(spark).select("partition", F.col("_metadata.file_path")).distinct().groupBy("partition").count()
    assert {r["count"] for r in files.collect()} == {1}
    assert rows_of(target.read(spark).drop("partition")) == rows_of(rolled(spark.read.parquet(str(folder))))
