"""Connection options, SQL texts, formats and catalog tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.buckets import md5_bucket
from tidemark.plans.lake import LakeTable
from tidemark.sources import catalog, files, jdbc, kafka
from tidemark.specs import StreamSpec, TableSpec

SPEC = TableSpec(
    db="shop", table="orders", alias="a1", bookmark="updated", primaryKey="id", fullTableSchema="id,updated",
    conntype="com.mysql.jdbc.Driver", host="h", port="3306", user="u", password="p",
)


def test_jdbc_texts():
    assert jdbc.range_query(SPEC, "2016-01-01", "o'clock") == (
        "(select id,updated from orders where updated >= '2016-01-01' and updated <= 'o''clock') range_a_shop_orders"
    )
    assert jdbc.max_query(SPEC) == "(select max(updated) as updated from orders) top_a_shop_orders"


@pytest.mark.parametrize(
    "driver, url",
    [
        ("com.mysql.jdbc.Driver", "jdbc:mysql://h:3306/shop?zeroDateTimeBehavior=convertToNull"),
        ("org.postgresql.Driver", "jdbc:postgresql://h:3306/shop"),
        ("com.microsoft.sqlserver.jdbc.SQLServerDriver", "jdbc:sqlserver://h:3306;databaseName=shop"),
    ],
)
def test_jdbc_options(driver, url):
    spec = TableSpec(**{**SPEC.__dict__, "conntype": driver})
    split = jdbc.ParallelRead("id", "1", "900", 16)
    found = jdbc.options(spec, jdbc.max_query(spec), split)
    assert found["url"] == url and found["user"] == "u"
    assert (found["partitionColumn"], found["numPartitions"]) == ("id", "16")


def test_jdbc_bounds_and_parts():
    from datetime import date, datetime
    from decimal import Decimal

    assert jdbc.bounds_query(SPEC, None, "9") == (
        "(select min(id) as low, max(id) as high, count(*) as n from "
        "(select id,updated from orders where updated <= '9') range_a_shop_orders) bounds_a_shop_orders"
    )
    parts = jdbc.split_predicates("id", -5, 95, 35, per_read=10)
    assert parts == ["id < 20", "id >= 20 and id < 45", "id >= 45 and id < 70", "id >= 70", "id is null"]
    assert len(jdbc.split_predicates("id", 0, 10**9, 10**9)) == jdbc.MOST_READS + 1
    assert jdbc.split_predicates("id", 1, 2, 30, per_read=10) == ["id < 1", "id >= 1", "id is null"]
    assert jdbc.split_predicates("t", datetime(2024, 1, 1), datetime(2024, 1, 3), 2, per_read=1) == [
        "t < '2024-01-02 00:00:00'", "t >= '2024-01-02 00:00:00'", "t is null"
    ]
    assert jdbc.split_predicates("t", date(2024, 1, 1), date(2024, 1, 3), 2, per_read=1)[0] == "t < '2024-01-02'"
    assert jdbc.split_predicates("x", Decimal("1.0"), Decimal("2.0"), 2, per_read=1)[0] == "x < 1.5"
    for low, high, rows in ((None, None, 0), (1, 9, 5), (7, 7, 100), ("a", "z", 100), (True, False, 100)):
        assert jdbc.split_predicates("id", low, high, rows, per_read=10) == []


def test_parts_hold_every_row_once(spark):
    rows = spark.createDataFrame([(n,) for n in [*range(-20, 130), None, None]], "id int")
    for low, high in ((0, 100), (5, 6), (-20, 129)):
        parts = jdbc.split_predicates("id", low, high, 95, per_read=10)
        assert sum(rows.filter(part).count() for part in parts) == rows.count()


def test_large_ranges_are_read_in_parts(monkeypatch):
    asked = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    parts = ["id < 5", "id >= 5", "id is null"]
    monkeypatch.setattr(jdbc, "planned_split", lambda *_: parts)
    jdbc.read_range(Session(), SPEC, "1", "2")
    assert asked["table"] == jdbc.range_query(SPEC, "1", "2") and asked["predicates"] == parts
    assert asked["url"].startswith("jdbc:mysql") and set(asked["properties"]) == {"driver", "user", "password", "fetchsize"}


def test_unsupported_database(spark):
    spec = TableSpec(**{**SPEC.__dict__, "conntype": "oracle"})
    assert jdbc.read_range(spark, spec, "0", "1").columns == []
    assert jdbc.current_bookmark(spark, spec) == "0"
    with pytest.raises(ValueError, match="unsupported"):
        jdbc.options(spec, "t")


def test_kafka_options():
    spec = StreamSpec(topic="b,a", alias="x", bookmark="ts", primaryKey="id", cluster="k1:9092", auto_offset_reset="smallest", groupName="g")
    assert kafka.read_options(spec) == {
        "kafka.bootstrap.servers": "k1:9092", "subscribe": "a,b", "startingOffsets": "earliest", "kafka.group.id": "g"
    }


def test_change_records(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    assert tuple(kafka.change_records(df, "d", "t").first()) == ("TOPIC_d_t", "d", '{"id":1,"name":null}')
    assert kafka.change_records(df, "d", "t", F.col("id")).first()["key"] == "1"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv", "tsv"])
def test_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a b"), (2, 'q"t'), (3, "x,y\tz")], "id int, name string")
    files.write_format(df, fmt, str(tmp_path / "f"))
    found = files.read_format(spark, fmt, str(tmp_path / "f")).select(F.col("id").cast("int"), "name")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.collect()))


def test_orc_appends(spark, tmp_path):
    df = spark.createDataFrame([(1, "dt=1"), (2, "dt=2")], "id int, p string")
    for _ in range(2):
        files.append_partitioned_orc(df, str(tmp_path / "o"), "p")
    assert spark.read.orc(str(tmp_path / "o")).count() == 4


def test_manifest_lists_every_file(spark, tmp_path):
    spark.range(10).selectExpr("cast(id as string) v").repartition(3).write.option("compression", "gzip").text(str(tmp_path / "g"))
    assert files.manifest(spark, str(tmp_path / "g")).count() == 3


def test_catalog_table(spark, tmp_path):
    df = spark.range(40).select("id", F.col("id").cast("string").alias("v"))
    column = catalog.partition_column("id")
    table = LakeTable(str(tmp_path / "t"), ("id",), md5_bucket("id", 4).cast("string"), "v", column)
    table.upsert(df)
    name = catalog.table_name("lake test", tmp_path.name)
    catalog.create_table(spark, name, df, column, str(tmp_path / "t"), {"v": "STRING"})
    one = table.read(spark).first()[column]
    catalog.add_partition(spark, name, column, one)
    assert [r[0] for r in catalog.partitions(spark, name).collect()] == [one]
    assert 0 < spark.table(name).count() < 40
    catalog.repair(spark, name)
    assert spark.table(name).count() == 40
    listed = catalog.list_columns(spark).filter(F.col("tablename") == name)
    assert {r["colname"] for r in listed.collect()} == {"id", "v", column}
    described = catalog.describe_table(spark, name, df, {"id": "int"}).collect()
    assert [tuple(r)[1:] for r in described] == [("id", "bigint", "int"), ("v", "string", "none")]
    spark.sql(f"DROP TABLE {name}")
