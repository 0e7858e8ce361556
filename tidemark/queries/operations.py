"""Job registry, run log, saved reports and delivery status."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import delivery, jobs
from tidemark.plans.control import FAILED, IDLE, PASSED, RUNNING, STARTED, run_counters
from tidemark.plans.reports import SavedReport
from tidemark.queries import query
from tidemark.queries.rows import day
from tidemark.queries.scalars import FREQUENCIES, FREQUENCY_MINUTES, frequency
from tidemark.session import scratch_path
from tidemark.sources.files import append_partitioned_orc, read_format, table

# one registry row per order: started at the order date, ended some hours
# later or (for one in five) an hour before, i.e. not yet
REGISTRY_SQL = f"""SELECT 'host' || o_custkey AS host, '3306' AS port, 'shop' AS dbname,
   'table' || o_orderkey AS dbtable, o_orderdate AS started,
   o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 5 - 1) AS ended,
   {FREQUENCIES}[o_orderkey % 8 + 1] AS runFrequency, {FREQUENCY_MINUTES}[o_orderkey % 8 + 1] AS freq,
   (o_orderkey % 11)::INTEGER AS totalRuns, (o_orderkey % 3)::INTEGER AS failureRuns,
   CASE WHEN o_orderstatus = 'P' THEN 'running' ELSE 'idle' END AS currentState FROM orders"""
NOW = "2001-06-15 12:30:45"


def registry(spark, folder):
    key = F.col("o_orderkey")
    hours = F.make_dt_interval(hours=(key % 5 - 1).cast("int"))
    return table(spark, folder, "orders").select(
        F.concat(F.lit("host"), F.col("o_custkey").cast("string")).alias("host"),
        F.lit("3306").alias("port"),
        F.lit("shop").alias("dbname"),
        F.concat(F.lit("table"), key.cast("string")).alias("dbtable"),
        F.col("o_orderdate").cast("string").alias("lastStarted"),
        (F.col("o_orderdate") + hours).cast("string").alias("lastEnded"),
        frequency().alias("runFrequency"),
        (key % 11).cast("int").alias("totalRuns"),
        (key % 3).cast("int").alias("failureRuns"),
        F.when(F.col("o_orderstatus") == "P", RUNNING).otherwise(IDLE).alias("currentState"),
    )


@query(
    "jobs_due",
    f"""WITH r AS ({REGISTRY_SQL}),
        t AS (SELECT *, trunc((epoch_us(TIMESTAMP '{NOW}') - epoch_us(started)) / 60000000.0) > freq AS overdue,
                ended < started AS unfinished FROM r),
        d AS (SELECT host, dbtable, CASE WHEN totalRuns = 0 THEN '{jobs.FIRST_RUN}'
            WHEN unfinished AND currentState = 'running' THEN NULL
            WHEN unfinished AND overdue THEN '{jobs.NEXT_NOT_OK}'
            WHEN unfinished THEN '{jobs.EARLY_NOT_OK}'
            WHEN overdue THEN '{jobs.NEXT_OK}' END AS reason FROM t)
        SELECT * FROM d WHERE reason IS NOT NULL""",
)
def jobs_due(spark, folder):
    return jobs.jobs_due(registry(spark, folder), day(NOW)).select("host", "dbtable", "reason")


@query(
    "health_summary",
    f"""SELECT count(*) AS jobs, count(*) FILTER (failureRuns > 0) AS faulty,
          CASE WHEN count(*) = 0 THEN 'no records found ! ' WHEN count(*) FILTER (failureRuns > 0) > 0
          THEN 'something''s wrong . . .' ELSE 'things look good !' END AS message FROM ({REGISTRY_SQL})""",
)
def health_summary(spark, folder):
    return jobs.health_summary(registry(spark, folder))


@query(
    "stream_health",
    """SELECT count(*) AS streams, CASE WHEN count(*) = 0 THEN 'no kafka records found ! '
       ELSE 'various streams in parallel !' END AS message FROM customer""",
)
def stream_health(spark, folder):
    return jobs.stream_health(table(spark, folder, "customer"))


@query(
    "run_counters",
    """SELECT l_suppkey AS dbtable, count(*) FILTER (l_returnflag = 'N') AS "totalRuns",
          count(*) FILTER (l_returnflag = 'A') AS "successRuns", count(*) FILTER (l_returnflag = 'R') AS "failureRuns",
          max(l_shipdate) FILTER (l_returnflag = 'N') AS "lastStarted",
          max(l_shipdate) FILTER (l_returnflag = 'A') AS "lastEnded" FROM lineitem GROUP BY 1""",
)
def run_counters_query(spark, folder):
    notes = F.when(F.col("l_returnflag") == "N", STARTED).when(F.col("l_returnflag") == "A", PASSED).otherwise(FAILED)
    log = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("dbtable"), F.col("l_shipdate").alias("runTimeStamp"), notes.alias("notes")
    )
    return run_counters(log, ["dbtable"])


REPORT_TEXT = """SELECT o_orderpriority, count(*) AS orders, max(o_orderdate) AS newest
FROM {orders} WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority"""


@query(
    "saved_report",
    """SELECT o_orderpriority, count(*) AS orders, max(o_orderdate) AS newest
       FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def saved_report(spark, folder):
    report = SavedReport("sql", REPORT_TEXT, scratch_path(spark, "report"), "orders by priority", "orc")
    report.store(spark, {"orders": table(spark, folder, "orders")})
    return read_format(spark, report.fmt, report.output_loc)


STATUS_SQL = """SELECT 'shop' AS dbname, 'orders' AS tablename, o_orderkey::VARCHAR AS primarykey,
  'shop_orders_' || o_orderkey AS qualifiedName, o_orderdate AS sourceid,
  CASE o_orderstatus WHEN 'F' THEN o_orderdate WHEN 'O' THEN o_orderdate - INTERVAL 1 DAY END AS hdfsTargetid,
  CASE WHEN o_orderpriority = '5-LOW' THEN o_orderdate END AS kafkaTargetid FROM orders"""


def status(spark, folder):
    """Delivery state of every order: up to date, a day behind or never delivered."""
    date, state = F.col("o_orderdate"), F.col("o_orderstatus")
    behind = F.when(state == "F", date).when(state == "O", date - F.expr("INTERVAL 1 DAY"))
    key = F.col("o_orderkey").cast("string")
    return table(spark, folder, "orders").select(
        F.lit("shop").alias("dbname"),
        F.lit("orders").alias("tablename"),
        key.alias("primarykey"),
        F.concat(F.lit("shop_orders_"), key).alias("qualifiedName"),
        date.alias("sourceid"),
        behind.alias("hdfsTargetid"),
        F.when(F.col("o_orderpriority") == "5-LOW", date).alias("kafkaTargetid"),
    )


@query(
    "pending_delivery",
    f"""SELECT 'hdfs' AS target, primarykey, sourceid FROM ({STATUS_SQL})
        WHERE hdfsTargetid IS NULL OR sourceid > hdfsTargetid
        UNION ALL SELECT 'kafka', primarykey, sourceid FROM ({STATUS_SQL})
        WHERE kafkaTargetid IS NULL OR sourceid > kafkaTargetid""",
)
def pending_delivery(spark, folder):
    def due(target):
        rows = delivery.pending(status(spark, folder), target)
        return rows.select(F.lit(target).alias("target"), "primarykey", "sourceid")

    return due("hdfs").unionByName(due("kafka"))


# every line of an order reports a new source id; orders without a status
# row get one
NEWS_SQL = """SELECT 'shop' AS dbname, 'orders' AS tablename, (l_orderkey - 100)::VARCHAR AS primarykey,
  'shop_orders_' || (l_orderkey - 100) AS qualifiedName, max(l_shipdate) AS sourceid,
  NULL::TIMESTAMP AS hdfsTargetid, NULL::TIMESTAMP AS kafkaTargetid FROM lineitem GROUP BY l_orderkey"""


@query(
    "status_upsert",
    f"""WITH s AS ({STATUS_SQL}), c AS ({NEWS_SQL})
        SELECT coalesce(s.qualifiedName, c.qualifiedName) AS "qualifiedName",
          coalesce(s.primarykey, c.primarykey) AS primarykey, coalesce(c.sourceid, s.sourceid) AS sourceid,
          s.hdfsTargetid AS "hdfsTargetid", s.kafkaTargetid AS "kafkaTargetid"
        FROM s FULL JOIN c ON s.qualifiedName = c.qualifiedName""",
)
def status_upsert(spark, folder):
    lines = table(spark, folder, "lineitem").groupBy((F.col("l_orderkey") - 100).cast("string").alias("primarykey"))
    news = lines.agg(F.max("l_shipdate").alias("sourceid")).select(
        F.lit("shop").alias("dbname"),
        F.lit("orders").alias("tablename"),
        "primarykey",
        F.concat(F.lit("shop_orders_"), "primarykey").alias("qualifiedName"),
        "sourceid",
        F.lit(None).cast("timestamp_ntz").alias("hdfsTargetid"),
        F.lit(None).cast("timestamp_ntz").alias("kafkaTargetid"),
    )
    merged = delivery.status_upsert(status(spark, folder), news)
    return merged.select("qualifiedName", "primarykey", "sourceid", "hdfsTargetid", "kafkaTargetid")


@query(
    "delivery_append",
    """SELECT strftime(o_orderdate, 'dt=%Y-%m') AS label, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys
       FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1""",
)
def delivery_append(spark, folder):
    """Pending orders appended as ORC, one folder per month, and counted from there."""
    due = delivery.pending(status(spark, folder), "hdfs")
    rows = delivery.delivery_rows(
        table(spark, folder, "orders"), due, "o_orderkey", F.col("primarykey").cast("bigint"), "o_orderdate", length=7
    )
    path = scratch_path(spark, "delivered")
    append_partitioned_orc(rows.select("o_orderkey", "o_orderdate", "o_orderstatus", "label").hint("rebalance", "label"), path, "label")
    delivered = spark.read.orc(path)
    return delivered.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@query(
    "delivery_merge",
    """WITH d AS (SELECT l_orderkey AS o_orderkey, l_shipdate AS o_orderdate, l_returnflag AS o_orderstatus FROM lineitem)
       SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM d)
       UNION ALL SELECT * FROM (SELECT * FROM d
       QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, o_orderstatus) = 1)""",
)
def delivery_merge(spark, folder):
    master = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    delivered = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_shipdate").alias("o_orderdate"),
        F.col("l_returnflag").alias("o_orderstatus"),
    )
    return delivery.merge_delivered(master, delivered, "o_orderkey", "o_orderdate")
