"""Bookmarks, latest rows, upserts, merges, joins, pivots, reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import clean
from tidemark.functions.buckets import bucket_label, md5_bucket
from tidemark.operators import aggregates, latest, merge, rowid
from tidemark.operators.lookups import Lookup
from tidemark.plans.control import top_rows
from tidemark.plans.delta_job import DeltaPlan, denormalise
from tidemark.plans.export import batch_label
from tidemark.plans.reports import order_report
from tidemark.plans.sync import FrameSource
from tidemark.queries import query
from tidemark.sources.files import table
from tidemark.specs import TableSpec

LINE_REST = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,"
    " l_returnflag, l_linestatus, l_shipdate"
)


def day(text: str):
    return F.lit(datetime.fromisoformat(text)).cast("timestamp_ntz")


ORDERS_SPEC = TableSpec(
    db="shop", table="orders", alias="lake", bookmark="o_orderdate", primaryKey="o_orderkey",
    fullTableSchema="o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate",
)


@query(
    "bookmark_range",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""",
)
def bookmark_range(spark, folder):
    source = FrameSource(table(spark, folder, "orders"), ORDERS_SPEC)
    return source.read_range("1996-01-01 00:00:00", "1998-12-31 00:00:00")


@query(
    "bookmark_current",
    "SELECT coalesce(max(o_orderdate), TIMESTAMP '2004-01-01') AS bookmark FROM orders",
)
def bookmark_current(spark, folder):
    return aggregates.max_or_default(table(spark, folder, "orders"), "o_orderdate", day("2004-01-01"), "bookmark")


def bookmark_log(spark, folder):
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("primarykey"),
        F.col("o_orderdate").alias("bookmark"),
    )


@query(
    "bookmark_latest",
    "SELECT o_orderstatus AS primarykey, max_by(o_orderdate, o_orderkey) AS bookmark FROM orders GROUP BY 1",
)
def bookmark_latest(spark, folder):
    return latest.latest_value(bookmark_log(spark, folder), "primarykey", "bookmark", "id")


@query(
    "top_bookmarks",
    """SELECT o_orderkey AS id, o_orderstatus AS primarykey, o_orderdate AS bookmark
       FROM orders ORDER BY o_orderkey DESC LIMIT 2""",
)
def top_bookmarks(spark, folder):
    return top_rows(bookmark_log(spark, folder), "id", 2)


@query(
    "latest_per_key",
    f"""SELECT {LINE_COLUMNS} FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_shipdate DESC, l_linenumber, {LINE_REST}) = 1""",
)
def latest_per_key(spark, folder):
    lines = table(spark, folder, "lineitem")
    return latest.latest_per_key(lines, ["l_orderkey"], "l_shipdate", ["l_linenumber", *LINE_REST.split(", ")])


@query(
    "latest_with_ties",
    f"""SELECT {LINE_COLUMNS} FROM lineitem
        QUALIFY rank() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate DESC) = 1""",
)
def latest_with_ties(spark, folder):
    return latest.latest_with_ties(table(spark, folder, "lineitem"), ["l_orderkey", "l_suppkey"], "l_shipdate")


@query(
    "latest_right_join",
    f"""SELECT {", ".join("a." + c for c in LINE_COLUMNS.split(", "))}
        FROM lineitem a RIGHT JOIN (
          SELECT l_orderkey, l_suppkey, max(l_shipdate) AS l_shipdate FROM lineitem
          WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2) b
        ON a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey AND a.l_shipdate = b.l_shipdate""",
)
def latest_right_join(spark, folder):
    lines = table(spark, folder, "lineitem")
    since = F.col("l_shipdate") >= day("1998-01-01")
    return latest.latest_right_join(lines, ["l_orderkey", "l_suppkey"], "l_shipdate", since)


# base: all orders; changes: late orders, priced up and a day later, and
# the same orders again under new keys
CHANGES_SQL = """
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000 AS o_totalprice,
         o_orderdate + INTERVAL 1 DAY AS o_orderdate, 'changed' AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'
  UNION ALL
  SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01'"""


def order_changes(spark, folder):
    late = table(spark, folder, "orders").filter(F.col("o_orderdate") >= day("2000-06-01"))
    priced = late.withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1000,
            "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"),
            "o_orderpriority": F.lit("changed"),
        }
    )
    return priced.unionByName(late.withColumn("o_orderkey", -1 - F.col("o_orderkey")))


@query(
    "upsert_anti_union",
    f"""WITH c AS ({CHANGES_SQL})
        SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM c)
        UNION ALL SELECT * FROM c""",
)
def upsert_anti_union(spark, folder):
    return merge.upsert(table(spark, folder, "orders"), order_changes(spark, folder), ["o_orderkey"], "o_orderdate")


# rows of the lines table as versions of an order, some older than the base row
@query(
    "upsert_newer_wins",
    """WITH c AS (SELECT l_orderkey AS o_orderkey, l_shipdate AS o_orderdate, l_returnflag AS o_orderstatus, 0 AS old
                  FROM lineitem),
            u AS (SELECT * FROM c UNION ALL SELECT o_orderkey, o_orderdate, o_orderstatus, 1 FROM orders)
       SELECT o_orderkey, o_orderdate, o_orderstatus FROM u
       QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, old, o_orderstatus) = 1""",
)
def upsert_newer_wins(spark, folder):
    base = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    changes = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_shipdate").alias("o_orderdate"),
        F.col("l_returnflag").alias("o_orderstatus"),
    )
    return merge.upsert(base, changes, ["o_orderkey"], "o_orderdate", newer_wins=True)


@query(
    "merge_update_insert",
    f"""WITH c AS ({CHANGES_SQL})
        SELECT coalesce(o.o_orderkey, c.o_orderkey) AS o_orderkey,
               CASE WHEN c.o_orderkey IS NULL THEN o.o_custkey ELSE c.o_custkey END AS o_custkey,
               CASE WHEN c.o_orderkey IS NULL THEN o.o_orderstatus ELSE c.o_orderstatus END AS o_orderstatus,
               CASE WHEN c.o_orderkey IS NULL THEN o.o_totalprice ELSE c.o_totalprice END AS o_totalprice,
               CASE WHEN c.o_orderkey IS NULL THEN o.o_orderdate ELSE c.o_orderdate END AS o_orderdate,
               CASE WHEN o.o_orderkey IS NULL THEN c.o_orderpriority ELSE o.o_orderpriority END AS o_orderpriority
        FROM orders o FULL JOIN c ON o.o_orderkey = c.o_orderkey""",
)
def merge_update_insert(spark, folder):
    orders, changes = table(spark, folder, "orders"), order_changes(spark, folder)
    return merge.merge(orders, changes, ["o_orderkey"], insert_only=["o_orderpriority"])


BUCKET_SQL = """(CASE WHEN ('0x' || substr(md5(o_orderkey::VARCHAR), 25, 8))::BIGINT >= 2147483648
   THEN ('0x' || substr(md5(o_orderkey::VARCHAR), 25, 8))::BIGINT - 4294967296
   ELSE ('0x' || substr(md5(o_orderkey::VARCHAR), 25, 8))::BIGINT END % 8 + 1)::INTEGER"""


@query(
    "md5_bucket",
    f"SELECT o_orderkey, {BUCKET_SQL} AS bucket, 'partition=' || {BUCKET_SQL} AS label FROM orders",
)
def md5_bucket_query(spark, folder):
    bucket = md5_bucket("o_orderkey", 8)
    return table(spark, folder, "orders").select("o_orderkey", bucket.alias("bucket"), bucket_label(bucket).alias("label"))


@query("bucket_counts", f"SELECT {BUCKET_SQL} AS bucket, count(*) AS cnt FROM orders GROUP BY 1")
def bucket_counts(spark, folder):
    bucket = md5_bucket("o_orderkey", 8).alias("bucket")
    return table(spark, folder, "orders").groupBy(bucket).agg(F.count(F.lit(1)).alias("cnt"))


@query(
    "bucket_distinct",
    f"SELECT DISTINCT {BUCKET_SQL} AS bucket FROM orders",
)
def bucket_distinct(spark, folder):
    return table(spark, folder, "orders").select(md5_bucket("o_orderkey", 8).alias("bucket")).distinct()


@query(
    "bucket_eq_null_safe",
    f"""WITH b AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN {BUCKET_SQL} END AS bucket FROM orders)
        SELECT o_orderkey, bucket FROM b WHERE bucket IS NOT DISTINCT FROM 3 OR bucket IS NOT DISTINCT FROM NULL""",
)
def bucket_eq_null_safe(spark, folder):
    bucket = F.when(F.col("o_orderstatus") != "P", md5_bucket("o_orderkey", 8))
    rows = table(spark, folder, "orders").select("o_orderkey", bucket.alias("bucket"))
    return rows.filter(F.col("bucket").eqNullSafe(3) | F.col("bucket").eqNullSafe(F.lit(None)))


@query(
    "order_report",
    """SELECT l_partkey, count(*) AS order_lines, count(l_orderkey) AS detail_lines,
              sum(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS amount
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
       WHERE o_orderdate > TIMESTAMP '1998-03-20' GROUP BY l_partkey""",
)
def order_report_query(spark, folder):
    # exact decimals: the sum does not depend on the order of the rows
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    report = order_report(
        table(spark, folder, "orders"), table(spark, folder, "lineitem"), day("1998-03-20"),
        "o_orderkey", "l_orderkey", "l_partkey", "o_orderdate", price,
    )
    return report.withColumn("amount", F.col("amount").cast("double"))


DELTA_SINCE = "1998-01-01"
DELTA_SQL = f"""SELECT l_orderkey, l_suppkey, max(l_shipdate) AS LastUpdatedDate FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '{DELTA_SINCE}' GROUP BY 1, 2"""
IDS_SQL = f"""SELECT row_number() OVER (ORDER BY l_orderkey, l_suppkey) AS RowID, * FROM ({DELTA_SQL})"""


def line_delta(spark, folder):
    return aggregates.delta_keys(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_suppkey"], "l_shipdate", day(DELTA_SINCE)
    )


def line_ids(spark, folder):
    return rowid.row_ids(line_delta(spark, folder), ["l_orderkey", "l_suppkey"])


@query("delta_keys", DELTA_SQL)
def delta_keys(spark, folder):
    return line_delta(spark, folder)


@query("row_ids", IDS_SQL)
def row_ids(spark, folder):
    return line_ids(spark, folder)


@query("row_id_slice", f"SELECT * FROM ({IDS_SQL}) WHERE RowID >= 2001 AND RowID < 12001 ORDER BY RowID")
def row_id_slice(spark, folder):
    return rowid.row_slice(line_ids(spark, folder), 2001, 12001)


@query(
    "export_batches",
    f"""SELECT 'export.1998-01-01 00-00-00_2001-08-01 00-00-00.' || (b * 5000 + 1) || '-' || (b * 5000 + 5000) AS batch,
               count(*) AS lines, min(RowID) AS first_id, max(RowID) AS last_id
        FROM (SELECT *, (RowID - 1) // 5000 AS b FROM ({IDS_SQL})) GROUP BY b""",
)
def export_batches(spark, folder):
    label = batch_label("RowID", 5000, "1998-01-01 00-00-00", "2001-08-01 00-00-00", "export")
    return line_ids(spark, folder).groupBy(label.alias("batch")).agg(
        F.count(F.lit(1)).alias("lines"), F.min("RowID").alias("first_id"), F.max("RowID").alias("last_id")
    )


def line_plan(spark, folder) -> DeltaPlan:
    """The document of a line: ids, texts and lookups along order, customer, nation, part, supplier."""
    def source(name):
        return table(spark, folder, name)

    lookups = [
        Lookup(source("orders"), {"l_orderkey": "o_orderkey"}, {"o_custkey": "o_custkey", "priority": "o_orderpriority"}),
        Lookup(source("customer"), {"o_custkey": "c_custkey"}, {"c_name": "c_name", "c_nationkey": "c_nationkey"}),
        Lookup(source("nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "n_regionkey": "n_regionkey"}),
        Lookup(source("region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"}),
        Lookup(
            source("part"), {"l_partkey": "p_partkey"}, {"p_name": "p_name"},
            only=F.coalesce("p_type", F.lit("")) != "PROMO",
        ),
        Lookup(source("supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "s_name"}),
    ]
    columns = [
        F.col("RowID"),
        clean.composite_id("l_orderkey", "l_suppkey").alias("ULID"),
        F.col("l_partkey").alias("ProductID"),
        F.col("l_linenumber").alias("LineNumber"),
        F.col("l_shipdate").alias("LastUpdated"),
        clean.detail_slug("n_name", "c_name", "r_name", "l_orderkey", "l_suppkey").alias("DetailSlug"),
        clean.clean_string("p_name").alias("ProductName"),
        clean.slug("priority").alias("PrioritySlug"),
        clean.address("c_name", "n_name", "r_name").alias("Address"),
        clean.clean_string("s_name").alias("SupplierName"),
        F.col("l_returnflag").alias("Flag"),
    ]
    return DeltaPlan(
        keys=("l_orderkey", "l_suppkey", "l_partkey"), delta=("l_orderkey", "l_suppkey"), updated="l_shipdate",
        insert_only=("l_linenumber",), lookups=lookups, columns=columns,
    )


def slug_sql(c: str) -> str:
    return (
        "lower(regexp_replace(trim(translate("
        f"{c}, '-&\"_@(),/\\[]<>{{}}.;%' || chr(13) || chr(10) || chr(9) || chr(12) || chr(11), repeat(' ', 25))), ' +', '-', 'g'))"
    )


def document_sql(static: str, ids: str) -> str:
    """The document of ``line_plan`` over a rows table and an ids table."""
    return f"""SELECT RowID, 'U' || a.l_orderkey || 'L' || a.l_suppkey AS ULID, l_partkey AS ProductID,
      l_linenumber AS LineNumber, l_shipdate AS LastUpdated,
      coalesce({slug_sql('n_name')}, '') || '/' || coalesce({slug_sql('c_name')}, '') || '-'
        || coalesce({slug_sql('r_name')}, '') || '-' || coalesce({slug_sql('n_name')}, '')
        || '-U' || a.l_orderkey || 'L' || a.l_suppkey AS DetailSlug,
      trim(p_name) AS ProductName, {slug_sql('o_orderpriority')} AS PrioritySlug,
      trim(coalesce(c_name, '') || ' ' || coalesce(n_name, '') || ' ' || coalesce(r_name, '')) AS Address,
      trim(s_name) AS SupplierName, l_returnflag AS Flag
    FROM {static} a JOIN {ids} i ON a.l_orderkey = i.l_orderkey AND a.l_suppkey = i.l_suppkey
    LEFT JOIN orders ON a.l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN part ON l_partkey = p_partkey AND coalesce(p_type, '') <> 'PROMO'
    LEFT JOIN supplier ON a.l_suppkey = s_suppkey"""


@query("denormalise", document_sql("lineitem", f"({IDS_SQL})"))
def denormalise_query(spark, folder):
    return denormalise(table(spark, folder, "lineitem"), line_ids(spark, folder), line_plan(spark, folder))


@query(
    "pivot_attributes",
    "SELECT o_custkey, "
    + ", ".join(
        f"max(CASE WHEN month(o_orderdate) = {m} THEN o_orderpriority END) AS Q{m}" for m in range(1, 13)
    )
    + " FROM orders GROUP BY 1",
)
def pivot_attributes(spark, folder):
    rows = table(spark, folder, "orders").withColumn("col_id", F.month("o_orderdate"))
    return aggregates.pivot_max(rows, ["o_custkey"], "col_id", "o_orderpriority", list(range(1, 13)), prefix="Q")


@query(
    "suggest_counts",
    """SELECT p_brand AS "groupby", sum(p_size)::BIGINT AS "count" FROM part WHERE p_type <> 'PROMO' GROUP BY 1""",
)
def suggest_counts(spark, folder):
    entries = table(spark, folder, "part").select(
        F.col("p_brand").alias("groupby"),
        F.col("p_size").alias("count"),
        F.when(F.col("p_type") == "PROMO", 1).otherwise(0).alias("deleted"),
    )
    return aggregates.suggestion_counts(entries)


@query(
    "filter_project",
    "SELECT o_orderdate, o_totalprice, o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1998-03-20'",
)
def filter_project(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.filter(F.col("o_orderdate") > day("1998-03-20")).select("o_orderdate", "o_totalprice", "o_orderkey")


@query(
    "composite_join",
    f"""SELECT l.l_orderkey, l.l_suppkey, l_partkey, l_linenumber, LastUpdatedDate
        FROM lineitem l JOIN ({DELTA_SQL}) d ON l.l_orderkey = d.l_orderkey AND l.l_suppkey = d.l_suppkey""",
)
def composite_join(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber")
    return lines.join(line_delta(spark, folder), ["l_orderkey", "l_suppkey"])


@query(
    "conditional_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem
       LEFT JOIN part ON l_partkey = p_partkey AND coalesce(p_type, '') <> 'PROMO'""",
)
def conditional_lookup(spark, folder):
    from tidemark.operators.lookups import lookup_join

    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    part = Lookup(
        table(spark, folder, "part"), {"l_partkey": "p_partkey"}, {"p_name": "p_name"},
        only=F.coalesce("p_type", F.lit("")) != "PROMO",
    )
    return lookup_join(lines, [part])
