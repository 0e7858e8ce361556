"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import buckets, clean, convert, times
from tidemark.queries import query
from tidemark.queries.rows import slug_sql
from tidemark.sources.files import table
from tidemark.sources.kafka import change_records, row_json
from tidemark.specs import TABLE_FIELDS, parse_record

DATE_TEXT_SQL = """CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority = '5-LOW' THEN ''
                   ELSE o_orderdate::VARCHAR END"""


def date_text():
    return F.when(F.col("o_orderstatus") == "P", None).when(
        F.col("o_orderpriority") == "5-LOW", F.lit("")
    ).otherwise(F.col("o_orderdate").cast("string"))


@query(
    "prefix_partition",
    f"""WITH t AS (SELECT o_orderkey, {DATE_TEXT_SQL} AS d FROM orders)
        SELECT o_orderkey,
          'o_orderdate=' || coalesce(regexp_replace(substr(nullif(d, ''), 1, 10), '[^A-Za-z0-9]', '_', 'g'),
                                     'defaultNullPartition') AS label,
          'dt=' || substr(d, 1, 10) AS dt FROM t""",
)
def prefix_partition(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        buckets.prefix_partition(date_text(), "o_orderdate").alias("label"),
        buckets.dt_partition(date_text()).alias("dt"),
    )


@query(
    "convert_types",
    """SELECT p_partkey::INTEGER AS p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size,
              p_retailprice::DOUBLE AS p_retailprice FROM part""",
)
def convert_types(spark, folder):
    overrides = {"p_partkey": "int", "p_size": "bigint", "p_retailprice": "float", "p_brand": "varchar", "p_name": "none"}
    return convert.convert_target_types(table(spark, folder, "part"), overrides)


@query(
    "convert_all_string",
    """SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size,
              p_retailprice::VARCHAR AS p_retailprice FROM part""",
)
def convert_all_string(spark, folder):
    return convert.convert_target_types(table(spark, folder, "part"), all_string=True)


MESSY_SQL = """SELECT event_id, CASE event_id % 8 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN value::VARCHAR
    WHEN 2 THEN event_type WHEN 3 THEN ' ' || event_id || ' ' WHEN 4 THEN '' WHEN 5 THEN NULL
    WHEN 6 THEN event_id || 'd' ELSE event_id || '0000000000' END AS raw FROM events"""
INT_SQL = "CASE WHEN regexp_matches(raw, '^[+-]?[0-9]+$') THEN try_cast(raw AS {}) END"
DOUBLE_SQL = (
    r"CASE WHEN regexp_matches(raw, '^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?\s*$')"
    " THEN try_cast(regexp_replace(trim(raw), '[dDfF]$', '') AS DOUBLE) END"
)


def messy(spark, folder):
    """Text of every event that is a number, a decimal, a word, padded, empty, NULL, suffixed or too long."""
    kind = F.col("event_id") % 8
    number = F.col("event_id").cast("string")
    raw = (
        F.when(kind == 0, number)
        .when(kind == 1, F.col("value").cast("string"))
        .when(kind == 2, F.col("event_type"))
        .when(kind == 3, F.concat(F.lit(" "), number, F.lit(" ")))
        .when(kind == 4, F.lit(""))
        .when(kind == 5, F.lit(None))
        .when(kind == 6, F.concat(number, F.lit("d")))
        .otherwise(F.concat(number, F.lit("0000000000")))
    )
    return table(spark, folder, "events").select("event_id", raw.alias("raw"))


@query(
    "cast_skip",
    f"""SELECT event_id, {INT_SQL.format('INTEGER')} AS as_int, {INT_SQL.format('BIGINT')} AS as_long,
               {DOUBLE_SQL} AS as_double FROM ({MESSY_SQL})""",
)
def cast_skip(spark, folder):
    return messy(spark, folder).select(
        "event_id",
        convert.convert("raw", "int").alias("as_int"),
        convert.convert("raw", "bigint").alias("as_long"),
        convert.convert("raw", "double").alias("as_double"),
    )


@query(
    "cast_report",
    f"""SELECT event_id, colname, target, raw AS value FROM (
          SELECT event_id, 'raw' AS colname, 'int' AS target, raw, {INT_SQL.format('INTEGER')} IS NULL AS bad
          FROM ({MESSY_SQL})) WHERE bad AND raw IS NOT NULL""",
)
def cast_report(spark, folder):
    return convert.rejects(messy(spark, folder), {"raw": "int"}, keep=["event_id"])


@query(
    "cast_numbers",
    """SELECT event_id, event_id::DOUBLE AS id_double, event_id::VARCHAR AS id_text,
              trunc(value)::INTEGER AS value_int, trunc(value)::BIGINT AS value_long, value::VARCHAR AS value_text,
              CASE WHEN event_id * 1000000 <= 2147483647 THEN (event_id * 1000000)::INTEGER END AS id_int
       FROM events""",
)
def cast_numbers(spark, folder):
    def number(c, target):
        return convert.convert(c, target, from_text=False)

    return table(spark, folder, "events").select(
        "event_id",
        number("event_id", "double").alias("id_double"),
        number("event_id", "string").alias("id_text"),
        number("value", "int").alias("value_int"),
        number("value", "bigint").alias("value_long"),
        number("value", "string").alias("value_text"),
        number(F.col("event_id") * 1000000, "int").alias("id_int"),
    )


@query(
    "clean_string",
    """SELECT doc_id, trim(replace(translate(text, chr(13) || chr(10) || chr(9) || chr(12) || chr(11), '     '),
              '"', '\\"')) AS cleaned FROM documents""",
)
def clean_string(spark, folder):
    return table(spark, folder, "documents").select("doc_id", clean.clean_string("text").alias("cleaned"))


@query(
    "slug",
    f"""SELECT 'd' || doc_id AS id, {slug_sql('text')} AS slug FROM documents
        UNION ALL SELECT 'p' || p_partkey, {slug_sql("p_name || ' (' || p_brand || ')'")} FROM part
        UNION ALL SELECT 'c' || c_custkey, {slug_sql("c_name || ' & ' || c_mktsegment")} FROM customer""",
)
def slug(spark, folder):
    def rows(name, mark, key, text):
        return table(spark, folder, name).select(
            F.concat(F.lit(mark), F.col(key).cast("string")).alias("id"), clean.slug(text).alias("slug")
        )

    documents = rows("documents", "d", "doc_id", "text")
    parts = rows("part", "p", "p_partkey", F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")))
    customers = rows("customer", "c", "c_custkey", F.concat("c_name", F.lit(" & "), "c_mktsegment"))
    return documents.unionByName(parts).unionByName(customers)


def places(spark, folder):
    """Customers with nation and region names; some names are missing."""
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return joined.withColumn("area", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("r_name")))


PLACES_SQL = """SELECT *, CASE WHEN c_mktsegment <> 'MACHINERY' THEN r_name END AS area FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""


@query(
    "detail_slug",
    f"""SELECT c_custkey, {slug_sql('n_name')} || '/' || {slug_sql('c_name')} || '-' || coalesce({slug_sql('area')}, '')
          || '-' || {slug_sql('n_name')} || '-U' || c_custkey || 'L' || c_nationkey AS detail,
          'U' || c_custkey || 'L' || c_nationkey AS ulid FROM ({PLACES_SQL})""",
)
def detail_slug(spark, folder):
    return places(spark, folder).select(
        "c_custkey",
        clean.detail_slug("n_name", "c_name", "area", "c_custkey", "c_nationkey").alias("detail"),
        clean.composite_id("c_custkey", "c_nationkey").alias("ulid"),
    )


@query(
    "address",
    f"SELECT c_custkey, trim(c_name || ' ' || coalesce(area, '') || ' ' || n_name) AS address FROM ({PLACES_SQL})",
)
def address(spark, folder):
    return places(spark, folder).select("c_custkey", clean.address("c_name", "area", "n_name").alias("address"))


@query("sanitize_identifier", "SELECT c_custkey, regexp_replace(c_name, '[^A-Za-z0-9]', '_', 'g') AS name FROM customer")
def sanitize_identifier(spark, folder):
    return table(spark, folder, "customer").select("c_custkey", clean.sanitize_identifier("c_name").alias("name"))


@query("error_text", "SELECT doc_id, regexp_replace(substr(text, 1, 100), '[^a-zA-Z]', '', 'g') AS error FROM documents")
def error_text(spark, folder):
    # the first 100 characters are the rule of this operator, not a sample
    return table(spark, folder, "documents").select("doc_id", clean.error_text("text").alias("error"))


@query(
    "non_empty_else",
    f"SELECT o_orderkey, coalesce(nullif({DATE_TEXT_SQL}, ''), o_orderpriority) AS value FROM orders",
)
def non_empty_else(spark, folder):
    value = clean.non_empty_else(date_text(), F.col("o_orderpriority"))
    return table(spark, folder, "orders").select("o_orderkey", value.alias("value"))


def _json_escape_sql(c: str) -> str:
    sql = f"replace(replace({c}, '\\', '\\\\'), '\"', '\\\"')"
    for code in range(1, 0x20):
        sql = f"replace({sql}, chr({code}), '\\u{code:04x}')"
    return sql


@query("json_escape", f"SELECT doc_id, {_json_escape_sql('text')} AS escaped FROM documents")
def json_escape(spark, folder):
    return table(spark, folder, "documents").select("doc_id", clean.json_escape("text").alias("escaped"))


URL_PATTERN = "([a-z_]+)=([a-z0-9]+)"


@query(
    "regex_tokens",
    f"""SELECT page_id, coalesce(array_to_string(list_transform(list_zip(
          regexp_extract_all(url, '{URL_PATTERN}', 1), regexp_extract_all(url, '{URL_PATTERN}', 2)),
          lambda x: x[1] || ':' || x[2]), '|'), '') AS groups FROM pages""",
)
def regex_tokens(spark, folder):
    found = clean.regex_tokens("url", URL_PATTERN, 2)
    flat = F.array_join(F.transform(found, lambda x: F.array_join(x, ":")), "|")
    return table(spark, folder, "pages").select("page_id", flat.alias("groups"))


@query(
    "zero_date_null",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN o_orderdate END AS stamp
       FROM orders""",
)
def zero_date_null(spark, folder):
    text = (
        F.when(F.col("o_orderstatus") == "P", F.lit("0000-00-00 00:00:00"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
        .otherwise(F.col("o_orderdate").cast("string"))
    )
    return table(spark, folder, "orders").select("o_orderkey", times.zero_date_null(text).alias("stamp"))


@query("filename_stamp", "SELECT event_id, strftime(ts, '%Y-%m-%d %H-%M-%S') AS stamp FROM events")
def filename_stamp(spark, folder):
    return table(spark, folder, "events").select("event_id", times.filename_stamp("ts").alias("stamp"))


@query(
    "minutes_between",
    """SELECT event_id, trunc((epoch_us(date_trunc('day', ts) + INTERVAL 12 HOUR) - epoch_us(ts)) / 60000000.0)::BIGINT
       AS minutes FROM events""",
)
def minutes_between(spark, folder):
    noon = F.date_trunc("day", "ts") + F.expr("INTERVAL 12 HOURS")
    return table(spark, folder, "events").select("event_id", times.minutes_between("ts", noon).alias("minutes"))


FREQUENCIES = ["30 min", "2 hours", "1 day", "3 weeks", "1 month", "soon", "x days", "5  hours"]
# the last has an empty unit between two blanks, which counts as months
FREQUENCY_MINUTES = [30, 120, 1440, 30240, 43200, 1440, 1440, 216000]


def frequency():
    return F.element_at(F.array(*[F.lit(f) for f in FREQUENCIES]), (F.col("o_orderkey") % 8 + 1).cast("int"))


UNITS = ["min", "Minutes", "hour", "HOURS", "day", "weeks", "month", "fortnight"]


@query(
    "freq_minutes",
    f"""WITH f AS (SELECT o_orderkey, o_orderkey % 61 AS n, lower({UNITS}[o_orderkey % 8 + 1]) AS unit FROM orders)
        SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 1440 WHEN unit LIKE '%min%' THEN n
          WHEN unit LIKE '%hour%' THEN n * 60 WHEN unit LIKE '%day%' THEN n * 24 * 60
          WHEN unit LIKE '%week%' THEN n * 7 * 24 * 60 ELSE n * 30 * 24 * 60 END::BIGINT AS minutes FROM f""",
)
def freq_minutes(spark, folder):
    """Every order with a frequency of its own: a number, in one of 13 rows unreadable, and a unit."""
    key = F.col("o_orderkey")
    unit = F.element_at(F.array(*[F.lit(u) for u in UNITS]), (key % 8 + 1).cast("int"))
    number = F.when(key % 13 == 0, F.lit("some")).otherwise((key % 61).cast("string"))
    text = F.concat(F.lit(" "), number, F.lit(" "), unit)
    return table(spark, folder, "orders").select("o_orderkey", times.freq_minutes(text).alias("minutes"))


ROW_JSON_SQL = """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","segment":'
  || CASE WHEN c_mktsegment = 'MACHINERY' THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}'"""


def customer_fields(spark, folder):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return table(spark, folder, "customer").select("c_custkey", "c_name", segment.alias("segment"))


@query("row_json", f"SELECT c_custkey, {ROW_JSON_SQL} AS value FROM customer")
def row_json_query(spark, folder):
    return customer_fields(spark, folder).select("c_custkey", row_json("c_custkey", "c_name", "segment").alias("value"))


@query(
    "change_records",
    f"SELECT 'TOPIC_shop_customer' AS topic, 'shop' AS key, {ROW_JSON_SQL} AS value FROM customer",
)
def change_records_query(spark, folder):
    return change_records(customer_fields(spark, folder), "shop", "customer")


@query(
    "parse_json",
    r"SELECT event_id, regexp_extract(props, '\"k\": ?([0-9]+)', 1)::BIGINT AS k FROM events",
)
def parse_json(spark, folder):
    parsed = F.from_json("props", "k bigint")
    return table(spark, folder, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "parse_request",
    """SELECT o_orderkey, 'host' || o_custkey AS host, '3306' AS port, 'table' || o_orderkey AS dbtable,
              o_orderstatus = 'P' AS toDruid, '8' AS numOfPartitions, 'skip' AS treatment FROM orders""",
)
def parse_request(spark, folder):
    def entry(name):
        given = {
            "host": F.concat(F.lit("'host"), F.col("o_custkey").cast("string"), F.lit("'")),
            "port": F.lit("'3306'"),
            "table": F.concat(F.lit("'table"), F.col("o_orderkey").cast("string"), F.lit("'")),
            "toDruid": (F.col("o_orderstatus") == "P").cast("string"),
            "numOfPartitions": F.lit("'8'"),
            "treatment": F.lit("'skip'"),
        }
        return F.concat(F.lit(f"'{name}':"), given.get(name, F.lit("''")))

    record = F.concat(F.lit("{"), F.concat_ws(",", *[entry(n) for n in TABLE_FIELDS]), F.lit("}"))
    job = parse_record(record, TABLE_FIELDS)
    parsed = table(spark, folder, "orders").select("o_orderkey", job.alias("job"))
    return parsed.select(
        "o_orderkey", "job.host", "job.port", F.col("job.table").alias("dbtable"),
        "job.toDruid", "job.numOfPartitions", "job.treatment",
    )
