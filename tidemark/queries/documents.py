"""The 99-column search document over lines, with dimensions made from the other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.aggregates import delta_keys
from tidemark.operators.rowid import row_ids
from tidemark.plans.delta_job import (
    LABEL_IDS, DeltaPlan, denormalise, document_columns, document_lookups, document_rules,
)
from tidemark.queries import query
from tidemark.queries.rows import day, slug_sql
from tidemark.sources.files import table

SINCE = "2001-01-01"
LOOKED_UP = {"RowID", "CitySynonyms", "CompanyAliases", "AdvertiserURL", *[f"Q{n}" for n in LABEL_IDS]}
ADDRESS = ("yladd", "ylbdnam", "ylsloc")
# flat columns with a meaning of their own; every other one is made from its name
GIVEN = {
    "yusrid": "l_orderkey", "intgen1": "l_suppkey", "batvypid": "l_partkey", "ypcat3id": "l_partkey",
    "batvycoid": "l_suppkey", "upddate": "l_shipdate", "ypbusinessid": "l_linenumber",
}


def text_columns() -> list[str]:
    used = {s for _, rule, s in document_rules() if rule in ("plain", "clean", "slug")}
    return sorted((used | set(ADDRESS)) - LOOKED_UP - set(GIVEN) - {"ccty"})


def clean_sql(c: str) -> str:
    lines = "chr(13) || chr(10) || chr(9) || chr(12) || chr(11)"
    return f"""trim(replace(translate({c}, {lines}, '     '), '"', '\\"'))"""


def flat_sql() -> str:
    given = ", ".join(f"{source} AS {name}" for name, source in GIVEN.items())
    made = ", ".join(
        f"""' {c}' || chr(9) || l_returnflag || ' & "' || l_linenumber || '"' AS {c}""" for c in text_columns()
    )
    return f"SELECT {given}, 'NATION_' || l_linenumber AS ccty, {made} FROM lineitem"


def flat_rows(lines):
    """Lines as flat rows with every column the document reads."""
    number = F.col("l_linenumber").cast("string")
    made = [
        F.concat(F.lit(f" {c}\t"), F.col("l_returnflag"), F.lit(' & "'), number, F.lit('"')).alias(c)
        for c in text_columns()
    ]
    given = [F.col(source).alias(name) for name, source in GIVEN.items()]
    return lines.select(*given, F.concat(F.lit("NATION_"), number).alias("ccty"), *made)


def dimensions(spark, folder) -> dict:
    """Categories and templates from parts, companies from suppliers and nations, sites from lines."""
    def source(name):
        return table(spark, folder, name)

    parts, nations = source("part"), source("nation")
    return {
        "category3": parts.select(F.col("p_partkey").alias("cat3_id"), F.col("p_size").alias("Additionalinfotemplate_id")),
        "AdditionalInfoTemplate": parts.select(
            F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("AdditionalInfoTemplate_id"),
            F.col("p_size").alias("AdditionalInfoTemplate_id_new"),
        ).distinct(),
        "TemplateFields": parts.select(
            F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string")).alias("AdditionalInfoTemplate_id"),
            (F.col("p_partkey") % 25 + 1).alias("Col_id"),
            F.col("p_name").alias("Label"),
        ),
        "BusinessInfo": source("supplier").select(F.col("s_suppkey").alias("business_id"), F.col("s_nationkey").alias("user_id")),
        "users": nations.select(F.col("n_nationkey").alias("user_id"), F.col("n_regionkey").alias("Master_id")),
        "DMSMaster": source("region").select(
            F.col("r_regionkey").alias("Master_Id"), F.concat(F.lit(" "), "r_name").alias("CompanySynonym")
        ),
        "companylocation": source("lineitem").select(
            F.col("l_suppkey").alias("id"), F.col("l_orderkey").alias("user_id"), F.col("l_linestatus").alias("website")
        ),
        "City": nations.select(
            F.col("n_name").alias("city"),
            F.when(F.col("n_regionkey") > 0, F.concat(F.lit("region "), F.col("n_regionkey").cast("string")))
            .otherwise("").alias("Synonyms"),
        ),
    }


def document_sql() -> str:
    """The document by joining everything, then grouping by all columns and pivoting."""
    ulid = "'U' || yusrid || 'L' || intgen1"

    def column(name, rule, source):
        if rule == "id":
            return ulid
        if rule == "detail":
            city, company, area = slug_sql("ccty"), slug_sql("yconam"), slug_sql("ylloc")
            return f"{city} || '/' || {company} || '-' || {area} || '-' || {city} || '-' || {ulid}"
        if rule == "address":
            return clean_sql("yladd || ' ' || ylbdnam || ' ' || ylsloc")
        if source in ("CitySynonyms", "CompanyAliases", "AdvertiserURL"):
            return clean_sql({"CitySynonyms": "Synonyms", "CompanyAliases": "CompanySynonym"}.get(source, "website"))
        return {"clean": clean_sql, "slug": slug_sql}.get(rule, str)(source)

    rules = [r for r in document_rules() if not r[2].startswith("Q")]
    names = ", ".join(f'"{name}"' for name, _, _ in rules)
    wide = ", ".join(f'{column(*r)} AS "{r[0]}"' for r in rules)
    pivot = ", ".join(f'max(CASE WHEN col_id = {n} THEN label END) AS "Q{n}"' for n in LABEL_IDS)
    return f"""WITH flat AS ({flat_sql()}),
      ids AS (SELECT yusrid AS i_u, intgen1 AS i_l, row_number() OVER (ORDER BY yusrid, intgen1) AS RowID
        FROM (SELECT DISTINCT yusrid, intgen1 FROM flat WHERE upddate >= TIMESTAMP '{SINCE}')),
      templates AS (SELECT DISTINCT p_brand || '/' || p_size AS template, p_size AS new FROM part),
      fields AS (SELECT p_brand || '/' || p_size AS f_template, p_partkey % 25 + 1 AS col_id, p_name AS label FROM part),
      labels AS (SELECT p_partkey AS cat, col_id, label FROM part JOIN templates ON p_size = new
        JOIN fields ON template = f_template),
      picked AS (SELECT cat, col_id, max(label) AS label FROM labels GROUP BY ALL),
      inn AS (SELECT {wide}, col_id, label FROM flat JOIN ids ON yusrid = i_u AND intgen1 = i_l
        LEFT JOIN picked ON ypcat3id = cat
        LEFT JOIN supplier ON batvycoid = s_suppkey
        LEFT JOIN (SELECT n_nationkey, n_regionkey FROM nation) u ON s_nationkey = n_nationkey
        LEFT JOIN (SELECT r_regionkey, ' ' || r_name AS CompanySynonym FROM region) m ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT DISTINCT l_suppkey AS h_id, l_orderkey AS h_u, l_linestatus AS website FROM lineitem) h
          ON intgen1 = h_id AND yusrid = h_u
        LEFT JOIN (SELECT n_name AS i_city, CASE WHEN n_regionkey > 0 THEN 'region ' || n_regionkey ELSE '' END AS Synonyms
          FROM nation) i ON ccty = i_city AND coalesce(Synonyms, '') <> '')
      SELECT {names}, {pivot} FROM inn GROUP BY {names}"""


@query("search_document", document_sql())
def search_document(spark, folder):
    """Documents of the keys changed since a date.

    Lines can be repeated as a whole, which the grouping of a pivot removes;
    here the repeats go before the wide rows are built.
    """
    lines = table(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_suppkey"]
    changed = delta_keys(lines, keys, "l_shipdate", day(SINCE))
    ids = row_ids(changed, keys).withColumnsRenamed({"l_orderkey": "yusrid", "l_suppkey": "intgen1"})
    used = lines.select(*keys, "l_partkey", "l_linenumber", "l_returnflag", "l_shipdate")
    rows = flat_rows(used.join(changed.select(*keys), keys, "left_semi").distinct())
    plan = DeltaPlan(lookups=document_lookups(dimensions(spark, folder)), columns=document_columns())
    return denormalise(rows, ids, plan)
