"""Tokens, stems, shingles and n-grams over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import grams, tokens
from tidemark.functions.stem import participle_stem, plural_stem
from tidemark.queries import query
from tidemark.sources.files import table

WORDS_SQL = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+')"
DOC_WORDS = WORDS_SQL.format("text")

TEXTS_SQL = "SELECT text FROM documents UNION ALL SELECT text FROM conversations"
VOCAB_SQL = f"SELECT term, count(*) AS n FROM (SELECT unnest({DOC_WORDS}) AS term FROM ({TEXTS_SQL})) GROUP BY 1"


def shape_sql(word: str) -> str:
    """Consonant/vowel string of a word, letter by letter."""
    return f"""list_reduce(string_split({word}, ''), lambda acc, c: acc || CASE
        WHEN c IN ('a', 'e', 'i', 'o', 'u') THEN 'V'
        WHEN c = 'y' AND acc <> '' AND right(acc, 1) = 'C' THEN 'V' ELSE 'C' END, '')"""


# stems of a vocabulary (term, n): s = the word after the s rules, e = the
# final-e rule applies, cv = shape of s, m = measure, b = letter before the e
PLURAL_SQL = """
  p1 AS (SELECT term, n, CASE WHEN length(term) < 3 OR right(term, 1) <> 's' THEN term
      WHEN right(term, 4) = 'sses' THEN left(term, length(term) - 2)
      WHEN right(term, 3) = 'ies' THEN left(term, length(term) - 3) || 'y'
      WHEN right(left(term, length(term) - 1), 1) NOT IN ('s', 'u', 'i') THEN left(term, length(term) - 1)
      ELSE term END AS s FROM vocab),
  p2 AS (SELECT *, s <> term AND right(term, 3) <> 'ies' AND right(s, 1) = 'e' AS e FROM p1),
  p3 AS (SELECT *, CASE WHEN e THEN {shape} END AS cv, left(s, length(s) - 1) AS d, length(s) AS k FROM p2),
  p4 AS (SELECT *, (length(cv) - length(replace(cv, 'VC', ''))) // 2 AS m, right(d, 1) AS b,
      CASE WHEN k >= 3 THEN right(left(s, k - 2), 1) ELSE '' END AS bb FROM p3),
  stems AS (SELECT term, n, CASE WHEN e
      AND (m > 1 OR (m = 1 AND NOT (k >= 4 AND substr(cv, k - 3, 3) = 'CVC' AND b NOT IN ('w', 'x', 'y'))))
      AND NOT (b IN ('l','r','v','u','g','c','t','n','m','s','d','p','b','e','z')
        OR (b = 'h' AND (k = 2 OR bb = 't'))
        OR (b = 'k' AND (k = 2 OR substr(cv, k - 2, 1) = 'V')))
      THEN d ELSE s END AS stem FROM p4)""".format(shape=shape_sql("s"))

PARTICIPLE_SQL = """
  g1 AS (SELECT term, n, right(term, 3) = 'ing' AND length(term) > 3 AS g,
      CASE WHEN right(term, 3) = 'ing' THEN left(term, length(term) - 3) ELSE '' END AS w FROM vocab),
  g2 AS (SELECT *, CASE WHEN g THEN {shape} ELSE '' END AS cv, length(w) AS k, right(w, 1) AS c,
      CASE WHEN length(w) > 1 THEN substr(w, length(w) - 1, 1) ELSE '' END AS p,
      CASE WHEN length(w) > 2 THEN substr(w, length(w) - 2, 1) ELSE '' END AS q FROM g1),
  g3 AS (SELECT *, (length(cv) - length(replace(cv, 'VC', ''))) // 2 AS m FROM g2),
  stems AS (SELECT term, n, CASE WHEN NOT g THEN term
      WHEN c IN ('w', 'x', 'y') THEN CASE WHEN k = 2 THEN left(w, 1) || 'ie' ELSE w END
      WHEN right(cv, 1) = 'V' OR k < 2 THEN w
      WHEN c = p AND NOT (c = 'l' AND m = 1) THEN CASE WHEN c = 's' THEN w ELSE left(w, k - 1) END
      WHEN substr(cv, k - 1, 1) = 'V' THEN CASE
        WHEN c IN ('s', 'g', 'p') OR (p = 'u' AND c = 'r') OR (k >= 3 AND (
             (q <> 'o' AND p = 'u') OR (q NOT IN ('e', 'o') AND p = 'a')
          OR (q NOT IN ('o', 'i') AND p = 'o' AND c <> 'n' AND m <= 2)
          OR (q <> 'a' AND p = 'i' AND (m <> 2 OR c <> 't')))) THEN w || 'e' ELSE w END
      WHEN c = 'k' AND p = 'c' AND m > 1 THEN left(w, k - 1)
      WHEN p <> 'l' AND c = 'l' THEN w || 'e'
      WHEN p = 'r' AND c IN ('s', 'g', 'v') THEN w || 'e'
      ELSE w END AS stem FROM g3)""".format(shape=shape_sql("w"))


def vocabulary(spark, folder):
    """Distinct words with their counts, counted within each task first."""
    texts = table(spark, folder, "documents").select("text").unionByName(
        table(spark, folder, "conversations").select("text")
    )
    words = tokens.one_per_row(texts, tokens.tokens("text"), "term")
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("plural_stem", f"WITH vocab AS ({VOCAB_SQL}), {PLURAL_SQL} SELECT term, n, stem FROM stems")
def plural_stem_query(spark, folder):
    return vocabulary(spark, folder).withColumn("stem", plural_stem("term"))


@query("participle_stem", f"WITH vocab AS ({VOCAB_SQL}), {PARTICIPLE_SQL} SELECT term, n, stem FROM stems")
def participle_stem_query(spark, folder):
    return vocabulary(spark, folder).withColumn("stem", participle_stem("term"))


@query(
    "stem_controls",
    f"""WITH vocab AS ({VOCAB_SQL}), {PLURAL_SQL}
        SELECT term, n, CASE WHEN length(term) < 5 OR term IN ('thes', 'ases') THEN term ELSE stem END AS stem
        FROM stems""",
)
def stem_controls(spark, folder):
    return vocabulary(spark, folder).withColumn("stem", plural_stem("term", block=["thes", "ases"], min_len=5))


DOC_TOKENS_SQL = f"""SELECT doc_id, unnest({DOC_WORDS}) AS term, generate_subscripts({DOC_WORDS}, 1) AS pos
  FROM documents"""
DOC_STEMS_SQL = f"""WITH toks AS ({DOC_TOKENS_SQL}),
  vocab AS (SELECT term, count(*) AS n FROM toks GROUP BY 1), {PLURAL_SQL},
  marked AS (SELECT t.doc_id, t.pos, t.term, s.stem FROM toks t JOIN stems s ON t.term = s.term)"""


def documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def doc_stream(spark, folder):
    return documents(spark, folder).select("doc_id", tokens.token_stream(tokens.tokens("text")).alias("stream"))


def flagged(stream):
    return F.size(F.filter(stream, lambda t: t["flags"].bitwiseAND(F.lit(1)) == 1))


@query(
    "stem_replace",
    f"""{DOC_STEMS_SQL} SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS stemmed,
          count(*) FILTER (stem <> term)::INTEGER AS changed FROM documents LEFT JOIN marked USING (doc_id) GROUP BY 1""",
)
def stem_replace(spark, folder):
    stemmed = doc_stream(spark, folder).withColumn("stream", tokens.stem_replace(F.col("stream"), plural_stem))
    return stemmed.select(
        "doc_id", tokens.recombine(F.col("stream")).alias("stemmed"), flagged(F.col("stream")).alias("changed")
    )


@query(
    "stem_augment",
    f"""{DOC_STEMS_SQL} SELECT doc_id,
          string_agg(CASE WHEN stem <> term THEN term || ' ' || stem ELSE term END, ' ' ORDER BY pos) AS augmented,
          (count(term) + count(*) FILTER (stem <> term))::INTEGER AS tokens, max(pos)::INTEGER AS positions
        FROM documents LEFT JOIN marked USING (doc_id) GROUP BY 1""",
)
def stem_augment(spark, folder):
    stream = F.col("stream")
    added = doc_stream(spark, folder).withColumn("stream", tokens.stem_augment(stream, plural_stem))
    last = F.get(stream, F.size(stream) - 1)["pos"] + 1
    return added.select(
        "doc_id", tokens.recombine(stream).alias("augmented"), F.size(stream).alias("tokens"), last.alias("positions")
    )


@query(
    "stem_term_freq",
    f"WITH vocab AS ({VOCAB_SQL}), {PLURAL_SQL} SELECT stem, sum(n)::BIGINT AS n, count(*) AS forms FROM stems GROUP BY 1",
)
def stem_term_freq(spark, folder):
    # stems are computed per distinct word; the counts were added up before
    stems = vocabulary(spark, folder).withColumn("stem", plural_stem("term"))
    return stems.groupBy("stem").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))


@query(
    "token_flags",
    f"""{DOC_STEMS_SQL}, flags AS (SELECT term, (CASE WHEN stem <> term THEN 1 ELSE 0 END
          + CASE WHEN length(term) > 12 THEN 8 ELSE 0 END)::INTEGER AS flags FROM marked)
        SELECT flags, count(*) AS tokens FROM flags GROUP BY 1""",
)
def token_flags(spark, folder):
    def long_words(t):
        flags = F.when(F.length(t["term"]) > 12, tokens.mark(F.lit(0), 3)).otherwise(F.lit(0))
        return t.withField("flags", flags)

    stream = F.transform(F.col("stream"), long_words)
    marked = doc_stream(spark, folder).select(tokens.stem_replace(stream, plural_stem).alias("stream"))
    flags = tokens.one_per_row(marked, F.col("stream")["flags"], "flags")
    return flags.groupBy("flags").agg(F.count(F.lit(1)).alias("tokens"))


@query(
    "participle_replace",
    f"""WITH toks AS ({DOC_TOKENS_SQL}), vocab AS (SELECT term, count(*) AS n FROM toks GROUP BY 1), {PARTICIPLE_SQL}
        SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS stemmed
        FROM documents LEFT JOIN toks t USING (doc_id) LEFT JOIN stems s ON t.term = s.term GROUP BY 1""",
)
def participle_replace(spark, folder):
    stemmed = doc_stream(spark, folder).withColumn("stream", tokens.stem_replace(F.col("stream"), participle_stem))
    return stemmed.select("doc_id", tokens.recombine(F.col("stream")).alias("stemmed"))


@query("recombine", f"SELECT doc_id, nullif(array_to_string({DOC_WORDS}, '_'), '') AS joined FROM documents")
def recombine(spark, folder):
    return doc_stream(spark, folder).select("doc_id", tokens.recombine(F.col("stream"), "_").alias("joined"))


@query(
    "tokens",
    f"""SELECT term, count(*) AS n, count(DISTINCT doc_id) AS docs
        FROM (SELECT doc_id, unnest({DOC_WORDS}) AS term FROM documents) GROUP BY 1""",
)
def token_counts(spark, folder):
    """Term and document frequency: counted per row first, so one shuffle serves both."""
    words = tokens.one_per_row(documents(spark, folder), tokens.tokens("text"), "term", "doc_id")
    per_doc = words.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("k"))
    return per_doc.groupBy("term").agg(F.sum("k").alias("n"), F.count(F.lit(1)).alias("docs"))


NAMES_SQL = "SELECT 'p' || p_partkey AS id, p_name AS name FROM part UNION ALL SELECT 'c' || c_custkey, c_name FROM customer"


def names(spark, folder):
    def rows(source, mark, key, name):
        return table(spark, folder, source).select(
            F.concat(F.lit(mark), F.col(key).cast("string")).alias("id"), F.col(name).alias("name")
        )

    return rows("part", "p", "p_partkey", "p_name").unionByName(rows("customer", "c", "c_custkey", "c_name"))


def joined(array):
    return F.array_join(array, "|")


@query("keyword_form", f"SELECT id, lower(trim(name)) AS term FROM ({NAMES_SQL})")
def keyword_form(spark, folder):
    return names(spark, folder).select("id", tokens.keyword_form("name").alias("term"))


def shingle_list_sql(w: str, separator: str) -> str:
    two = f"list_transform(list_zip({w}[1:len({w}) - 1], {w}[2:]), lambda x: x[1] || '{separator}' || x[2])"
    three = (
        f"list_transform(list_zip({w}[1:len({w}) - 2], {w}[2:len({w}) - 1], {w}[3:]),"
        f" lambda x: x[1] || '{separator}' || x[2] || '{separator}' || x[3])"
    )
    return f"CASE WHEN len({w}) >= 3 THEN list_concat({two}, {three}) WHEN len({w}) = 2 THEN {two} ELSE [] END"


def shingle_sql(w: str, separator: str) -> str:
    return f"coalesce(array_to_string({shingle_list_sql(w, separator)}, '|'), '')"


@query(
    "shingles",
    f"SELECT id, {shingle_sql('w', ' ')} AS shingles FROM (SELECT id, {WORDS_SQL.format('name')} AS w FROM ({NAMES_SQL}))",
)
def shingles(spark, folder):
    return names(spark, folder).select("id", joined(grams.word_shingles(tokens.tokens("name"))).alias("shingles"))


@query(
    "shingles_nospace",
    f"SELECT id, {shingle_sql('w', '')} AS shingles FROM (SELECT id, {WORDS_SQL.format('name')} AS w FROM ({NAMES_SQL}))",
)
def shingles_nospace(spark, folder):
    words = tokens.tokens("name")
    return names(spark, folder).select("id", joined(grams.word_shingles(words, separator="")).alias("shingles"))


@query(
    "doc_shingles",
    f"""SELECT doc_id, md5({shingle_sql('w', ' ')}) AS digest
        FROM (SELECT doc_id, {DOC_WORDS} AS w FROM documents)""",
)
def doc_shingles(spark, folder):
    shingled = joined(grams.word_shingles(F.col("w")))
    return documents(spark, folder).select("doc_id", tokens.tokens("text").alias("w")).select(
        "doc_id", F.md5(shingled.cast("binary")).alias("digest")
    )


def edge_sql(c: str) -> str:
    return f"list_transform(range(2, least(length({c}), 10) + 1), lambda i: left({c}, i))"


def ngram_sql(c: str) -> str:
    return f"list_transform(range(1, greatest(length({c}) - 1, 1)), lambda i: substr({c}, i, 3))"


def text_sql(array: str) -> str:
    return f"coalesce(array_to_string({array}, '|'), '')"


@query(
    "edge_ngrams",
    f"""SELECT id, {text_sql(edge_sql('name'))} AS keyword, {text_sql('flatten(list_transform(w, lambda t: '
        + edge_sql('t') + '))')} AS token FROM (SELECT id, lower(trim(name)) AS name,
        {WORDS_SQL.format('name')} AS w FROM ({NAMES_SQL}))""",
)
def edge_ngrams(spark, folder):
    return names(spark, folder).select(
        "id",
        joined(grams.edge_ngrams(tokens.keyword_form("name"))).alias("keyword"),
        joined(grams.grams_of_each(tokens.tokens("name"), grams.edge_ngrams)).alias("token"),
    )


@query(
    "char_ngrams",
    f"""SELECT id, {text_sql(ngram_sql('name'))} AS keyword, {text_sql('flatten(list_transform(w, lambda t: '
        + ngram_sql('t') + '))')} AS token FROM (SELECT id, lower(trim(name)) AS name,
        {WORDS_SQL.format('name')} AS w FROM ({NAMES_SQL}))""",
)
def char_ngrams(spark, folder):
    return names(spark, folder).select(
        "id",
        joined(grams.char_ngrams(tokens.keyword_form("name"))).alias("keyword"),
        joined(grams.grams_of_each(tokens.tokens("name"), grams.char_ngrams)).alias("token"),
    )


@query(
    "shingle_grams",
    f"""WITH s AS (SELECT id, {shingle_list_sql('w', ' ')} AS s
          FROM (SELECT id, {WORDS_SQL.format('name')} AS w FROM ({NAMES_SQL})))
        SELECT id, {text_sql('flatten(list_transform(s, lambda t: ' + edge_sql('t') + '))')} AS edge,
               {text_sql('flatten(list_transform(s, lambda t: ' + ngram_sql('t') + '))')} AS ngram FROM s""",
)
def shingle_grams(spark, folder):
    shingled = names(spark, folder).select("id", grams.word_shingles(tokens.tokens("name")).alias("s"))
    return shingled.select(
        "id",
        joined(grams.grams_of_each(F.col("s"), grams.edge_ngrams)).alias("edge"),
        joined(grams.grams_of_each(F.col("s"), grams.char_ngrams)).alias("ngram"),
    )


@query(
    "copy_fields",
    f"""SELECT id, lower(trim(name)) AS "nameExact", name AS "nameAggr", {shingle_sql('w', ' ')} AS "nameShingle"
        FROM (SELECT id, name, {WORDS_SQL.format('name')} AS w FROM ({NAMES_SQL}))""",
)
def copy_fields(spark, folder):
    copies = grams.copy_fields("name", {"nameExact": "exact", "nameAggr": "aggr", "nameShingle": "shingle"})
    return names(spark, folder).select("id", *copies).withColumn("nameShingle", joined(F.col("nameShingle")))


@query(
    "lift_nested",
    f"""SELECT doc_id, coalesce(array_to_string({DOC_WORDS}, ' '), '') AS term,
          coalesce(array_to_string(range(0, len({DOC_WORDS})), ' '), '') AS pos FROM documents""",
)
def lift_nested(spark, folder):
    # token streams are arrays of structs; their fields become arrays at the top
    lifted = doc_stream(spark, folder).select("doc_id", *grams.lift("stream", "term", "pos"))
    return lifted.select(
        "doc_id", F.array_join("term", " ").alias("term"), F.array_join(F.col("pos").cast("array<string>"), " ").alias("pos")
    )


@query(
    "media_count",
    """SELECT page_id, len(regexp_extract_all(html, 'href="([^"]*)"', 1))::INTEGER AS media FROM pages""",
)
def media_count(spark, folder):
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    pages = table(spark, folder, "pages").select("page_id", links.alias("media"))
    return pages.select("page_id", grams.item_count("media").alias("media"))
