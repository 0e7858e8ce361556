"""Quality rules with verdicts for whole hosts.

Each document is measured by itself; rule failures are added up per host,
the rate of each host is shrunk towards all hosts' by a beta prior fitted to
the data, and the verdict on the host goes back to its documents.

Two sets of rules are used.  A document that breaks a base rule always goes,
one that breaks no rule always stays, wherever it comes from.  For one that
breaks strict rules only, how far it exceeds them is weighed against the odds
of its host, as a multiple of the general odds of the fitted prior: at twice
the limits it still goes from a host with half the general odds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import Rows, documents_of, numbered
from tidemark.session import written

WINDOW = 5  # words
_BLANKS = str.maketrans("\t\n\x0b\x0c\r", "     ")
_SYMBOL = re.compile(r"[#*$%&|<>]")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[str], window: int = WINDOW) -> int:
    """Words within windows that occur twice or more, the first occurrence included."""
    grams = list(zip(*[words[i:] for i in range(window)]))
    if len(set(grams)) == len(grams):
        return 0
    seen: dict[tuple, int] = {}
    marks = [0] * (len(words) + 1)
    for at, gram in enumerate(grams):
        first = seen.setdefault(gram, at)
        if first != at:
            for start in (first, at):
                marks[start] += 1
                marks[start + window] -= 1
    return sum(1 for x in accumulate(marks[:-1]) if x > 0)


def measures(text: str | None) -> tuple[int, ...]:
    """The five counts of ``MEASURES``; null text has no words."""
    if not text:
        return (0,) * len(MEASURES)
    words = [w for w in text.translate(_BLANKS).split(" ") if w]
    lines, repeated = set(), 0
    for line in text.split("\n"):
        if line.translate(_BLANKS).strip(" "):
            if line in lines:
                repeated += 1
            else:
                lines.add(line)
    return len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), repeated, repeat_words(words)


def _measure(text_at: str, host_at: str, carried: list[str], row_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field("row", row_type), pa.field("host", pa.string())]
        out = Rows(pa.schema(fields + [pa.field(m, pa.int64()) for m in MEASURES]))
        for (row,) in documents_of(batches):
            text = row[text_at]
            out.add({c: row[c] for c in carried}, row[host_at] or "", *measures(text), size=len(text or ""))
            if out.full():
                yield out.batch()
        yield from out.drain()

    return run


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def strict_failed() -> Column:
    """Base rules, many symbols, many repeated lines, or words that are mostly very short or very long."""
    chars = F.col("word_chars")
    return (
        base_failed()
        | (10 * F.col("n_symbols") > F.col("n_words"))
        | (10 * F.col("n_dup_lines") > F.col("n_words"))
        | ~chars.between(2 * F.col("n_words"), 15 * F.col("n_words"))
    )


def excess() -> Column:
    """How many times over the limit the worst broken strict rule is; above 1 for a broken one.  Needs words."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return F.greatest(10 * F.col("n_symbols") / n, 10 * F.col("n_dup_lines") / n, 2 * n / chars, chars / (15 * n))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta prior of the hosts' failure rates, by moments weighted with their documents.

    Takes one row of sums to the driver.  Hosts that do not differ, or a
    single one, give the strength of ten documents.
    """
    rate = F.col("failed") / F.col("docs")
    sums = hosts.agg(
        F.sum("docs").alias("n"), F.sum("failed").alias("f"), F.count("*").alias("k"),
        F.sum(F.col("docs") * rate * rate).alias("squares"),
    ).first()
    if not sums["n"]:
        return 0.5, 9.5
    # one failure in a hundred more than seen keeps both parameters positive
    mean = (sums["f"] + 0.01) / (sums["n"] + 1.0)
    spread = sums["squares"] / sums["n"] - (sums["f"] / sums["n"]) ** 2
    inside = mean * (1 - mean) * sums["k"] / sums["n"]  # what chance alone gives
    between = spread - inside
    strength = 10.0 if between <= 0 else min(1000.0, max(2.0, mean * (1 - mean) / between - 1))
    return mean * strength, (1 - mean) * strength


def host_rates(measured: DataFrame) -> DataFrame:
    """Documents, failures, the shrunk ``rate`` and ``odds`` of each host.

    ``odds`` are those of the rate, in multiples of the prior's.
    """
    hosts = written(
        measured.groupBy("host").agg(F.count("*").alias("docs"), F.count_if(strict_failed()).alias("failed")), "hosts"
    )
    a, b = beta_prior(hosts)
    rate, general = F.col("rate"), F.lit(a / b)
    shrunk = hosts.withColumn("rate", (F.col("failed") + a) / (F.col("docs") + (a + b)))
    return shrunk.withColumn("odds", rate / (1 - rate) / general)


def host_rules(
    docs: DataFrame, carry: list[str], text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """Per document: ``row`` (a struct of the carried columns), the five measures, ``base_failed``, ``host_rate``, ``kept``.

    A null text has no words and fails; a null host counts as the host with
    the empty name.  Repeated rows, also with the same id, are judged each by
    itself; an empty table gives no rows; columns that are not carried are
    dropped, whatever their names.  A text is measured whole in one task, with
    some 100 bytes a word.
    """
    flat, place = numbered(docs), {c: f"c{i}" for i, c in enumerate(docs.columns)}
    source = flat.select(
        F.struct(
            *[F.col(place[c]) for c in carry],
            F.col(place[text_col]).cast("string").alias("text_"), F.col(place[host_col]).cast("string").alias("host_"),
        ).alias("row")
    )
    row = StructType([f for f in source.schema["row"].dataType.fields if f.name not in ("text_", "host_")])
    arrow = to_arrow_schema(StructType([StructField("row", row)])).field(0).type
    counts = ", ".join(f"{m} bigint" for m in MEASURES)
    measured = written(
        source.mapInArrow(
            _measure("text_", "host_", row.names, arrow), f"row {row.simpleString()}, host string, {counts}"
        ),
        "measured",
    )
    # written, so that Spark knows the size and broadcasts the hosts only if they are few
    rates = written(host_rates(measured).select(F.col("host").alias("of"), "rate", "odds"), "rates")
    judged = measured.join(rates, F.col("host") == F.col("of"))
    kept = ~base_failed() & ~(strict_failed() & (excess() * F.col("odds") >= 1))
    return judged.select(
        "row", *MEASURES, base_failed().alias("base_failed"), F.col("rate").alias("host_rate"), kept.alias("kept")
    )


def quality_filter(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    judged = host_rules(docs, docs.columns, text_col, host_col)
    return judged.filter("kept").select("row.*").toDF(*docs.columns)
