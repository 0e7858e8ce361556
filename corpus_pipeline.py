"""The corpus pipeline: quality rules, exact dedup, SimHash near-dedup, suffix-array dedup, packing.

A stage gets the rows its predecessor wrote, so what the predecessor kept on
the shared folder for its own work is not needed any more: every stage deletes
it as it begins.

Whole texts go through every stage, so a batch of some thousand rows is tens of
megabytes, held by Parquet's reader, the Arrow writer and the Python worker of
each task at once.  The stages run with small batches (``BATCHES``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact, hosts, packing, simhash, suffixes
from tidemark.llm.common import table
from tidemark.session import Scratch, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What the stage that ran last wrote for its own work; its result may still read from it.
LAST = Scratch()

#: Bytes of a batch for Python and rows of one from Parquet, where the session has no values of its own.  A stage's result
#: is read after the stage has returned, so they stay with the session.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20), "spark.sql.parquet.columnarReaderBatchSize": "512"}


def small_batches(spark: SparkSession) -> None:
    own = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in own:
            spark.conf.set(key, value)


def stage(run: Stage) -> Stage:
    """The folders of a stage live until the next one begins; its batches are small."""

    @wraps(run)
    def held(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        small_batches(spark)
        LAST.drop(spark)
        with LAST.collect():
            return run(spark, docs, folder)

    return held


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rules reject go; a null text has no words and goes, a null host is the one without a name.

    Repeated rows are judged each by itself; an empty table gives an empty one.
    """
    return hosts.quality_filter(docs)


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of texts that are equal but for white space, the row with the smallest id stays; null texts count as empty.

    Of rows with the same id one stays, and a null id counts as the largest.  An empty table gives an empty one.
    """
    return exact.exact_dedup(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near fingerprints stays, that with the smallest id; texts without words are one group.

    An empty table gives an empty one.
    """
    return simhash.near_dedup(docs)


@stage
def suffix_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document stays and loses its passages of 200 bytes or more that occur elsewhere too.

    Null texts stay null, repeated rows lose all they share, an empty table gives an empty one.
    """
    return suffixes.remove_repeats(docs)


@stage
def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place; a null or empty text is its closing id alone."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("best-fit packing", best_fit_packing),
]

#: Token packing and suffix sorting are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written, read again by the next and then deleted.

    Extra columns are kept by all stages but the last, whatever their names.
    """
    docs, before = table(spark, folder, "documents"), Scratch()
    for name, work in STAGES[:-1]:
        output = Scratch()
        result = work(spark, docs, folder)
        with output.collect():
            docs = written(result, name.replace(" ", "-"))
        before.drop(spark)  # the rows this stage has read
        before = output
    result = STAGES[-1][1](spark, docs, folder)
    before.drop(spark)  # the pieces are cut and written; the result reads only these
    return result
