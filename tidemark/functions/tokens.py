"""Token streams: arrays of ``struct<pos, term, flags>`` built per row.

Replacing, augmenting and recombining tokens never leaves the row, so these
are map-only expressions: no shuffle, whatever the skew of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import as_column, bind

WORD = r"[\p{L}\p{N}]+"
STEM_BIT = 0


def tokens(c: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order."""
    return F.regexp_extract_all(F.lower(as_column(c)), F.lit(WORD), F.lit(0))


def keyword_form(c: Column | str) -> Column:
    """The whole string as one term: trimmed, lower case."""
    return F.lower(F.trim(as_column(c)))


def mark(flags: Column, bit: int = STEM_BIT) -> Column:
    """Set one bit of a token's flags."""
    return flags.bitwiseOR(F.lit(1 << bit))


def _token(pos: Column, term: Column, flags: Column) -> Column:
    return F.struct(pos.cast("int").alias("pos"), term.alias("term"), flags.alias("flags"))


def token_stream(words: Column) -> Column:
    """Plain tokens with their positions and no flag set."""
    return F.transform(words, lambda t, i: _token(i, t, F.lit(0)))


def _with_stems(stream: Column, stemmer: Callable[[Column], Column], one: Callable[[Column, Column], Column]) -> Column:
    """Combine each token with its stem; stems are computed once per token."""
    def pairs(bound):
        stems = F.transform(bound["term"], lambda term: stemmer(term))
        return F.zip_with(bound, stems, lambda t, stem: one(t, stem))

    return bind(stream, pairs)


def stem_replace(stream: Column, stemmer: Callable[[Column], Column], bit: int = STEM_BIT) -> Column:
    """Put the stem in place of each token and mark the tokens that changed."""
    def one(t, stem):
        flags = F.when(stem != t["term"], mark(t["flags"], bit)).otherwise(t["flags"])
        return _token(t["pos"], stem, flags)

    return _with_stems(stream, stemmer, one)


def stem_augment(stream: Column, stemmer: Callable[[Column], Column], bit: int = STEM_BIT) -> Column:
    """Keep each token and add its stem, marked, at the same position."""
    def one(t, stem):
        added = _token(t["pos"], stem, mark(t["flags"], bit))
        return F.when(stem != t["term"], F.array(t, added)).otherwise(F.array(t))

    return F.flatten(_with_stems(stream, stemmer, one))


def recombine(stream: Column, separator: str = " ") -> Column:
    """All terms of a stream as one string; NULL for an empty stream."""
    joined = F.array_join(F.transform(stream, lambda t: t["term"]), separator)
    return F.when(F.size(stream) > 0, joined)


def one_per_row(df: DataFrame, items: Column, name: str, *keep: str) -> DataFrame:
    """One row per array element, beside the ``keep`` columns.

    For a plain ``explode`` Catalyst adds a filter on the array's size, which
    computes a costly array expression again; the outer form gets none.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())
