"""Plural and participle stemming as Column expressions.

A word is mapped to its consonant/vowel shape with a few regular
expressions; the rules then read the shape and the last letters.  Only
words with the right ending pay for that, all others pass through a
single suffix test.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import as_column, bind

# Fixed values of the rules.
E_MAY_GO_AFTER_NOT = "lrvugctnmsdpbez"  # a final e stays after these letters
DOUBLE_KEEPS = "s"
E_AFTER_VOWEL = "sgp"
E_AFTER_R = "sgv"


def _last(c: Column, back: int = 0) -> Column:
    """The character ``back`` places before the last; empty if there is none."""
    size = F.length(c)
    return F.when(size > back, F.substring(c, size - back, F.lit(1))).otherwise(F.lit(""))


def shape(word: Column) -> Column:
    """``C``/``V`` string of a word; ``y`` is a consonant first and after a vowel.

    In a run of ``y`` the two kinds alternate, which the ``\\G`` patterns
    walk through two letters at a time.
    """
    s = F.regexp_replace(word, "[aeiou]", "V")
    s = F.regexp_replace(s, "[^Vy]", "C")
    s = F.regexp_replace(s, "(?:(?<=C)|(?!^)\\G)yy", "VC")
    s = F.regexp_replace(s, "(?<=C)y", "V")
    s = F.regexp_replace(s, "(?:(?<=V)|^|\\G)yy", "CV")
    return F.regexp_replace(s, "(?<=V)y|^y", "C")


def measure(cv: Column) -> Column:
    """Number of vowel-to-consonant steps in a shape."""
    return ((F.length(cv) - F.length(F.replace(cv, F.lit("VC"), F.lit("")))) / 2).cast("int")


def _drop(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _drop_final_e(word: Column) -> Column:
    """Drop a final ``e`` where the measure and the letter before allow it."""
    def decide(cv):
        body = _drop(word, 1)
        m = measure(cv)
        before = _last(word, 1)
        at_start = F.length(word) == 2
        vowel_before_that = _last(cv, 2) == "V"
        cvc = (F.substring(_drop(cv, 1), -3, 3) == "CVC") & (F.length(word) >= 4) & ~before.isin("w", "x", "y")
        keeps = (
            before.isin(*E_MAY_GO_AFTER_NOT)
            | ((before == "h") & (at_start | (_last(word, 2) == "t")))
            | ((before == "k") & (at_start | vowel_before_that))
        )
        drops = ((m > 1) | ((m == 1) & ~cvc)) & ~keeps
        return F.when(drops, body).otherwise(word)

    return F.when(word.endswith("e"), bind(shape(word), decide)).otherwise(word)


def _controlled(word: Column, stemmed: Column, block: Iterable[str], min_len: int) -> Column:
    blocked = list(block)
    passed = F.length(word) < max(min_len, 3)
    if blocked:
        passed = passed | word.isin(*blocked)
    return F.when(passed, word).otherwise(stemmed)


def plural_stem(word: Column | str, block: Iterable[str] = (), min_len: int = 1) -> Column:
    """Singular of a lower-case word; blocked and short words are left alone."""
    word = as_column(word)
    before_s = _last(word, 1)
    stemmed = (
        F.when(~word.endswith("s"), word)
        .when(word.endswith("sses"), _drop_final_e(_drop(word, 2)))
        .when(word.endswith("ies"), F.concat(_drop(word, 3), F.lit("y")))
        .when(~before_s.isin("s", "u", "i"), _drop_final_e(_drop(word, 1)))
        .otherwise(word)
    )
    return _controlled(word, stemmed, block, min_len)


def _repair(base: Column) -> Column:
    """Undo the spelling change that ``-ing`` made to the end of a word."""
    def decide(cv):
        m = measure(cv)
        c, p, q = _last(base), _last(base, 1), _last(base, 2)
        size = F.length(base)
        with_e = F.concat(base, F.lit("e"))
        without_last = _drop(base, 1)
        adds_e = (
            c.isin(*E_AFTER_VOWEL)
            | ((p == "u") & (c == "r"))
            | (
                (size >= 3)
                & (
                    ((q != "o") & (p == "u"))
                    | (~q.isin("e", "o") & (p == "a"))
                    | (~q.isin("o", "i") & (p == "o") & (c != "n") & (m <= 2))
                    | ((q != "a") & (p == "i") & ((m != 2) | (c != "t")))
                )
            )
        )
        return (
            F.when(c.isin("w", "x", "y"), F.when(size == 2, F.concat(without_last, F.lit("ie"))).otherwise(base))
            .when((_last(cv) != "C") | (size < 2), base)
            .when((c == p) & ~((c == "l") & (m == 1)), F.when(c == DOUBLE_KEEPS, base).otherwise(without_last))
            .when(_last(cv, 1) == "V", F.when(adds_e, with_e).otherwise(base))
            .when((c == "k") & (p == "c") & (m > 1), without_last)
            .when((p != "l") & (c == "l"), with_e)
            .when((p == "r") & c.isin(*E_AFTER_R), with_e)
            .otherwise(base)
        )

    return bind(shape(base), decide)


def participle_stem(word: Column | str, block: Iterable[str] = (), min_len: int = 1) -> Column:
    """Base form of an ``-ing`` word; the bare word ``ing`` stays as it is."""
    word = as_column(word)
    stemmed = F.when(word.endswith("ing") & (F.length(word) > 3), _repair(_drop(word, 3))).otherwise(word)
    return _controlled(word, stemmed, block, min_len)
