"""Shingles and n-grams.

The sizes are this library's defaults (shingles of 2-3 words, edge grams of
2-10 characters, grams of 3); pass others as needed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import as_column, bind


def _empty() -> Column:
    return F.array().cast("array<string>")


def word_shingles(words: Column, low: int = 2, high: int = 3, separator: str = " ") -> Column:
    """Runs of ``low``..``high`` neighbouring words, shorter runs first."""
    def of_size(words, n):
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        runs = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), separator))
        return F.when(F.size(words) >= n, runs).otherwise(_empty())

    return bind(words, lambda w: F.flatten(F.array(*[of_size(w, n) for n in range(low, high + 1)])))


def edge_ngrams(c: Column | str, low: int = 2, high: int = 10) -> Column:
    """Prefixes of ``low``..``high`` characters."""
    def grams(s):
        longest = F.least(F.length(s), F.lit(high))
        found = F.transform(F.sequence(F.lit(low), longest), lambda n: F.substring(s, F.lit(1), n))
        return F.when(longest >= low, found).otherwise(_empty())

    return bind(as_column(c), grams)


def char_ngrams(c: Column | str, low: int = 3, high: int = 3) -> Column:
    """All substrings of ``low``..``high`` characters, shorter ones first."""
    def of_size(s, n):
        starts = F.sequence(F.lit(1), F.length(s) - (n - 1))
        grams = F.transform(starts, lambda i: F.substring(s, i, F.lit(n)))
        return F.when(F.length(s) >= n, grams).otherwise(_empty())

    return bind(as_column(c), lambda s: F.flatten(F.array(*[of_size(s, n) for n in range(low, high + 1)])))


def grams_of_each(words: Column, gram) -> Column:
    """Apply ``edge_ngrams`` or ``char_ngrams`` to every token or shingle."""
    return F.flatten(F.transform(words, lambda word: gram(word)))


def copy_fields(c: Column | str, targets: dict[str, str]) -> list[Column]:
    """One source field copied into several derived ones.

    ``targets`` maps each new name to a form: ``exact``, ``aggr`` (as is),
    ``shingle``, ``shingle_nospace``, ``edge``, ``ngram`` or ``token``.
    """
    from tidemark.functions.tokens import keyword_form, tokens

    c = as_column(c)
    forms = {
        "exact": lambda: keyword_form(c),
        "aggr": lambda: c,
        "shingle": lambda: word_shingles(tokens(c)),
        "shingle_nospace": lambda: word_shingles(tokens(c), separator=""),
        "edge": lambda: edge_ngrams(keyword_form(c)),
        "ngram": lambda: char_ngrams(keyword_form(c)),
        "token": lambda: tokens(c),
    }
    return [forms[form]().alias(name) for name, form in targets.items()]


def lift(nested: Column | str, *fields: str) -> list[Column]:
    """Fields of an array of structs as arrays at the top level."""
    nested = as_column(nested)
    return [nested[f].alias(f) for f in fields]


def item_count(items: Column | str) -> Column:
    """Length of an array, 0 where there is none."""
    return F.coalesce(F.size(as_column(items)), F.lit(0))
