"""Join conditions that leave room for AQE's skew handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# types whose equal values have equal hashes
HASHABLE = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BinaryType, T.BooleanType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


def all_of(conditions: list[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def equal_keys(left: DataFrame, right: DataFrame, pairs: dict[str, str], on: tuple[str, str] = ("", "")) -> Column:
    """Equality of key pairs for a side that was grouped by the same keys.

    AQE splits a skewed key only if both sides come straight from a shuffle
    made for the join.  A side grouped by the join keys is already
    partitioned and gets none, so the hash of the keys is compared as well:
    that is true whenever the keys are equal, and no earlier grouping has
    it as a key.  Left out where the two sides' types differ.
    """
    def name(side, column):
        return F.col(f"{on[side]}.`{column}`" if on[side] else f"`{column}`")

    equal = [name(0, a) == name(1, b) for a, b in pairs.items()]
    kinds = [(left.schema[a].dataType, right.schema[b].dataType) for a, b in pairs.items()]
    if all(x == y and isinstance(x, HASHABLE) for x, y in kinds):
        hashes = [F.xxhash64(*[name(side, c) for c in columns]) for side, columns in enumerate((pairs, pairs.values()))]
        equal.append(hashes[0] == hashes[1])
    return all_of(equal)
