"""Dates, durations and run ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import as_column

# Minutes per unit, tested in this order with "contains",
# and the wait that stands for an unreadable frequency.
UNIT_MINUTES = (("min", 1), ("hour", 60), ("day", 1440), ("week", 10080))
MONTH_MINUTES = 43200
DEFAULT_WAIT = 1440


def zero_date_null(c: Column | str) -> Column:
    """Timestamp without zone from text; zero dates and unreadable text give NULL."""
    text = as_column(c)
    return F.when(~text.startswith("0000-00-00"), text.try_cast("timestamp_ntz"))


def freq_minutes(c: Column | str, default: int = DEFAULT_WAIT) -> Column:
    """Minutes meant by ``"<number> <unit>"``; ``default`` where it cannot be read."""
    parts = F.split(F.trim(as_column(c)), " ")
    number = F.get(parts, F.lit(0))
    count = F.when(number.rlike(r"^[+-]?[0-9]+$"), number.try_cast("int")).cast("bigint")
    unit = F.lower(F.get(parts, F.lit(1)))
    factor = F.when(unit.isNull(), F.lit(None).cast("int"))
    for word, minutes in UNIT_MINUTES:
        factor = factor.when(unit.contains(word), F.lit(minutes))
    return F.coalesce(count * factor.otherwise(F.lit(MONTH_MINUTES)), F.lit(default).cast("bigint"))


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated towards zero."""
    return F.timestamp_diff("MINUTE", as_column(start), as_column(end))


def filename_stamp(c: Column | str) -> Column:
    """``yyyy-MM-dd HH-mm-ss``: a timestamp that may stand in a file name."""
    return F.date_format(as_column(c), "yyyy-MM-dd HH-mm-ss")


def run_id(length: int = 10) -> Column:
    """A random alphanumeric id."""
    return F.randstr(length)
