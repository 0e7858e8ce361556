"""Helpers shared by the expression modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def as_column(c: Column | str) -> Column:
    """A column given by itself or by name."""
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in several places of ``body``.

    Without this an expression used inside a lambda is computed again for
    every element.
    """
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)
