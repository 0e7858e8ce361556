"""Every registered query agrees with its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract
import check
from tidemark import queries as registered


@pytest.fixture(scope="module")
def con(request):
    return check.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, con, sf, name):
    ok, text = check.compare(spark, con, name, sf)
    if ok is None:
        pytest.skip(f"no SQL: compared with a plain version in tests/llm ({text})")
    assert ok, text


def test_every_query_has_sql():
    """Those of the corpus operators may have plain versions in their own tests instead."""
    assert set(registered.QUERIES) == set(registered.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
