"""Every registered query against its DuckDB text, on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from check_queries import connect, difference
from oracle_queries import oracle_texts

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_text():
    """Those of the training-data operators are tested beside them."""
    own = {q for q in entry.queries() if not q.startswith("op") and q != "pipeline"}
    assert own - {"orders_joined"} == set(oracle_texts()) - {"orders_joined"}


@pytest.mark.parametrize("name", list(oracle_texts()))
def test_query(spark, duck, name):
    assert difference(spark, duck, name, SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
