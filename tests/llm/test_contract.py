"""Every registered query: its DuckDB text where there is one, empty tables, and whole results."""

from __future__ import annotations

import pytest

from check_queries import connect, difference
from mercato.llm.registry import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_oracle(spark, duck, name):
    assert difference(spark, duck, name, SF_DIR) is None


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(result, empty_dir, name):
    assert result(name, empty_dir) == []


def test_thirteen_queries():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


OTHER_ROWS = ("op2_", "op3_", "op9_", "op11_", "op12_", "op13_")


@pytest.mark.parametrize("name", [q for q in QUERIES if not q.startswith(OTHER_ROWS)])
def test_one_row_per_document(spark, result, odd_dir, name):
    ids = sorted(str(r["doc_id"]) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").collect())
    assert sorted(str(r["doc_id"]) for r in result(name, odd_dir)) == ids
