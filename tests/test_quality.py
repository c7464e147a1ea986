from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.operators.quality import Check
from mercato.plans.checks import CHECKS


def column(spark, values, kind="int", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def values(df):
    return sorted([r[0] for r in df.collect()], key=str)


def test_null_passes_row_checks(spark):
    df = column(spark, [0, -1, None])
    assert values(quality.positive_values(df, "x")) == [-1]
    assert values(quality.accepted_values(df, "x", [0])) == [-1]
    assert values(quality.not_null(df, "x")) == [None]


def test_scores(spark):
    assert values(quality.valid_scores(column(spark, [0, 3, 6, None]), "x")) == [0, 6, None]


def test_unique_ignores_null(spark):
    found = quality.unique(column(spark, [1, 1, 2, None, None]), "x").collect()
    assert [(r.unique_field, r.n_records) for r in found] == [(1, 2)]


def test_relationships_ignores_null(spark, settings):
    child, parent = column(spark, ["a", "b", "b", None], "string"), column(spark, ["a", None], "string", "id")
    assert values(quality.relationships(child, "x", parent, "id", settings)) == ["b", "b"]


def test_future_dates(spark):
    df = column(spark, [dt.datetime(2018, 1, 1), dt.datetime(2999, 1, 1), None], "timestamp_ntz")
    assert quality.no_future_dates(df, "x").count() == 1
    assert quality.no_future_dates(df, "x", dt.datetime(2017, 1, 1)).count() == 2


@pytest.mark.parametrize(
    ("hours", "status"), [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error"), (None, "error")]
)
def test_freshness(spark, hours, status):
    now = dt.datetime(2018, 1, 10)
    loaded = [] if hours is None else [now - dt.timedelta(hours=hours), now - dt.timedelta(days=9)]
    row = quality.freshness(column(spark, loaded, "timestamp_ntz"), "x", now).first()
    assert (row.age_hours, row.status) == (hours, status)


def test_suite_counts_failures(spark):
    models = {
        "child": spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "b", None)], "id int, p string, v int"),
        "parent": column(spark, ["a"], "string", "p"),
    }
    checks = [
        Check("child", "id", "unique"),
        Check("child", "id", "not_null"),
        Check("child", "v", "positive_values"),
        Check("child", "v", "valid_scores"),
        Check("child", "p", "relationships", to="parent", field="p"),
        Check("parent", "p", "unique"),
        Check("parent", "p", "accepted_values", values=("a",)),
    ]
    result = {r.check: (r.failures, r.status) for r in quality.run_checks(checks, models).collect()}
    assert result == {
        "unique_child_id": (1, "fail"),
        "not_null_child_id": (1, "fail"),
        "positive_values_child_v": (1, "fail"),
        "valid_scores_child_v": (2, "fail"),
        "relationships_child_p": (2, "fail"),
        "unique_parent_p": (0, "pass"),
        "accepted_values_parent_p": (0, "pass"),
    }


def test_declared_checks():
    assert Counter(c.kind for c in CHECKS) == {
        "unique": 16,
        "not_null": 24,
        "accepted_values": 4,
        "relationships": 3,
        "no_future_dates": 1,
        "positive_values": 2,
        "valid_scores": 1,
    }
    assert len({c.name for c in CHECKS}) == 51


def test_row_conditions_of_a_model_share_one_scan(spark):
    models = {"m": spark.range(10).withColumn("v", F.col("id"))}
    checks = [Check("m", "id", "not_null"), Check("m", "v", "positive_values"), Check("m", "v", "not_null")]
    plan = quality.run_checks(checks, models)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_relationships_need_no_join(spark):
    """Both sides are counted in the one shuffle that all checks share."""
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (None, None)], "id long, k string")
    child = spark.createDataFrame([(1, "a", 2), (1, "c", 1), (3, None, None), (None, "c", 9)], "id int, k string, up int")
    models = {"child": child, "parent": parents}
    checks = [
        Check("child", "id", "relationships", to="parent", field="id"),  # of another type
        Check("child", "k", "relationships", to="parent", field="k"),
        Check("child", "up", "relationships", to="child", field="id"),  # of the same model
        Check("child", "id", "relationships", to="child", field="id"),
        Check("parent", "k", "relationships", to="child", field="k"),
        Check("parent", "id", "unique"),
    ]
    result = quality.run_checks(checks, models)
    text = result._jdf.queryExecution().executedPlan().toString()
    alone = [quality.run_checks([c], models).first().failures for c in checks]
    assert alone == [1, 2, 2, 0, 1, 0]  # 3; "c" twice; 2 and 9; b
    assert sorted(r.failures for r in result.collect()) == sorted(alone)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 1
    assert text.count("Exchange hashpartitioning(id") == 2  # values, then the sums of 51 checks or fewer


def test_a_column_that_many_checks_ask_for_adds_each_value_once(spark):
    """Unique, and referred to by two columns: one value per row is shuffled, not three."""
    parents = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    left = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    right = spark.createDataFrame([("b",), ("y",)], "k string")
    models = {"parent": parents, "left": left, "right": right}
    checks = [
        Check("left", "k", "relationships", to="parent", field="k"),
        Check("right", "k", "relationships", to="parent", field="k"),
        Check("parent", "k", "unique"),
        Check("parent", "k", "not_null"),
    ]
    numbered = list(enumerate(checks))
    values = [*quality._values(numbered, models).values()]
    assert quality._findings("parent", parents, values, numbered, None).count() == 3 + 1
    result = {r.check: r.failures for r in quality.run_checks(checks, models).collect()}
    assert result == {
        "relationships_left_k": 2,
        "relationships_right_k": 1,
        "unique_parent_k": 1,
        "not_null_parent_k": 1,
    }
