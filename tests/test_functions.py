from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.functions import (
    cents_to_currency,
    current_timestamp_utc,
    day_diff,
    safe_divide,
    sum_money,
    surrogate_key,
)
from mercato.sources.seeds import exchange_rates


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("parts", "key"),
    [
        ((F.lit, "a", 1), "737c191aed52450b9c655083c9971bdd"),
        ((F.lit, None, "1"), "b82c6014484453a40554f217f8c20eb2"),
        ((F.lit, dt.date(2016, 1, 1)), "c46a7804ddf64c8dcf7a764fbe0172d2"),
    ],
)
def test_surrogate_key(spark, parts, key):
    lit, *values = parts
    assert value(spark, surrogate_key(*[lit(v) for v in values])) == key


def test_key_depends_on_the_text_form(spark):
    assert value(spark, surrogate_key(F.lit(1))) != value(spark, surrogate_key(F.lit(1.0)))


@pytest.mark.parametrize(("a", "b", "quotient"), [(1, 0, None), (1, None, None), (None, 2, None), (1, 2, 0.5)])
def test_safe_divide(spark, a, b, quotient):
    assert value(spark, safe_divide(F.lit(a).cast("bigint"), F.lit(b).cast("bigint"))) == quotient


@pytest.mark.parametrize(
    ("cents", "amount"), [(1050, "10.50"), (1050.6, "10.51"), (99_999_999_999_999, "999999999999.99")]
)
def test_cents_to_currency(spark, cents, amount):
    assert value(spark, cents_to_currency(F.lit(cents))) == Decimal(amount)
    assert value(spark, cents_to_currency(F.lit(cents), "USD")) == Decimal(amount)


def test_sum_money(spark):
    amounts = spark.createDataFrame([(0.1,), (0.2,), (1.005,), (None,)], "x double")
    assert amounts.agg(sum_money("x").alias("x")).first().x == Decimal("1.305")
    assert amounts.filter("x is null").agg(sum_money("x").alias("x")).first().x is None
    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(sum_money("x").alias("x")).first().x == Decimal("4")
    large = spark.createDataFrame([(9e12,), (9e12,), (-1.5,), (-0.25,)], "x double")
    assert large.agg(sum_money("x").alias("x")).first().x == Decimal("17999999999998.25")


def test_day_diff_counts_midnights(spark):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2018-01-01 23:30:00", "2018-01-02 00:30:00"))
    assert value(spark, day_diff(start, end)) == 1
    assert value(spark, day_diff(end, start)) == -1


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_current_timestamp_utc_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        now = value(spark, current_timestamp_utc())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - now) < dt.timedelta(minutes=1)


def test_seed_from_csv_equals_the_built_in_rates(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text(
        "currency_code,currency_name,rate_to_usd,effective_date\n"
        "BRL,Brazilian Real,0.20,2018-01-01\nINR,Indian Rupee,0.014,2018-01-01\n"
        "USD,US Dollar,1.00,2018-01-01\nEUR,Euro,1.18,2018-01-01\n"
    )
    read = exchange_rates(spark, str(path))
    assert read.schema == exchange_rates(spark).schema
    assert sorted(read.collect()) == sorted(exchange_rates(spark).collect())
