"""Skew-safe lookups: the same rows as a plain join, evenly spread."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mercato import Settings
from mercato.operators.joins import Lookup, enrich, fits_broadcast, hot_keys

SHUFFLED = Settings(broadcast_max_rows=0, hot_key_min_rows=500)


def skewed(spark, rows=6000):
    """A third of the rows has one key, a third has none, the rest has rare ones."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id").cast("string"))
    )
    return spark.range(0, rows, 1, 4).select(key.alias("k"), (F.col("id") % 50).cast("string").alias("j"), "id")


def lookup(spark, rows=6000):
    # every other rare key is missing
    rare = spark.range(0, rows, 2).select(F.col("id").cast("string").alias("k"))
    return rare.union(spark.createDataFrame([("hot",)], "k string")).withColumn("name", F.concat(F.lit("n"), "k"))


def test_hot_keys(spark):
    found = hot_keys(skewed(spark), ["k", "j"], 6000, SHUFFLED)
    assert set(found) == {"k"}
    assert {r.k: r["__salts"] for r in found["k"].collect()} == {"hot": 16, None: 16}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_same_rows_as_a_plain_join(spark, how, broadcast):
    rows, names = skewed(spark), lookup(spark)
    settings = replace(SHUFFLED, broadcast_max_rows=broadcast)
    got = enrich(rows, [Lookup(names, "k", how=how)], settings)
    plain = rows.join(names, "k", how).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_several_lookups(spark):
    rows = skewed(spark)
    second = spark.range(40).select(F.col("id").cast("string").alias("j"), F.lit(True).alias("known"))
    got = enrich(rows, [Lookup(lookup(spark), "k"), Lookup(second, "j", how="inner")], SHUFFLED)
    plain = rows.join(lookup(spark), "k", "left").join(second, "j")
    assert got.count() == plain.count() == 4800
    assert got.filter("known and name = 'nhot'").count() == plain.filter("known and name = 'nhot'").count()


def test_hot_rows_are_spread(spark):
    """No partition of the salted join gets a whole hot key."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows, names = skewed(spark), lookup(spark)
        salted = enrich(rows, [Lookup(names, "k")], SHUFFLED)
        plain = rows.hint("merge").join(names.hint("merge"), "k", "left")
        sizes = [
            [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            for df in (salted, plain)
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [sum(s) for s in sizes] == [6000, 6000]
    assert max(sizes[0]) < 1000 < 2000 <= max(sizes[1])


def test_size_is_checked(spark):
    assert fits_broadcast(spark.range(10).count, 10)
    assert not fits_broadcast(spark.range(11).count, 10)
    large = enrich(skewed(spark), [Lookup(lookup(spark), "k")], SHUFFLED)
    assert "__salt" in large._jdf.queryExecution().toString()
    small = enrich(skewed(spark), [Lookup(lookup(spark), "k")], Settings())
    assert "__salt" not in small._jdf.queryExecution().toString()
