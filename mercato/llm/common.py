"""Small helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` below the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_text(name: str) -> Column:
    """An id as text; NULL counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_remainder(name: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`: how the contracts set rows aside."""
    return F.crc32(id_text(name)) % modulus


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """Some hexadecimal digits of a digest as a bigint; `start` counts from 1, at most 15 digits."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores before it until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ddl(df: DataFrame, added: str) -> str:
    """The schema of `df` and further columns, as text."""
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), added])


def batches(schema: pa.Schema, rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows."""
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield _batch(schema, block)
            block = []
    if block:
        yield _batch(schema, block)


def _batch(schema: pa.Schema, block: list[tuple]) -> pa.RecordBatch:
    columns = zip(*block, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def salted_lookup(rows: DataFrame, lookup: DataFrame, key: str, spread: Column, salts: int = 8) -> DataFrame:
    """`rows` left-joined with `lookup` (one row per key), every key's rows spread over `salts` partitions.

    For lookups that hold only keys of several rows, so that repeating them is cheap. `spread`
    tells rows of one key apart.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.array(*(F.lit(i) for i in range(salts)))))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def workers_import_package(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package, whatever folder it was started in.

    On a cluster the package is installed, or sent with --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
