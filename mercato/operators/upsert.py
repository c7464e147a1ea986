"""Keyed upsert into a published table, with schema sync."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.config import Settings
from mercato.operators.bloom import BloomFilter, bloom_filter, size_for
from mercato.operators.joins import fits_broadcast
from mercato.sources.published import PublishedTable, Version


class DuplicateKeyError(ValueError):
    """A key that must be unique occurs more than once."""


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a key occurs more than once.

    Hashes of 8 bytes are shuffled instead of the keys. Only keys whose hash
    repeats, normally none, are then compared themselves.
    """
    hashed = df.select(F.xxhash64(key).alias("hash"))
    suspects = hashed.groupBy("hash").count().filter("count > 1").select("hash")
    if suspects.isEmpty():
        return
    keys = df.select(key, F.xxhash64(key).alias("hash")).join(suspects, "hash", "left_semi")
    repeated = keys.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").first()
    if repeated is not None:
        raise DuplicateKeyError(f"{key} = {repeated[0]!r} occurs {repeated['n']} times")


def sync_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with exactly the columns of `schema`: new ones NULL, others dropped, types adopted."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name)
            if f.name not in have
            else F.col(f.name)
            if have[f.name] == f.dataType
            else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def upsert(
    table: PublishedTable,
    base: Version | None,
    batch: DataFrame,
    key: str,
    search: Iterable[str] | None = None,
    settings: Settings | None = None,
    run: dict | None = None,
    arranged: bool = False,
) -> Version:
    """Publish a version in which the rows of `batch` replace those of `base` with the same key.

    Rows whose key is not in the batch stay, also if their source is gone. The
    table takes on the batch's columns. The batch is written once; of the old
    table only partitions that hold replaced rows are rewritten. They are found
    by looking for the batch's keys in the whole table's key column, as a row may
    have moved to another partition. `search` names the partitions to look in,
    where it is known that others cannot hold any. The version keeps `run`. A batch that is `arranged`
    by the table's partitions is written as it is.

    The keys of a batch of up to `broadcast_max_ids` rows are broadcast, so that the old table
    is only scanned. Of a larger batch, a Bloom filter of at most `upsert_filter_bits` is. Rows of the
    old table that it rules out are never shuffled, neither in the search for touched partitions, where
    8-byte hashes of the others' keys are, nor in rewriting them. If few rows pass, a filter of their keys keeps the
    batch's other keys, which are new, from being shuffled too. A batch with too many keys for a filter
    of that size goes without.
    """
    column = table.partition_column
    settings = settings or Settings()
    staged = table.stage(batch, arranged)
    new_rows = staged.read()
    require_unique(new_rows, key)
    if base is None:
        return table.commit(base, [staged], staged.schema, run=run)

    everything = base.partitions()
    types = {f.name: f.dataType for f in base.schema.fields}
    retyped = any(types.get(f.name, f.dataType) != f.dataType for f in staged.schema.fields)
    keys = new_rows.select(key)
    count = cache(keys.count)
    few = fits_broadcast(count, settings.broadcast_max_ids, keys, settings.broadcast_max_bytes)
    keys = F.broadcast(keys) if few else keys
    sizes = None if few else size_for(count(), settings.upsert_filter_bits)
    known = bloom_filter(keys, key, *sizes) if sizes else None
    found = None
    if known:  # it serves the search and the rewriting
        known.frame.persist()
        if not retyped:
            old = base.read(search if column else None).select(key)
            found = found_filter(old, key, known, count(), settings)
        if found:
            found.frame.persist()
            keys = found.maybe(keys, key)
    if column and not retyped:
        candidates = base.read(search, with_partition=True).select(key, column)
        touched = {r[0] for r in replaced_rows(candidates, keys, key, few, known).select(column).distinct().collect()}
    else:
        touched = set(everything)

    batches = [staged]
    if touched:
        rest = kept_rows(base.read(touched, with_partition=True), keys, key, known)
        batches.append(table.stage(sync_schema(rest, batch.schema)))
    for filtered in (known, found):
        if filtered:
            filtered.frame.unpersist()
    return table.commit(
        base, batches, staged.schema, keep=[p for p in everything if p not in touched], run=run
    )


def found_filter(
    old: DataFrame, key: str, known: BloomFilter, batch_size: int, settings: Settings
) -> BloomFilter | None:
    """A filter of the old keys that the batch may replace, if these are no more than half of the batch's.

    Of the batch, only keys that pass it need be compared with the old table.
    """
    passed = known.maybe(old, key)
    number = passed.count()
    sizes = size_for(number, settings.upsert_filter_bits) if number <= batch_size // 2 else None
    return bloom_filter(passed, key, *sizes) if sizes else None


def replaced_rows(
    rows: DataFrame, keys: DataFrame, key: str, few: bool, known: BloomFilter | None
) -> DataFrame:
    """The other columns of the rows whose key is in `keys`; unless these are few, also of rows that share a key's hash.

    So a partition whose rows only share a hash is rewritten as it was.
    """
    if few:
        return rows.join(keys, key, "left_semi").drop(key)
    hashed = F.xxhash64(key).alias("hash")
    others = [c for c in rows.columns if c != key]
    if known:
        rows = known.maybe(rows, key)
    return rows.select(hashed, *others).join(keys.select(hashed), "hash", "left_semi").drop("hash")


def kept_rows(rows: DataFrame, keys: DataFrame, key: str, known: BloomFilter | None) -> DataFrame:
    """The rows whose key is not in `keys`. With a filter, only those that pass it take part in a join."""
    if known is None:
        return rows.join(keys, key, "left_anti")
    # The optimizer moves an anti join below the filter's join, but not an outer one.
    marked = keys.select(key, F.lit(True).alias("__replaced"))
    passed = known.maybe(rows, key).join(marked, key, "left").filter("__replaced is null").select(*rows.columns)
    return known.never(rows, key).unionByName(passed)
