"""Lookups joined onto a large frame whose keys may be badly skewed.

A lookup holds one row per key. Small lookups (counted, not guessed) are
broadcast. For the others the rows of the large side are shuffled by key, after
hot keys were found and split: a hot key's rows are spread over several salts,
and its single lookup row is repeated once per salt. NULL is a key like any
other here, because unmatched NULL rows are shuffled too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.config import Settings

_SPREAD = "__spread"
_SALT = "__salt"
_SALTS = "__salts"

# Key values are first counted in this many hash buckets per column, far more
# than there can be hot keys (at most 1 / hot_key_share).
_BUCKETS = 8192


@dataclass(frozen=True)
class Lookup:
    frame: DataFrame
    on: str
    how: str = "left"
    # Returns the row count of `frame`, or a bound that is cheaper to get.
    size: Callable[[], int] | None = None
    # Whether the frame holds hardly more than ids, for which the larger row limit holds.
    only_ids: bool = False


def row_bytes(frame: DataFrame) -> int:
    """About what a row takes in a broadcast: 8 bytes a column, 40 for a text or anything nested."""
    wide = ("string", "binary", "array", "map", "struct")
    return 16 + sum(40 if f.dataType.typeName() in wide else 8 for f in frame.schema.fields)


def fits_broadcast(
    size: Callable[[], int], limit: int, frame: DataFrame | None = None, max_bytes: int | None = None
) -> bool:
    """Whether a frame is small enough to broadcast. Counting a stored table reads footers only."""
    if frame is not None and max_bytes is not None:
        limit = min(limit, max_bytes // row_bytes(frame))
    return limit > 0 and size() <= limit


def only_keys_of(rows: DataFrame, few: DataFrame, column: str) -> DataFrame:
    """The rows whose `column` occurs in `few`, whose size was checked. No shuffle."""
    return rows.join(F.broadcast(few.select(column)), column, "left_semi")


def id_exceptions(rows: DataFrame, ids: DataFrame, column: str, flag: str, settings: Settings) -> DataFrame | None:
    """(column, flag): the values in `rows` that `ids` lacks, with flag false, and those that it repeats, each time with
    true. None where these are too many to broadcast.

    With them a left join that only tells whether a value is known needs no shuffle of whole rows: a value without an
    exception is known once. Distinct values are shuffled instead, reduced map-side. The found ones stay
    cached, as they are counted first.
    """
    limit = max(settings.broadcast_max_rows, settings.broadcast_max_ids)
    if limit <= 0:
        return None
    asked = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    times = ids.groupBy(column).agg(F.count("*").alias("__times"))
    found = (
        asked.join(times, column, "left")
        .filter("__times is null or __times > 1")
        .select(
            column,
            F.col("__times").isNotNull().alias(flag),
            F.explode(F.sequence(F.lit(1), F.coalesce("__times", F.lit(1)))).alias("__time"),
        )
        .drop("__time")
        .persist()
    )
    if fits_broadcast(found.count, limit, found, settings.broadcast_max_bytes):
        return found
    found.unpersist()
    return None


class KnownHotKeys:
    """Hot keys of whole tables, found once."""

    def __init__(self):
        self._found: dict[tuple, DataFrame | None] = {}

    def get(
        self, table: str, df: DataFrame, columns: Iterable[str], rows: int, settings: Settings
    ) -> dict[str, DataFrame]:
        """Those of `df`, which holds all rows of the table of that name."""
        limits = (settings.hot_key_min_rows, settings.hot_key_share)
        columns = list(columns)
        missing = [c for c in columns if (table, c, limits) not in self._found]
        if missing:
            found = hot_keys(df, missing, rows, settings)
            self._found |= {(table, c, limits): found.get(c) for c in missing}
        known = {c: self._found[table, c, limits] for c in columns}
        return {c: frame for c, frame in known.items() if frame is not None}


def hot_keys(
    df: DataFrame, columns: Iterable[str], rows: int, settings: Settings
) -> dict[str, DataFrame]:
    """For each column that has hot values: a frame (column, number of salts).

    `rows` is the size of `df`, or more. Counting all keys would shuffle as much
    as the join itself. So rows are counted per hash bucket in one pass, map-side
    first, and only the keys of buckets heavy enough to hold a hot key are
    counted one by one; mostly there are none. At most 1 / hot_key_share buckets
    and keys of a column can be that heavy, so collecting them is safe.
    """
    least = max(settings.hot_key_min_rows, int(rows * settings.hot_key_share))
    # Small portions, as several may end up in the same task.
    rows_per_salt = max(1, settings.hot_key_min_rows // 4)

    def bucket(column: str):
        return F.pmod(F.xxhash64(column), F.lit(_BUCKETS))

    keys = [F.struct(F.lit(c).alias("column"), bucket(c).alias("bucket")) for c in columns]
    heavy: dict[str, list[int]] = {}
    counted = df.select(F.inline(F.array(*keys))).groupBy("column", "bucket").count()
    for row in counted.filter(F.col("count") >= least).collect():
        heavy.setdefault(row["column"], []).append(row["bucket"])

    found = {}
    for column, buckets in heavy.items():
        counted = df.filter(bucket(column).isin(buckets)).groupBy(column).count()
        hot = [
            (row[column], -(-row["count"] // rows_per_salt))
            for row in counted.filter(F.col("count") >= least).collect()
        ]
        if hot:
            kind = df.schema[column].dataType.simpleString()
            found[column] = df.sparkSession.createDataFrame(hot, f"{column} {kind}, {_SALTS} int")
    return found


def _salted_join(left: DataFrame, lookup: Lookup, hot: DataFrame) -> DataFrame:
    key = lookup.on
    salts = F.broadcast(hot.withColumnRenamed(key, "__hot"))
    left = (
        left.join(salts, F.col(key).eqNullSafe(F.col("__hot")), "left")
        .withColumn(_SALT, F.coalesce(F.pmod(_SPREAD, _SALTS), F.lit(0).cast("bigint")))
        .drop("__hot", _SALTS)
    )
    right = (
        lookup.frame.join(salts, F.col(key) == F.col("__hot"), "left")
        .withColumn(
            _SALT,
            F.explode(
                F.sequence(
                    F.lit(0).cast("bigint"), F.coalesce(F.col(_SALTS), F.lit(1)).cast("bigint") - 1
                )
            ),
        )
        .drop("__hot", _SALTS)
    )
    return left.join(right, [key, _SALT], lookup.how).drop(_SALT)


def enrich(
    base: DataFrame,
    lookups: Iterable[Lookup],
    settings: Settings,
    size: Callable[[], int] | None = None,
    known_hot: tuple[KnownHotKeys, str] | None = None,
) -> DataFrame:
    """Join every lookup onto `base` (how: left, inner, left_semi or left_anti).

    Broadcast lookups go first, as they need no shuffle; row-reducing ones lead.
    The others follow in the given order, so list those that add few columns first.
    `base` should read stored tables directly: the spreading numbers are taken
    from it, and must come out the same when a lost task runs again. `size` returns
    its row count, or a bound that is cheaper to get. `known_hot` keeps the hot keys of the
    table that `base` is the whole of.
    """
    small, large = [], []
    for x in lookups:
        limit = settings.broadcast_max_ids if x.only_ids else settings.broadcast_max_rows
        is_small = fits_broadcast(x.size or x.frame.count, limit, x.frame, settings.broadcast_max_bytes)
        (small if is_small else large).append(x)
    rows = (size or base.count)() if large else 0
    if rows >= settings.hot_key_min_rows:
        columns = list(dict.fromkeys(x.on for x in large))
        if known_hot is None:
            hot = hot_keys(base, columns, rows, settings)
        else:
            hot = known_hot[0].get(known_hot[1], base, columns, rows, settings)
    else:  # no key can be hot
        hot = {}
    if hot:
        base = base.withColumn(_SPREAD, F.xxhash64(F.monotonically_increasing_id()))
    for x in sorted(small, key=lambda x: x.how == "left"):
        base = base.join(F.broadcast(x.frame), x.on, x.how)
    for x in large:
        if x.on in hot:
            base = _salted_join(base, x, hot[x.on])
        else:
            base = base.join(x.frame, x.on, x.how)
    return base.drop(_SPREAD)
