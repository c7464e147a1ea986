"""Row history: one row per version of a key, with its validity interval."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import ntz
from mercato.operators.upsert import require_unique, sync_schema
from mercato.sources.published import PublishedTable, Version

HISTORY_PARTITION = "state"
CURRENT, CLOSED = "current", "closed"
MERGED_RUNS = 8


def history_table(spark, path: str) -> PublishedTable:
    return PublishedTable(spark, path, HISTORY_PARTITION)


def snapshot(
    table: PublishedTable, source: DataFrame, key: str, check: Sequence[str], now: dt.datetime
) -> Version:
    """Publish a version of the history that reflects `source` as seen at `now`.

    A key opens a version when it is new or one of its `check` columns differs
    from the open version (NULLs compare as values); the old version then ends
    at `now`. Otherwise the open version stays as it is, other columns included.
    Keys missing from the source stay open.

    Open versions are joined with the source once. Ended versions aren't read by a run, which
    adds the newly ended ones beside them; now and then those of several runs are merged, so that
    after n runs they lie in no more than about `MERGED_RUNS` * log(n) folders.
    """
    require_unique(source, key)
    at = ntz(now)
    opened = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in source.columns],
        F.md5(
            F.concat_ws(
                "|",
                F.coalesce(F.col(f"new.{key}").cast("string"), F.lit("")),
                F.coalesce(at.cast("string"), F.lit("")),
            )
        ).alias("scd_id"),
        at.alias("updated_at"),
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    after = source.select(F.col(key).alias("key"), F.struct(*source.columns).alias("new"))
    base = table.latest()
    if base is None:
        rows = after.select(opened.alias("row"))
    else:
        layout = after.select(opened.alias("row")).select("row.*").schema
        current = sync_schema(base.read([CURRENT]), layout)
        before = current.select(F.col(key).alias("key"), F.struct(*current.columns).alias("old"))
        same = F.lit(True)
        for c in check:
            same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
        ended = F.col("old").withField("valid_to", at)
        rows = before.join(after, "key", "full_outer").select(
            F.explode(
                F.when(F.col("old").isNull(), F.array(opened))
                .when(F.col("new").isNull() | same, F.array("old"))
                .otherwise(F.array(ended, opened))
            ).alias("row")
        )
    versions = rows.select("row.*").withColumn(
        HISTORY_PARTITION, F.when(F.col("valid_to").isNull(), CURRENT).otherwise(CLOSED)
    )
    staged = table.stage(versions)
    version = table.commit(base, [staged], staged.schema, keep=[CLOSED])
    return table.merge(MERGED_RUNS) or version
