"""The run log: one row per finished model run, however often a run is repeated.

A run has an id. The version that it publishes names it, so that what is published and what is logged
can be compared: a run that dies between the two is logged by the next one, and a run that is repeated
after both finds that it is done. Each run's row is in a folder of its own, which a repetition writes anew.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.upsert import sync_schema
from mercato.sources.published import Version
from mercato.sources.schemas import RUN_LOG

RUN_ID = T.StructField("run_id", T.StringType())


@dataclass(frozen=True)
class Run:
    """A run of a model. Times are ISO texts of instants; `finished_at` may be given, or None."""

    id: str
    model_name: str
    started_at: str
    finished_at: str | None
    run_by: str

    def as_manifest(self) -> dict:
        """What a version keeps of the run that published it: also when that was."""
        return {**asdict(self), "published_at": _iso(dt.datetime.now(dt.timezone.utc))}


def start_run(
    spark: SparkSession,
    model_name: str,
    started_at: dt.datetime | None = None,
    finished_at: dt.datetime | None = None,
    run_by: str | None = None,
    run_id: str | None = None,
) -> Run:
    """A run that starts now, unless told otherwise. Times without a zone are UTC.

    Without an id the run gets one of its own, so repeating it is another run.
    """
    return Run(
        run_id or uuid.uuid4().hex,
        model_name,
        _iso(started_at or dt.datetime.now(dt.timezone.utc)),
        finished_at and _iso(finished_at),
        run_by or spark.range(1).select(F.current_user()).first()[0],
    )


def log_run(run: Run, version: Version, log_path: str, finished_at: str | None = None) -> None:
    """Log a run that left `version`. The row count is that of the whole table.

    Times are stored as instants, whatever the session's zone.
    """
    finished = run.finished_at or finished_at
    entry = version.read().agg(F.count("*").alias("rows_affected")).select(
        F.lit(run.model_name).alias("model_name"),
        _instant(run.started_at).alias("run_started_at"),
        (_instant(finished) if finished else F.current_timestamp()).alias("run_finished_at"),
        "rows_affected",
        F.lit(run.run_by).alias("run_by"),
        F.lit(run.id).alias(RUN_ID.name),
    )
    schema = T.StructType([*RUN_LOG.fields, RUN_ID])
    sync_schema(entry, schema).coalesce(1).write.mode("overwrite").parquet(_folder(log_path, run.id))


def append_run(
    version: Version,
    log_path: str,
    model_name: str,
    started_at: dt.datetime,
    finished_at: dt.datetime | None = None,
    run_by: str | None = None,
    run_id: str | None = None,
) -> None:
    """Log a run in one step. Without an id it is a run of its own."""
    spark = version.table.spark
    log_run(start_run(spark, model_name, started_at, finished_at, run_by, run_id), version, log_path)


def is_logged(spark: SparkSession, log_path: str, run_id: str) -> bool:
    try:
        return not spark.read.schema(RUN_LOG).parquet(_folder(log_path, run_id)).isEmpty()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def log_published(version: Version | None, log_path: str) -> None:
    """Log the run that published `version`, if it died before it did so itself."""
    if version is None or not version.run:
        return
    known = dict(version.run)
    published_at = known.pop("published_at")
    run = Run(**known)
    if not is_logged(version.table.spark, log_path, run.id):
        log_run(run, version, log_path, published_at)


def read_log(spark: SparkSession, log_path: str, with_run_id: bool = False) -> DataFrame:
    schema = T.StructType([*RUN_LOG.fields, RUN_ID]) if with_run_id else RUN_LOG
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(log_path)


def _folder(log_path: str, run_id: str) -> str:
    return f"{log_path}/run={hashlib.sha1(run_id.encode()).hexdigest()}"


def _iso(time: dt.datetime) -> str:
    utc = time.replace(tzinfo=dt.timezone.utc) if time.tzinfo is None else time.astimezone(dt.timezone.utc)
    return utc.isoformat(sep=" ")


def _instant(time: str) -> Column:
    return F.lit(time).cast("timestamp")
