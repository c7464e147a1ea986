"""A gap-free run of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_spine(spark: SparkSession, start: dt.date, days: int) -> DataFrame:
    first = F.lit(start)
    last = F.date_add(first, days - 1)
    return spark.range(1).select(F.explode(F.sequence(first, last)).alias("date_day"))
