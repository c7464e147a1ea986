"""The exchange-rate reference table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from mercato.sources.schemas import EXCHANGE_RATES

# Rates to one US dollar unit.
RATES = [
    ("BRL", "Brazilian Real", 0.20, dt.date(2018, 1, 1)),
    ("INR", "Indian Rupee", 0.014, dt.date(2018, 1, 1)),
    ("USD", "US Dollar", 1.00, dt.date(2018, 1, 1)),
    ("EUR", "Euro", 1.18, dt.date(2018, 1, 1)),
]


def exchange_rates(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """The rates above, or those of a CSV file with a header on shared storage."""
    if csv_path is None:
        return spark.createDataFrame(RATES, EXCHANGE_RATES)
    return (
        spark.read.schema(EXCHANGE_RATES)
        .options(header=True, enforceSchema=False, mode="FAILFAST")
        .csv(csv_path)
    )
