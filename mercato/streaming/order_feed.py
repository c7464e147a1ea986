"""Incremental loads started by newly arrived order files."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mercato.config import Settings
from mercato.plans.pipeline import Warehouse, load_orders
from mercato.sources.raw import Sources
from mercato.sources.schemas import ORDERS


def load_on_arrival(
    spark: SparkSession,
    orders_path: str,
    open_sources: Callable[[], Sources],
    warehouse: Warehouse,
    settings: Settings,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_load: int | None = None,
) -> StreamingQuery:
    """Run the incremental order load for the files that came since the last call.

    Each load takes in the orders of the new files, however late they are, with their items,
    payments and customers; the first one builds the whole fact. A load that is repeated after
    a failure has the same run id, so what was published and logged before isn't done again.
    `open_sources` is called for each load, so that it lists the files that are there by then.
    """
    feed: Future[str] = Future()  # the id that the checkpoint keeps: a new checkpoint is another feed

    def load(batch: DataFrame, number: int) -> None:
        load_orders(
            open_sources(),
            warehouse.fct_orders,
            settings,
            run_log_path=warehouse.run_log_path,
            only_orders=batch.drop("_loaded_at").distinct(),
            run_id=f"{feed.result(60)}/{number}",
        )

    reader = spark.readStream.schema(ORDERS).format(fmt)
    if files_per_load:
        reader = reader.option("maxFilesPerTrigger", files_per_load)
    query = (
        reader.load(orders_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    feed.set_result(query.id)
    return query
