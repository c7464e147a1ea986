from __future__ import annotations

from mercato.plans.pipeline import Warehouse
from mercato.sources.raw import read_sources
from mercato.sources.schemas import RAW_TABLES
from mercato.streaming.order_feed import load_on_arrival


def test_loads_follow_new_files(spark, tmp_path, settings, make_sources, order, item):
    names = {t: t for t in RAW_TABLES}

    def deliver(days: dict[str, str]) -> None:
        src = make_sources(
            orders=[order(k, order_purchase_timestamp=f"{d} 10:00:00") for k, d in days.items()],
            order_items=[item(k) for k in days],
        )
        for t in RAW_TABLES:
            getattr(src, t).write.mode("append").parquet(f"{tmp_path}/raw/{t}")

    warehouse = Warehouse(spark, str(tmp_path / "w"))

    def run(checkpoint: str = "checkpoint") -> set[str]:
        load_on_arrival(
            spark,
            f"{tmp_path}/raw/orders",
            lambda: read_sources(spark, f"{tmp_path}/raw", names=names),
            warehouse,
            settings,
            str(tmp_path / checkpoint),
        ).awaitTermination(120)
        return {r.order_id for r in warehouse.fct_orders.read().collect()}

    deliver({"o1": "2018-01-01"})
    assert run() == {"o1"}
    deliver({"o2": "2018-01-02", "late": "2017-12-01"})
    assert run() == {"o1", "o2", "late"}
    assert warehouse.run_log().count() == 2
    assert run() == {"o1", "o2", "late"}  # nothing new, so no load
    assert warehouse.run_log().count() == 2

    # a load that was done but not noted in the checkpoint comes again, and finds that it is done
    (tmp_path / "checkpoint/commits/1").unlink()
    (tmp_path / "checkpoint/commits/.1.crc").unlink(missing_ok=True)
    assert run() == {"o1", "o2", "late"}
    assert warehouse.run_log().count() == 2
    assert warehouse.fct_orders.latest().number == 2
    # another checkpoint is another feed, whose loads are its own
    assert run("again") == {"o1", "o2", "late"}
    assert warehouse.run_log().count() == 3
