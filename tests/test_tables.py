"""Published tables, upsert, schema sync, incremental loads, run log and seller history."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mercato.operators.snapshot import history_table, snapshot
from mercato.operators.upsert import DuplicateKeyError, sync_schema, upsert
from mercato.plans import pipeline
from mercato.sources.published import PublishedTable
from mercato.sources.raw import conform, read_sources
from mercato.sources.schemas import RAW_TABLES


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    return PublishedTable(spark, str(tmp_path / "t"), "part")


def frame(spark, *data, schema="k string, v int, part string"):
    return spark.createDataFrame(list(data), schema)


# ---- published tables


def test_first_version(spark, table):
    assert table.latest() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(frame(spark, ("a", 1, "x"), ("b", 2, "y")))
    assert table.latest().number == 1
    assert table.latest().partitions() == ["x", "y"]
    assert rows(table.read()) == [("a", 1), ("b", 2)]
    assert rows(table.latest().read(["x"], with_partition=True)) == [("a", 1, "x")]


def test_empty_table_keeps_its_schema(spark, table):
    version = table.replace(frame(spark))
    assert table.read().columns == ["k", "v"]
    assert version.partitions() == []
    assert version.read(with_partition=True).columns == ["k", "v", "part"]


def test_unpublished_write_is_not_visible(spark, table):
    table.replace(frame(spark, ("a", 1, "x")))
    table.stage(frame(spark, ("b", 2, "x")))  # a run that dies before it publishes
    assert rows(table.read()) == [("a", 1)]
    table.replace(frame(spark, ("c", 3, "x")))
    assert rows(table.read()) == [("c", 3)]


def test_old_version_stays_readable(spark, table):
    first = table.replace(frame(spark, ("a", 1, "x")))
    table.replace(frame(spark, ("a", 2, "x")))
    assert rows(first.read()) == [("a", 1)]


def test_two_writers_cannot_publish_the_same_version(spark, table):
    base = table.replace(frame(spark, ("a", 1, "x")))
    mine, other = table.stage(frame(spark, ("b", 1, "x"))), table.stage(frame(spark, ("c", 1, "x")))
    table.commit(base, [mine], mine.schema)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table.commit(base, [other], other.schema)


# ---- upsert


def test_upsert_replaces_inserts_and_never_deletes(spark, table):
    first = upsert(table, None, frame(spark, ("both", 1, "x"), ("old", 1, "x"), ("far", 1, "y")), "k")
    second = upsert(table, first, frame(spark, ("both", 2, "x"), ("new", 2, "z")), "k")
    assert rows(table.read()) == [("both", 2), ("far", 1), ("new", 2), ("old", 1)]
    # only the partition with a replaced row was rewritten
    batches = {f["partition"]: f["batch"] for f in first.folders}
    assert [f["partition"] for f in second.folders if f["batch"] == batches["y"]] == ["y"]


def test_upsert_moves_a_row_to_another_partition(spark, table):
    first = upsert(table, None, frame(spark, ("a", 1, "x"), ("b", 1, "y")), "k")
    version = upsert(table, first, frame(spark, ("a", 2, "y")), "k")
    assert rows(version.read(with_partition=True)) == [("a", 2, "y"), ("b", 1, "y")]
    assert version.partitions() == ["y"]


def test_upsert_twice_changes_nothing(spark, table):
    first = upsert(table, None, frame(spark, ("a", 1, "x"), ("b", 1, "y")), "k")
    batch = frame(spark, ("a", 2, "x"), ("c", 2, "y"))
    once = upsert(table, first, batch, "k")
    before = rows(once.read())
    assert rows(upsert(table, once, batch, "k").read()) == before


def test_upsert_refuses_duplicate_keys(spark, table):
    first = upsert(table, None, frame(spark, ("a", 1, "x")), "k")
    with pytest.raises(DuplicateKeyError, match="'b'"):
        upsert(table, first, frame(spark, ("b", 1, "x"), ("b", 2, "y")), "k")
    assert rows(table.read()) == [("a", 1)]


def test_upsert_without_partitions(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"))
    first = upsert(table, None, frame(spark, ("a", 1), ("b", 1), schema="k string, v int"), "k")
    upsert(table, first, frame(spark, ("a", 2), schema="k string, v int"), "k")
    assert rows(table.read()) == [("a", 2), ("b", 1)]


def test_schema_sync_in_an_upsert(spark, table):
    first = upsert(table, None, frame(spark, ("a", 1, "x"), ("b", 1, "y")), "k")
    wider = frame(spark, ("a", "new", "x"), schema="k string, w string, part string")
    second = upsert(table, first, wider, "k")
    assert second.read().columns == ["k", "w"]
    assert rows(table.read()) == [("a", "new"), ("b", None)]
    # a dropped column that comes back is empty, although old files still hold it
    third = upsert(table, second, frame(spark, ("c", 3, "z")), "k")
    assert rows(third.read()) == [("a", None), ("b", None), ("c", 3)]


def test_changed_type_is_adopted_everywhere(spark, table):
    first = upsert(table, None, frame(spark, ("a", 1, "x"), ("b", 1, "y")), "k")
    batch = frame(spark, ("a", 2**40, "x"), schema="k string, v bigint, part string")
    assert rows(upsert(table, first, batch, "k").read()) == [("a", 2**40), ("b", 1)]


def test_sync_schema(spark):
    old = frame(spark, ("a", 1, "gone"), schema="k string, v int, x string")
    new = frame(spark, schema="k string, n double, v bigint").schema
    assert sync_schema(old, new).schema == new
    assert rows(sync_schema(old, new)) == [("a", None, 1)]


# ---- the incremental order fact


@pytest.fixture
def shop(make_sources, order, item):
    def make(**changes):
        days = {"o1": "2018-01-01", "o2": "2018-01-20", "o3": "2018-01-22"} | changes.pop("days", {})
        return make_sources(
            orders=[
                order(k, order_purchase_timestamp=f"{day} 10:00:00", **changes.get(k, {}))
                for k, day in days.items()
            ],
            order_items=[item(k) for k in days],
        )

    return make


def load(warehouse, src, settings, **options):
    pipeline.load_orders(src, warehouse.fct_orders, settings, **options)
    return {r.order_id: r for r in warehouse.fct_orders.read().collect()}


@pytest.fixture
def warehouse(spark, tmp_path):
    return pipeline.Warehouse(spark, str(tmp_path / "w"))


def test_incremental_load_looks_back_three_days(warehouse, settings, shop):
    assert set(load(warehouse, shop(), settings)) == {"o1", "o2", "o3"}
    later = {
        "o1": {"order_status": "shipped"},
        "o2": {"order_status": "shipped"},
        "days": {"o4": "2018-02-01", "late": "2018-01-19", "too_late": "2018-01-10"},
    }
    loaded = load(warehouse, shop(**later), settings)
    assert set(loaded) == {"o1", "o2", "o3", "o4", "late"}
    # old orders are not refreshed; recent ones are
    assert loaded["o1"].order_status == "delivered"
    assert loaded["o2"].order_status == "shipped"
    # a full refresh sees everything
    full = load(warehouse, shop(**later), settings, full_refresh=True)
    assert set(full) == {"o1", "o2", "o3", "o4", "late", "too_late"}
    assert full["o1"].order_status == "shipped"


def test_incremental_equals_full_when_only_recent_orders_change(spark, warehouse, settings, shop, tmp_path):
    load(warehouse, shop(), settings)
    later = shop(o3={"order_status": "canceled"}, days={"o4": "2018-02-03"})
    incremental = load(warehouse, later, settings)
    other = pipeline.Warehouse(spark, str(tmp_path / "full"))
    assert load(other, later, settings) == incremental


@pytest.mark.parametrize("partition", ["month", "day"])
def test_partition_sizes(warehouse, settings, shop, partition):
    load(warehouse, shop(), replace(settings, fact_partition=partition))
    expected = {"month": ["2018-01"], "day": ["2018-01-01", "2018-01-20", "2018-01-22"]}
    assert warehouse.fct_orders.latest().partitions() == expected[partition]


def test_empty_target(warehouse, settings, shop, make_sources):
    assert load(warehouse, make_sources(), settings) == {}
    assert load(warehouse, shop(), settings) == {}  # no watermark, so nothing
    assert set(load(warehouse, shop(), replace(settings, empty_target="full"))) == {"o1", "o2", "o3"}


def test_duplicate_items_are_refused(warehouse, settings, make_sources, order, item):
    src = make_sources(orders=[order("o1")], order_items=[item("o1"), item("o1")])
    with pytest.raises(DuplicateKeyError):
        load(warehouse, src, settings)
    assert warehouse.fct_orders.latest() is None


@pytest.mark.parametrize(
    "options",
    [
        {"broadcast_max_rows": 0, "broadcast_max_ids": 0},
        {"broadcast_max_rows": 1},
        {"fixed_order_times": True},
        {"fact_partition": "day"},
    ],
)
def test_incremental_plans_agree(warehouse, settings, shop, options):
    settings = replace(settings, **options)
    load(warehouse, shop(), settings)
    loaded = load(warehouse, shop(o3={"order_status": "canceled"}, days={"o4": "2018-02-03"}), settings)
    assert {k: r.order_status for k, r in loaded.items()} == {
        "o1": "delivered",
        "o2": "delivered",
        "o3": "canceled",
        "o4": "delivered",
    }


def test_run_log_counts_the_whole_table(warehouse, settings, shop):
    log = {"run_log_path": warehouse.run_log_path}
    load(warehouse, shop(), settings, started_at=dt.datetime(2018, 1, 23), run_by="me", **log)
    load(warehouse, shop(days={"o4": "2018-02-01"}), settings, **log)
    entries = warehouse.run_log().orderBy("run_started_at").collect()
    assert [e.rows_affected for e in entries] == [3, 4]
    assert entries[0].run_started_at == dt.datetime(2018, 1, 23)
    assert entries[0].run_by == "me" and entries[1].run_by
    assert {e.model_name for e in entries} == {"fct_orders"}


def log_rows(warehouse):
    return sorted((e.run_id, e.rows_affected) for e in warehouse.run_log(with_run_id=True).collect())


def test_a_repeated_run_is_neither_published_nor_logged_again(warehouse, settings, shop):
    log = {"run_log_path": warehouse.run_log_path}
    load(warehouse, shop(), settings, run_id="a", **log)
    load(warehouse, shop(days={"o4": "2018-02-01"}), settings, run_id="b", **log)
    for repeated in ("b", "a", "b"):
        got = load(warehouse, shop(days={"o5": "2018-02-02"}), settings, run_id=repeated, **log)
        assert set(got) == {"o1", "o2", "o3", "o4"}
    assert warehouse.fct_orders.latest().number == 2
    assert log_rows(warehouse) == [("a", 3), ("b", 4)]


@pytest.mark.parametrize("next_id", ["b", "c", None])
def test_a_run_that_dies_before_it_is_logged(warehouse, settings, shop, monkeypatch, next_id):
    """It is logged by the next run, with its own times and the rows of its own version."""
    log = {"run_log_path": warehouse.run_log_path}
    load(warehouse, shop(), settings, run_id="a", **log)
    later = shop(days={"o4": "2018-02-01"})
    with monkeypatch.context() as patch:
        patch.setattr(pipeline.audit, "log_run", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load(warehouse, later, settings, run_id="b", started_at=dt.datetime(2018, 2, 2), run_by="me", **log)
    assert log_rows(warehouse) == [("a", 3)]
    load(warehouse, shop(days={"o4": "2018-02-01", "o5": "2018-02-03"}), settings, run_id=next_id, **log)
    entries = {e.run_id: e for e in warehouse.run_log(with_run_id=True).collect()}
    assert len(entries) == (2 if next_id == "b" else 3)
    assert (entries["b"].rows_affected, entries["b"].run_by) == (4, "me")
    assert entries["b"].run_started_at == dt.datetime(2018, 2, 2)
    assert entries["b"].run_finished_at > entries["b"].run_started_at
    assert sorted(e.rows_affected for e in entries.values()) == [3, 4, 5][: len(entries)]


def test_a_run_that_dies_before_it_publishes_is_done_again(warehouse, settings, shop, monkeypatch):
    log = {"run_log_path": warehouse.run_log_path}
    load(warehouse, shop(), settings, run_id="a", **log)
    later = shop(days={"o4": "2018-02-01"})
    with monkeypatch.context() as patch:
        patch.setattr(PublishedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            load(warehouse, later, settings, run_id="b", **log)
    assert set(load(warehouse, later, settings, run_id="b", **log)) == {"o1", "o2", "o3", "o4"}
    assert log_rows(warehouse) == [("a", 3), ("b", 4)]


def test_log_rows_of_before_run_ids_stay_readable(spark, warehouse, settings, shop):
    old = spark.createDataFrame(
        [("fct_orders", dt.datetime(2017, 1, 1), dt.datetime(2017, 1, 2), 1, "old")],
        "model_name string, run_started_at timestamp, run_finished_at timestamp, rows_affected bigint, run_by string",
    )
    old.write.parquet(warehouse.run_log_path)
    load(warehouse, shop(), settings, run_log_path=warehouse.run_log_path, run_by="new")
    assert sorted(r.run_by for r in warehouse.run_log().collect()) == ["new", "old"]


def test_whole_run(spark, warehouse, settings, shop):
    pipeline.load_seed(warehouse)
    for _ in range(2):
        pipeline.run(shop(), warehouse, settings)
    assert warehouse.seed.read().count() == 4
    assert warehouse.table("dim_date").read().count() == 1826
    assert warehouse.fct_orders.read().count() == 3
    results = pipeline.run_quality_suite(shop(), warehouse, settings).collect()
    assert len(results) == 51
    failed = {r.check for r in results if r.status == "fail"}
    assert failed == {"not_null_fct_orders_customer_key"}


# ---- seller history


T1, T2, T3 = (dt.datetime(2018, m, 1) for m in (1, 2, 3))


def sellers(spark, *data):
    return spark.createDataFrame(
        list(data), "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix string"
    )


def take(spark, table, now, *data):
    snapshot(table, sellers(spark, *data), "seller_id", pipeline.SELLER_CHECK_COLUMNS, now)
    return sorted(
        ((r.seller_id, r.seller_city, r.seller_zip_code_prefix, r.valid_from, r.valid_to) for r in table.read().collect()),
        key=str,
    )


def test_history(spark, tmp_path):
    table = history_table(spark, str(tmp_path / "h"))
    take(spark, table, T1, ("changed", "x", "S", "1"), ("same", "x", "S", "1"), ("gone", "x", "S", "1"))
    result = take(spark, table, T2, ("changed", "X", "S", "1"), ("same", "x", "S", "2"), ("new", "x", "S", "1"))
    assert result == [
        ("changed", "X", "1", T2, None),
        ("changed", "x", "1", T1, T2),
        ("gone", "x", "1", T1, None),
        ("new", "x", "1", T2, None),
        ("same", "x", "1", T1, None),  # the zip is not watched
    ]
    # back again: a third version, the closed ones untouched
    result = take(spark, table, T3, ("changed", "x", "S", "1"))
    assert [r for r in result if r[0] == "changed"] == [
        ("changed", "X", "1", T2, T3),
        ("changed", "x", "1", T1, T2),
        ("changed", "x", "1", T3, None),
    ]


def test_history_compares_null_as_a_value(spark, tmp_path):
    table = history_table(spark, str(tmp_path / "h"))
    take(spark, table, T1, ("a", "x", None, "1"), ("b", "x", "S", "1"))
    result = take(spark, table, T2, ("a", "x", None, "1"), ("b", "x", None, "1"))
    assert {(r[0], r[2], r[4]) for r in result} == {("a", "1", None), ("b", "1", None), ("b", "1", T2)}


def test_history_invariants(spark, tmp_path):
    table = history_table(spark, str(tmp_path / "h"))
    for n, now in enumerate((T1, T2, T3)):
        take(spark, table, now, *[(str(i), str(i * n % 4), "S", "1") for i in range(20)])
    per_seller = (
        table.read()
        .groupBy("seller_id")
        .agg(
            F.count(F.when(F.col("valid_to").isNull(), 1)).alias("open"),
            F.count("*").alias("n"),
            F.countDistinct("scd_id").alias("ids"),
            F.countDistinct("valid_from").alias("starts"),
        )
        .collect()
    )
    assert all(r.open == 1 and r.n == r.ids == r.starts for r in per_seller)
    # no gap and no overlap: every end is the start of the next version
    a, b = table.read().alias("a"), table.read().alias("b")
    following = a.filter("valid_to is not null").join(
        b, F.expr("a.seller_id = b.seller_id and a.valid_to = b.valid_from"), "left_anti"
    )
    assert following.count() == 0


def test_folders_of_ended_versions_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("mercato.operators.snapshot.MERGED_RUNS", 3)
    table, plain = (history_table(spark, str(tmp_path / n)) for n in ("merged", "plain"))
    early = None
    for n in range(10):
        now = T1 + dt.timedelta(days=n)
        got = take(spark, table, now, ("a", str(n), "S", "1"), ("b", str(n // 4), "S", "1"))
        monkeypatch.setattr("mercato.operators.snapshot.MERGED_RUNS", 10**9)
        assert take(spark, plain, now, ("a", str(n), "S", "1"), ("b", str(n // 4), "S", "1")) == got
        monkeypatch.setattr("mercato.operators.snapshot.MERGED_RUNS", 3)
        if n == 4:
            early = table.latest()
            before = rows(early.read())
    closed = [f for f in table.latest().folders if f["partition"] == "closed"]
    assert len(closed) <= 2 * 3 < len([f for f in plain.latest().folders if f["partition"] == "closed"])
    assert rows(early.read()) == before  # an older version reads its own folders


def test_merged_folders_after_many_writes(spark, table):
    """50 writes beside each other; each row is rewritten once per level."""
    version = None
    for n in range(50):
        staged = table.stage(frame(spark, (f"k{n}", n, "closed")).coalesce(1))
        version = table.commit(version, [staged], staged.schema, keep=["closed"], run={"n": n})
        version = table.merge(4)
        assert version.run == {"n": n}
        assert len(version.folders) <= 3 * 3 + 1
    assert rows(version.read()) == rows(frame(spark, *[(f"k{n}", n, "closed") for n in range(50)]).drop("part"))
    assert max(f.get("level", 0) for f in version.folders) == 2
    assert table.merge(4).number == version.number  # nothing to do


def test_merged_folders_of_unlike_columns(spark, table):
    first = table.replace(frame(spark, ("a", 1, "x")))
    wide = table.stage(frame(spark, ("b", 2, 0.5, "x"), schema="k string, v int, w double, part string"))
    table.commit(first, [wide], wide.schema, keep=["x"])
    merged = table.merge(2)
    assert len(merged.folders) == 1
    assert rows(merged.read()) == [("a", 1, None), ("b", 2, 0.5)]


def test_history_refuses_duplicate_sellers(spark, tmp_path):
    with pytest.raises(DuplicateKeyError):
        take(spark, history_table(spark, str(tmp_path / "h")), T1, ("a", "x", "S", "1"), ("a", "y", "S", "1"))


# ---- raw tables


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc", "json"])
def test_raw_files(spark, tmp_path, make_sources, order, item, fmt):
    src = make_sources(orders=[order("o1", order_approved_at=None)], order_items=[item("o1")])
    names = {t: t.upper() for t in RAW_TABLES}
    for t in RAW_TABLES:
        extra = getattr(src, t).withColumn("extra", F.lit("ignored"))
        extra.write.format(fmt).options(header=True).save(f"{tmp_path}/{names[t]}")
    read = read_sources(spark, str(tmp_path), fmt, names)
    if fmt in ("parquet", "orc", "csv"):
        for t in ("orders", "order_items"):
            assert getattr(read, t).schema.simpleString() == getattr(src, t).schema.simpleString()
            assert rows(getattr(read, t)) == rows(getattr(src, t))


def test_raw_catalog_tables(spark, make_sources, order):
    src = make_sources(orders=[order("o1")])
    src.orders.createOrReplaceGlobalTempView("orders_raw")
    names = dict.fromkeys(RAW_TABLES, "orders_raw")
    assert rows(read_sources(spark, "global_temp", "table", names).orders) == rows(src.orders)


def test_missing_raw_column(spark):
    with pytest.raises(ValueError, match="seller_city"):
        conform(spark.createDataFrame([("a",)], "seller_id string"), RAW_TABLES["sellers"], "sellers")
