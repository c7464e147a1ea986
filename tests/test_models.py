"""Models on small hand-made inputs, one test per rule that is easy to get wrong."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest

from mercato.plans import dimensions, facts, intermediate, kpis, staging


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_staging_renames_casts_and_upper_cases(make_sources, order):
    src = make_sources(
        orders=[order("o1")],
        customers=[{"customer_id": "c", "customer_city": "são paulo"}],
        sellers=[{"seller_id": "s", "seller_city": "curitiba", "seller_zip_code_prefix": "01234"}],
        geolocation=[{"geolocation_city": "são josé"}] * 2,
    )
    assert staging.customers(src).first().customer_city == "SÃO PAULO"
    seller = staging.sellers(src).first()
    assert (seller.seller_city, seller.seller_zip_code_prefix) == ("CURITIBA", "01234")
    assert [r.geolocation_city for r in staging.geolocation(src).collect()] == ["SÃO JOSÉ"] * 2
    placed = staging.orders(src)
    assert dict(placed.dtypes)["ordered_at"] == "timestamp_ntz"
    assert placed.first().ordered_at == dt.datetime(2018, 1, 1, 10)


def test_staging_views(spark, make_sources, order):
    assert "stg_orders" in staging.create_views(make_sources(orders=[order("o1")]))
    assert spark.sql("select count(*) from stg_orders").first()[0] == 1


def test_payment_types_need_not_add_up(make_sources):
    src = make_sources(
        payments=[
            {"order_id": "o1", "payment_type": "not_defined", "payment_installments": 1, "payment_value": 5.0},
            {"order_id": "o2", "payment_type": "voucher", "payment_installments": 1, "payment_value": 0.1},
            {"order_id": "o2", "payment_type": "credit_card", "payment_installments": 3, "payment_value": 0.2},
        ]
    )
    rows = by(intermediate.order_payments_summary(src), "order_id")
    assert rows["o1"].total_payment_value == Decimal("5.00")
    assert [rows["o1"][c] for c in intermediate.PAYMENT_TYPE_COLUMNS.values()] == [0, 0, 0, 0]
    assert rows["o2"].total_payment_value == Decimal("0.30")
    assert (rows["o2"].max_installments, rows["o2"].installment_payment_count) == (3, 1)
    assert rows["o2"].payment_record_count == 2


@pytest.mark.parametrize(
    ("values", "delay", "on_time"),
    [
        # days are calendar days, also 23:30 to 00:30
        (
            {
                "order_estimated_delivery_date": "2018-01-01 23:30:00",
                "order_delivered_customer_date": "2018-01-02 00:30:00",
            },
            1,
            False,
        ),
        # later on the estimated day: no delay, but not on time
        (
            {
                "order_estimated_delivery_date": "2018-01-05 00:00:00",
                "order_delivered_customer_date": "2018-01-05 10:00:00",
            },
            0,
            False,
        ),
        ({"order_estimated_delivery_date": None}, None, False),
        ({"order_delivered_customer_date": None}, None, None),
        ({"order_delivered_customer_date": "2018-01-10 00:00:00"}, 0, True),
    ],
)
def test_delivery_delay(make_sources, order, values, delay, on_time):
    row = intermediate.delivery_performance(make_sources(orders=[order("o1", **values)])).first()
    assert (row.delivery_delay_days, row.is_on_time_delivery) == (delay, on_time)


def test_seller_deadline_is_the_earliest_one(make_sources, order, item):
    src = make_sources(
        orders=[
            order("two", order_delivered_carrier_date="2018-01-05 00:00:00"),
            order("none"),
            order("unshipped", order_delivered_carrier_date=None),
            order("in_time", order_delivered_carrier_date="2018-01-03 00:00:00"),
        ],
        order_items=[
            item("two", 1, shipping_limit_date="2018-01-03 00:00:00"),
            item("two", 2, shipping_limit_date="2018-01-09 00:00:00"),
            item("unshipped"),
            item("in_time"),
        ],
    )
    rows = by(intermediate.delivery_performance(src), "order_id")
    assert rows["two"].is_seller_sla_breach is True
    assert rows["none"].is_seller_sla_breach is True  # shipped, but no deadline known
    assert rows["unshipped"].is_seller_sla_breach is None
    assert rows["in_time"].is_seller_sla_breach is False
    assert rows["two"].seller_processing_days == 4


def test_leaving_out_the_deadline_changes_nothing_else(make_sources, order):
    src = make_sources(orders=[order("o1"), order("o2", order_delivered_customer_date=None)])
    columns = ["order_id", "delivery_delay_days", "is_on_time_delivery"]
    full = intermediate.delivery_performance(src).select(*columns)
    assert sorted(map(str, full.collect())) == sorted(
        map(str, intermediate.delivery_performance(src, columns).collect())
    )


def test_orphan_item_is_in_the_wide_frame_but_not_in_the_fact(make_sources, settings, order, item):
    src = make_sources(orders=[order("o1")], order_items=[item("o1"), item("lost")])
    wide = by(intermediate.orders_joined(src, settings), "order_id")
    assert set(wide) == {"o1", "lost"}
    assert wide["lost"].ordered_at is None
    assert wide["o1"].item_total_value == 12.5
    assert set(by(facts.fct_orders(src, settings), "order_id")) == {"o1"}


def test_category_name_falls_back(make_sources, settings):
    src = make_sources(
        products=[
            {"product_id": "a", "product_category_name": "perfumaria"},
            {"product_id": "b", "product_category_name": "pc_gamer"},
            {"product_id": "c"},
        ],
        category_translation=[
            {"product_category_name": "perfumaria", "product_category_name_english": "perfumery"}
        ],
    )
    rows = by(dimensions.dim_products(src, settings), "product_id")
    assert [rows[k].product_category_name_english for k in "abc"] == ["perfumery", "pc_gamer", None]


def test_volume_is_larger_than_an_int(make_sources, settings):
    side = {"product_length_cm": 3000, "product_height_cm": 3000, "product_width_cm": 3000}
    src = make_sources(products=[{"product_id": "a", **side}, {"product_id": "b"}])
    rows = by(dimensions.dim_products(src, settings), "product_id")
    assert (rows["a"].product_volume_cm3, rows["b"].product_volume_cm3) == (27_000_000_000, None)


def test_customer_with_the_greatest_id_wins(make_sources):
    src = make_sources(
        customers=[
            {"customer_id": "a", "customer_unique_id": "u", "customer_city": "x"},
            {"customer_id": "b", "customer_unique_id": "u", "customer_city": "y"},
            {"customer_id": "z", "customer_unique_id": "v", "customer_city": "x"},
            {"customer_id": None, "customer_unique_id": "v", "customer_city": "y"},
        ]
    )
    rows = by(dimensions.dim_customers(src), "customer_unique_id")
    assert (rows["u"].customer_city, rows["v"].customer_city) == ("Y", "Y")


def test_calendar(spark, settings):
    days = by(dimensions.dim_date(spark, settings), "date_day")
    assert len(days) == 1826
    assert max(days) == dt.date(2020, 12, 30)
    friday, saturday, sunday = (days[dt.date(2016, 1, d)] for d in (1, 2, 3))
    assert [d.day_of_week for d in (friday, saturday, sunday)] == [5, 6, 0]
    assert [d.is_weekend for d in (friday, saturday, sunday)] == [False, True, True]
    assert {d.week_of_year for d in (friday, saturday, sunday)} == {53}
    assert friday.date_key == "c46a7804ddf64c8dcf7a764fbe0172d2"
    assert (sunday.month_name, sunday.month_short, sunday.day_name_short) == ("January", "Jan", "Sun")
    assert (sunday.year_month, sunday.quarter_label, sunday.date_formatted) == (
        "2016-01",
        "Q1-2016",
        "03/01/2016",
    )


def test_fact_keys_and_range(make_sources, settings, order, item):
    src = make_sources(
        orders=[
            order("o1"),
            order("early", order_purchase_timestamp="2015-12-31 23:59:59"),
            order("first", order_purchase_timestamp="2016-01-01 00:00:00"),
            order("last", order_purchase_timestamp="2020-12-31 10:00:00"),
        ],
        customers=[{"customer_id": "c-o1", "customer_unique_id": "u1"}],
        sellers=[{"seller_id": "s1"}],
        products=[{"product_id": "p1"}],
        order_items=[
            item("o1"),
            item("early"),
            item("first", seller_id="unknown"),
            item("last", product_id=None),
        ],
    )
    fact = facts.fct_orders(src, settings)
    assert fact.columns == facts.FCT_ORDERS_COLUMNS
    rows = by(fact, "order_id")
    assert set(rows) == {"o1", "first", "last"}
    people = by(dimensions.dim_customers(src), "customer_unique_id")
    assert rows["o1"].customer_key == people["u1"].customer_key
    assert rows["o1"].seller_key == dimensions.dim_sellers(src).first().seller_key
    assert rows["o1"].product_key == dimensions.dim_products(src, settings).first().product_key
    assert rows["first"].customer_key is None
    assert rows["first"].seller_key is None
    assert rows["last"].product_key is None
    assert rows["last"].order_date_key is None  # the calendar ends a day earlier
    assert rows["first"].order_date_key is not None


@pytest.mark.parametrize("column", facts.FCT_ORDERS_COLUMNS)
def test_single_columns_of_the_fact(make_sources, settings, order, item, column):
    """Leaving parts out of the plan must not change the others."""
    src = make_sources(
        orders=[order("o1"), order("o2", order_delivered_customer_date=None)],
        customers=[{"customer_id": "c-o1", "customer_unique_id": "u1"}],
        sellers=[{"seller_id": "s1"}],
        order_items=[item("o1"), item("o1", 2, seller_id="s2"), item("o2"), item("lost")],
        payments=[{"order_id": "o1", "payment_type": "boleto", "payment_value": 3.0}],
    )
    full = facts.fct_orders(src, settings).select(column)
    slim = facts.fct_orders(src, settings, columns=[column])
    assert slim.columns == [column]
    assert sorted(map(str, slim.collect())) == sorted(map(str, full.collect()))


def test_unknown_fact_column(make_sources, settings):
    with pytest.raises(ValueError, match="no_such"):
        facts.fct_orders(make_sources(), settings, columns=["no_such"])


def test_review_flags_with_nulls(make_sources, settings, order):
    src = make_sources(
        orders=[
            order("late", order_delivered_customer_date="2018-02-01 00:00:00"),
            order("pending", order_delivered_customer_date=None),
        ],
        reviews=[
            {"review_id": "r1", "order_id": "late", "review_score": 1},
            {"review_id": "r1", "order_id": "pending", "review_score": 1},
            {"review_id": "r2", "order_id": "late", "review_score": None},
            {"review_id": "r3", "order_id": "lost", "review_score": 2},
            {"review_id": "r4", "order_id": "late", "review_score": 3},
        ],
    )
    reviews = facts.fct_reviews(src, settings)
    assert reviews.columns == facts.FCT_REVIEWS_COLUMNS
    rows = {(r.review_id, r.order_id): r for r in reviews.collect()}
    flags = {
        k: (r.is_negative_review, r.is_late_delivery_negative_review) for k, r in rows.items()
    }
    assert flags == {
        ("r1", "late"): (True, True),
        ("r1", "pending"): (True, False),
        ("r2", "late"): (False, False),
        ("r3", "lost"): (True, False),
        ("r4", "late"): (False, False),
    }
    assert len({r.review_key for r in rows.values()}) == 5


def test_payment_figures_count_an_order_once(make_sources, settings, order, item):
    src = make_sources(
        orders=[order("o1")],
        order_items=[item("o1", 1), item("o1", 2)],
        payments=[
            {"order_id": "o1", "payment_type": "boleto", "payment_installments": 2, "payment_value": 10.0}
        ],
    )
    fact = facts.fct_orders(src, settings)
    assert kpis.payment_mix(fact).first().total_payment_value == Decimal("10.00")
    assert kpis.installment_rate(fact).first().payments == 1
    assert kpis.gmv(fact).first().gmv == Decimal("25.00")
    assert kpis.average_order_value(fact).first().aov == 25.0
    report = intermediate.fan_out_report(src).first()
    assert (report.joined_rows, report.naive_rows) == (2, 2)
    assert (report.payment_total, report.payment_total_over_items) == (10, 20)


def test_figures_of_nothing_are_null(make_sources, settings):
    fact = facts.fct_orders(make_sources(), settings)
    assert kpis.average_order_value(fact).first().aov is None
    assert kpis.on_time_rate(fact).first().on_time_rate is None
    assert kpis.repeat_customer_rate(fact).first().repeat_customer_rate is None


def test_settings_move_start_and_calendar(make_sources, settings, order, item):
    src = make_sources(orders=[order("o1")], order_items=[item("o1")])
    late = replace(settings, start_date=dt.datetime(2019, 1, 1))
    assert facts.fct_orders(src, late).count() == 0
    short = replace(settings, calendar_start=dt.date(2018, 1, 1), calendar_days=1)
    assert facts.fct_orders(src, short).first().order_date_key is not None
