"""Amounts are summed as they are and rounded once."""

from __future__ import annotations

from decimal import Decimal

import pytest

from mercato.plans import dimensions, facts, intermediate, kpis
from mercato.sources.schemas import EXCHANGE_RATES


@pytest.fixture
def small_amounts(make_sources, order, item):
    """One order with 1000 payments and 1000 items of 0.004 each."""
    payment = {"order_id": "o1", "payment_type": "voucher", "payment_installments": 1, "payment_value": 0.004}
    return make_sources(
        orders=[order("o1")],
        order_items=[item("o1", i, price=0.004, freight_value=0.0) for i in range(1000)],
        payments=[{**payment, "payment_sequential": i} for i in range(1000)],
        products=[{"product_id": "p1", "product_category_name": "toys"}],
    )


def test_payments(small_amounts, settings):
    row = intermediate.order_payments_summary(small_amounts).first()
    assert (row.total_payment_value, row.voucher_value, row.boleto_value) == (Decimal(4), Decimal(4), 0)
    fact = facts.fct_orders(small_amounts, settings)
    assert {r.total_payment_value for r in fact.collect()} == {Decimal(4)}
    assert kpis.payment_mix(fact).first().voucher_value == Decimal(4)


def test_figures(small_amounts, settings):
    fact = facts.fct_orders(small_amounts, settings).cache()
    assert kpis.gmv(fact).first().gmv == Decimal(4)
    assert kpis.average_order_value(fact).first().aov == 4.0
    top = kpis.top_categories(fact, dimensions.dim_products(small_amounts, settings)).first()
    assert (top.product_category_name_english, top.revenue) == ("toys", Decimal(4))


@pytest.mark.parametrize("rate, usd", [(0.0000615, "0.000246"), (25000.5, "100002")])
def test_any_rate(spark, small_amounts, settings, rate, usd):
    rates = spark.createDataFrame([("BRL", "x", rate, None)], EXCHANGE_RATES)
    fact = facts.fct_orders(small_amounts, settings, columns=kpis.GMV_COLUMNS)
    assert kpis.gmv_usd(fact, rates, settings).first().gmv_usd == Decimal(usd)


def test_fixed_values():
    """The oracle texts share these with the code, so they are pinned here."""
    from mercato.functions.scalars import NULL_KEY_PART
    from mercato.plans.checks import CHECKS, ORDER_STATUSES, PAYMENT_TYPES, REVIEW_SCORES
    from mercato.sources.seeds import RATES

    assert [(c, n, r, str(d)) for c, n, r, d in RATES] == [
        ("BRL", "Brazilian Real", 0.20, "2018-01-01"),
        ("INR", "Indian Rupee", 0.014, "2018-01-01"),
        ("USD", "US Dollar", 1.00, "2018-01-01"),
        ("EUR", "Euro", 1.18, "2018-01-01"),
    ]
    assert NULL_KEY_PART == "_dbt_utils_surrogate_key_null_"
    assert ORDER_STATUSES == (
        "delivered", "shipped", "canceled", "invoiced", "processing", "unavailable", "approved", "created",
    )
    assert PAYMENT_TYPES == ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
    assert REVIEW_SCORES == (1, 2, 3, 4, 5)
    assert {(c.model, c.column, c.to, c.field) for c in CHECKS if c.kind == "relationships"} >= {
        ("stg_order_items", "order_id", "stg_orders", "order_id"),
        ("stg_payments", "order_id", "stg_orders", "order_id"),
    }
