from __future__ import annotations

import datetime as dt

import pytest

from mercato import Settings, Sources
from mercato.session import local_session
from mercato.sources.schemas import RAW_TABLES


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def settings():
    return Settings()


def at(text: str | None) -> dt.datetime | None:
    return None if text is None else dt.datetime.fromisoformat(text)


@pytest.fixture
def make_sources(spark):
    """Sources from rows given as dicts; unnamed columns are NULL, unnamed tables empty."""

    def make(**tables: list[dict]) -> Sources:
        def load(name: str):
            schema = RAW_TABLES[name]
            rows = [
                tuple(
                    at(row[f.name])
                    if f.dataType.typeName() == "timestamp_ntz" and isinstance(row.get(f.name), str)
                    else row.get(f.name)
                    for f in schema.fields
                )
                for row in tables.get(name, [])
            ]
            return spark.createDataFrame(rows, schema)

        return Sources(load)

    return make


@pytest.fixture
def order():
    """A raw order with sensible values."""

    def make(order_id: str, **values) -> dict:
        return {
            "order_id": order_id,
            "customer_id": f"c-{order_id}",
            "order_status": "delivered",
            "order_purchase_timestamp": "2018-01-01 10:00:00",
            "order_approved_at": "2018-01-01 11:00:00",
            "order_delivered_carrier_date": "2018-01-02 10:00:00",
            "order_delivered_customer_date": "2018-01-05 10:00:00",
            "order_estimated_delivery_date": "2018-01-10 00:00:00",
            **values,
        }

    return make


@pytest.fixture
def item():
    def make(order_id: str, order_item_id: int = 1, **values) -> dict:
        return {
            "order_id": order_id,
            "order_item_id": order_item_id,
            "product_id": "p1",
            "seller_id": "s1",
            "shipping_limit_date": "2018-01-03 00:00:00",
            "price": 10.0,
            "freight_value": 2.5,
            **values,
        }

    return make
