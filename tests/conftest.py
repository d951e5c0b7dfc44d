import datetime as dt
from decimal import Decimal

import pytest

from marketloom import Shop
from marketloom.schemas import CLEAN
from tests.sessions import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session()


def _typed(kind: str, value):
    if value is None:
        return None
    if kind.startswith("decimal"):
        return Decimal(str(value))
    if kind == "date" and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if kind == "timestamp_ntz" and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value


@pytest.fixture(scope="session")
def make_shop(spark):
    """``make_shop(orders=[{...}], …)``: columns left out are null, tables left out are empty."""

    def make(**tables):
        def frame(name):
            schema = CLEAN[name]
            rows = [
                tuple(_typed(f.dataType.simpleString(), row.get(f.name)) for f in schema)
                for row in tables.get(name, [])
            ]
            return spark.createDataFrame(rows, schema)

        return Shop(spark, frame)

    return make


@pytest.fixture(scope="session")
def orders_of():
    """Completed one-item orders from (order_id, customer_id, timestamp, line_total[, discount])."""

    def build(*rows):
        orders, items = [], []
        for order_id, customer, stamp, total, *discount in rows:
            orders.append({
                "order_id": order_id, "customer_id": customer, "order_date": stamp, "order_status": "Completed",
                "discount": discount[0] if discount else 0, "shipping_cost": 0,
            })
            items.append({
                "order_item_id": order_id, "order_id": order_id, "product_id": "P1", "quantity": 1,
                "unit_price": total, "line_total": total,
            })
        return {"orders": orders, "order_items": items}

    return build
