"""Schemas of the nine cleaned tables and, as strings, of their raw files."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
FRACTION = T.DecimalType(6, 4)
# Payments add up the lines of an order, so they get more digits than one line.
AMOUNT = T.DecimalType(18, 2)

_S, _D, _TS, _I, _B = T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType(), T.BooleanType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


CLEAN: dict[str, T.StructType] = {
    "customers": _struct(
        customer_id=_S, customer_name=_S, signup_date=_D, country=_S, city=_S, device=_S,
        acquisition_channel=_S, customer_segment=_S,
    ),
    "products": _struct(
        product_id=_S, product_name=_S, category=_S, subcategory=_S, brand=_S, cost=MONEY,
        selling_price=MONEY, cost_is_estimated=_B, price_is_invalid=_B,
    ),
    "orders": _struct(
        order_id=_S, customer_id=_S, order_date=_TS, order_status=_S, payment_method=_S,
        discount=FRACTION, shipping_cost=MONEY,
    ),
    "order_items": _struct(
        order_item_id=_S, order_id=_S, product_id=_S, quantity=_I, unit_price=MONEY, line_total=MONEY,
    ),
    "payments": _struct(payment_id=_S, order_id=_S, amount=AMOUNT, payment_status=_S, payment_date=_TS),
    "returns": _struct(
        return_id=_S, order_id=_S, customer_id=_S, product_id=_S, return_date=_D, return_reason=_S,
        refund_amount=MONEY,
    ),
    "marketing_campaigns": _struct(
        date=_D, channel=_S, campaign=_S, spend=MONEY, impressions=_I, clicks=_I, conversions=_I,
    ),
    "web_events": _struct(
        event_id=_S, customer_id=_S, event_timestamp=_TS, event_name=_S, session_id=_S, product_id=_S,
    ),
    "experiments": _struct(
        experiment_id=_S, customer_id=_S, variant=_S, experiment_date=_D, converted=_I, revenue=MONEY,
    ),
}

TABLES = tuple(CLEAN)

# Columns that cleaning adds and raw files therefore lack.
DERIVED = {"products": {"cost_is_estimated", "price_is_invalid"}, "order_items": {"line_total"}}


def raw_schema(table: str) -> T.StructType:
    """The raw file of ``table``: its columns as text, without those that cleaning derives."""
    added = DERIVED.get(table, set())
    return T.StructType([T.StructField(f.name, _S, True) for f in CLEAN[table] if f.name not in added])
