"""Frames that many analyses share: order facts, sold items, the analysis day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions.dates import month_of
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

# Fixed values.
COMPLETED = "Completed"
UNKNOWN_SESSION = "UNKNOWN_SESSION"


def completed_orders(shop: Shop) -> DataFrame:
    return shop.orders.filter(F.col("order_status") == COMPLETED)


def order_facts(shop: Shop) -> DataFrame:
    return shop.shared("order-facts", lambda: _order_facts(shop))


def _order_facts(shop: Shop) -> DataFrame:
    """One row per completed order that has items.

    Items are added up per order before the join: an order with very many lines shrinks to one row on the map
    side, the join reuses that partitioning, and no later count of orders needs a distinct. The discount is
    one figure per order, hence ``sum(line) * (1 - discount)`` equals the sum over discounted lines exactly.
    """
    priced = F.col("unit_price") > 0
    items = shop.order_items.groupBy("order_id").agg(
        F.sum("line_total").alias("gross"),
        F.sum("quantity").alias("units"),
        F.sum(F.when(priced, F.col("line_total"))).alias("priced_gross"),
        F.count_if(priced).alias("priced_lines"),
    )
    kept = 1 - F.coalesce("discount", F.lit(0).cast("decimal(6,4)"))
    return completed_orders(shop).join(items, "order_id").select(
        "order_id", "customer_id", "order_date", "shipping_cost", "gross", "units", "priced_lines",
        F.to_date("order_date").alias("order_day"),
        month_of(F.col("order_date")).alias("order_month"),
        (F.col("gross") * kept).cast("decimal(28,6)").alias("net"),
        (F.col("priced_gross") * kept).cast("decimal(28,6)").alias("priced_net"),
    )


def customer_facts(shop: Shop) -> DataFrame:
    return shop.shared("customer-facts", lambda: _customer_facts(shop))


def _customer_facts(shop: Shop) -> DataFrame:
    """One row per customer with completed items; the net total, orders and dates."""
    return order_facts(shop).groupBy("customer_id").agg(
        F.sum("net").cast("decimal(28,6)").alias("total_spend"),
        F.count("*").alias("total_orders"),
        F.min("order_day").alias("first_order"),
        F.max("order_day").alias("last_order"),
        F.max("order_date").alias("last_stamp"),
    )


def sold_items(shop: Shop) -> DataFrame:
    """Items of completed orders; products and quantities only, prices before discount."""
    keys = completed_orders(shop).select("order_id")
    return shop.order_items.join(keys, "order_id", "left_semi")


def product_totals(shop: Shop) -> DataFrame:
    return shop.shared("product-totals", lambda: _product_totals(shop))


def _product_totals(shop: Shop) -> DataFrame:
    """Sales per product before any product column is joined, so the big side shuffles once, aggregated."""
    return sold_items(shop).groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("line_total").alias("revenue"),
        F.sum("unit_price").alias("unit_price_sum"),
        F.count("unit_price").alias("priced_count"),
    )


def last_completed_day(shop: Shop) -> Column:
    """Newest completed order day, as a scalar subquery that Spark runs once."""
    newest = F.max(F.to_date("order_date")).alias("last_day")
    return shop.shared("last-day", lambda: completed_orders(shop).agg(newest)).scalar()


def analysis_day(shop: Shop, params: Params = DEFAULTS) -> Column:
    return F.lit(params.analysis_date) if params.analysis_date else last_completed_day(shop)


def reference_day(shop: Shop, params: Params = DEFAULTS) -> Column:
    return F.lit(params.reference_date) if params.reference_date else last_completed_day(shop)


def with_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """``df`` with the single row of ``one_row`` as a struct column; a scalar subquery, not a cross join."""
    return df.withColumn(name, one_row.select(F.struct("*")).scalar())
