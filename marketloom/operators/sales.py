"""Revenue over time, order value and category volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.functions.numeric import mean_of, percent
from marketloom.operators.base import order_facts, product_totals
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def daily_revenue(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return order_facts(shop).groupBy("order_day").agg(
        F.count("*").alias("total_orders"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("net").alias("net_revenue_after_discount"),
        F.sum("units").alias("units_sold"),
    )


def monthly_revenue(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """First per month and customer, then per month: distinct customers without a distinct aggregate."""
    per_customer = order_facts(shop).groupBy("order_month", "customer_id").agg(
        F.count("*").alias("orders"),
        F.sum("gross").alias("gross"),
        F.sum("net").alias("net"),
        F.sum("units").alias("units"),
    )
    return per_customer.groupBy("order_month").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("net").alias("net_revenue"),
        F.sum("units").alias("units_sold"),
    )


def monthly_net(shop: Shop) -> DataFrame:
    return order_facts(shop).groupBy("order_month").agg(F.sum("net").alias("net_revenue"))


def _against_earlier(shop: Shop, rows_back: int, earlier: str, growth: str) -> DataFrame:
    """Growth against the row ``rows_back`` months of the series before; one row per month, so one task."""
    before: Column = F.lag("net_revenue", rows_back).over(Window.orderBy("order_month"))
    return monthly_net(shop).withColumn(earlier, before).withColumn(
        growth, percent(F.col("net_revenue") - F.col(earlier), F.col(earlier), money=True)
    )


def month_over_month(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return _against_earlier(shop, 1, "prev_month_revenue", "mom_growth_pct")


def year_over_year(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Twelve rows back, not twelve calendar months: a month without sales shifts the comparison."""
    return _against_earlier(shop, 12, "same_month_last_year", "yoy_growth_pct")


def average_order_value(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return order_facts(shop).filter("priced_lines > 0").groupBy("order_month").agg(
        F.count("*").alias("total_orders"),
        mean_of(F.col("priced_net"), 2).alias("aov"),
        F.round(F.sum("priced_net"), 2).alias("total_revenue"),
    )


def units_by_category(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    units = F.col("units_sold")
    per_category = (
        product_totals(shop).join(shop.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("units_sold").alias("units_sold"), F.sum("revenue").alias("revenue"))
    )
    return per_category.withColumn(
        "volume_tier",
        F.when(units >= params.volume_high, "High Volume")
        .when(units >= params.volume_medium, "Medium Volume")
        .otherwise("Low Volume"),
    )
