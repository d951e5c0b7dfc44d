"""Acquisition cost, lifetime value and channel performance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketloom.functions.numeric import percent, ratio
from marketloom.operators.base import customer_facts
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def channel_customers(shop: Shop) -> DataFrame:
    return shop.customers.groupBy(F.col("acquisition_channel").alias("channel")).agg(
        F.count("*").alias("new_customers")
    )


def channel_totals(shop: Shop) -> DataFrame:
    return shop.shared("channel-totals", lambda: shop.marketing_campaigns.groupBy("channel").agg(
        F.sum("spend").alias("total_spend"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("conversions").alias("total_conversions"),
    ))


def acquisition_cost(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    spend = channel_totals(shop).select("channel", "total_spend")
    return spend.join(channel_customers(shop), "channel").withColumn(
        "cac", ratio(F.col("total_spend"), F.col("new_customers"), 2)
    )


def lifetime_value(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return customer_facts(shop).select(
        "customer_id",
        F.col("total_spend").alias("clv"),
        "total_orders", "first_order", "last_order",
        ratio(F.col("total_spend"), F.col("total_orders"), 2).alias("avg_order_value"),
    )


def channel_sales(shop: Shop) -> DataFrame:
    """Revenue and buyers per channel; orders are added up per customer before the customers are joined."""
    channels = shop.customers.select("customer_id", F.col("acquisition_channel").alias("channel"))
    return shop.shared("channel-sales", lambda: customer_facts(shop).join(channels, "customer_id").groupBy("channel").agg(
        F.sum("total_spend").alias("attributed_revenue"), F.count("*").alias("buyers")
    ))


def value_to_cost(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    revenue, buyers = F.col("attributed_revenue"), F.col("buyers")
    cost = acquisition_cost(shop).select("channel", "cac")
    return channel_sales(shop).join(cost, "channel").select(
        "channel",
        ratio(revenue, buyers, 2).alias("avg_clv"),
        "cac",
        # revenue / buyers / cac, with the one division at the end
        ratio(revenue, buyers * F.round("cac", 2).cast("decimal(18,2)"), 2, money=True).alias("clv_to_cac_ratio"),
    )


def channel_performance(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    spend, clicks = F.col("total_spend"), F.col("total_clicks")
    return channel_totals(shop).join(channel_sales(shop), "channel", "left").select(
        "channel", "total_spend", "total_impressions", "total_clicks", "total_conversions",
        percent(clicks, F.col("total_impressions"), 3).alias("ctr_pct"),
        ratio(spend, clicks, 2).alias("cpc"),
        percent(F.col("total_conversions"), clicks).alias("conversion_rate_pct"),
        "attributed_revenue",
        ratio(F.col("attributed_revenue"), spend, 2, money=True).alias("roas"),
    )
