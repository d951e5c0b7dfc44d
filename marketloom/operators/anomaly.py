"""Unusual days by rolling z-score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.functions.dates import fill_days
from marketloom.operators.base import completed_orders, order_facts
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def rolling_z(daily: DataFrame, day: str, value: str, params: Params = DEFAULTS) -> DataFrame:
    """z of each row against the trailing window that includes it, sample deviation, and the flag.

    One row per day, so the unpartitioned window is as long as the calendar, whatever the data's size.
    """
    window = Window.orderBy(day).rowsBetween(1 - params.anomaly_window, 0)
    number = F.col(value).cast("double")
    enough = F.count(value).over(window) >= params.anomaly_min_rows
    deviation = F.when(enough, F.stddev_samp(number).over(window))
    z = (number - F.avg(number).over(window)) / F.when(deviation > 0, deviation)
    return daily.withColumn("z_score", z).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > params.anomaly_limit, F.lit(False))
    )


def daily_net(shop: Shop) -> DataFrame:
    daily = order_facts(shop).groupBy("order_day").agg(F.sum("net").cast("decimal(28,6)").alias("revenue"))
    return fill_days(daily, "order_day", "revenue")


def daily_orders(shop: Shop) -> DataFrame:
    daily = completed_orders(shop).groupBy(F.to_date("order_date").alias("order_day")).agg(
        F.count("*").alias("order_count")
    )
    return fill_days(daily, "order_day", "order_count")


def daily_spend(shop: Shop) -> DataFrame:
    return fill_days(
        shop.marketing_campaigns.groupBy("date").agg(F.sum("spend").alias("spend")), "date", "spend"
    )


def daily_refunds(shop: Shop) -> DataFrame:
    return fill_days(
        shop.returns.groupBy("return_date").agg(F.sum("refund_amount").alias("refund_amount")),
        "return_date", "refund_amount",
    )


def revenue_z(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return rolling_z(daily_net(shop), "order_day", "revenue", params)


def orders_z(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return rolling_z(daily_orders(shop), "order_day", "order_count", params)


def spend_z(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return rolling_z(daily_spend(shop), "date", "spend", params)


def refunds_z(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return rolling_z(daily_refunds(shop), "return_date", "refund_amount", params)


SERIES = {"revenue": revenue_z, "order_volume": orders_z, "marketing_spend": spend_z, "refunds": refunds_z}


def flagged(scored: DataFrame) -> DataFrame:
    return scored.filter("is_anomaly")


def drop_cause(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """The flagged revenue day with the lowest z and what that day's order volume suggests."""
    worst = flagged(revenue_z(shop, params)).orderBy("z_score", "order_day").limit(1)
    orders = orders_z(shop, params).select(
        "order_day", F.col("z_score").alias("orders_z_score"), F.col("is_anomaly").alias("orders_anomaly")
    )
    fewer: Column = F.col("orders_anomaly") & (F.col("orders_z_score") < 0)
    return worst.join(orders, "order_day", "left").select(
        "order_day", "revenue", "z_score", "orders_z_score",
        F.when(F.col("orders_anomaly").isNull(), F.lit(None).cast("string"))
        .when(fewer, "traffic or conversion").otherwise("order value, discounts or product mix").alias("hint"),
    )


def flag_counts(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Flagged days per series, 0 included."""
    result = None
    for name, series in SERIES.items():
        counted = series(shop, params).agg(F.count_if("is_anomaly").alias("anomaly_days")).select(
            F.lit(name).alias("metric"), "anomaly_days"
        )
        result = counted if result is None else result.unionByName(counted)
    return result
