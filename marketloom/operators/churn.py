"""Repurchase interval and churn status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.functions.dates import epoch_micros
from marketloom.functions.numeric import percent
from marketloom.operators.base import analysis_day, completed_orders, customer_facts
from marketloom.operators.ranking import percentiles, written
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

DAY = 86_400_000_000  # microseconds


def order_gaps(shop: Shop) -> DataFrame:
    """How often each gap (microseconds) occurs between consecutive orders of one customer.

    One customer may hold a large share of all orders, so no window spans a customer's orders: they are
    compared within a day, and the first of a day with the last of the customer's day before it. The second
    comparison has one row per customer and day.
    """
    stamps = completed_orders(shop).groupBy("customer_id", epoch_micros(F.col("order_date")).alias("at")).agg(
        F.count("*").alias("n")
    ).withColumn("day", F.floor(F.col("at") / DAY))
    same_day = Window.partitionBy("customer_id", "day").orderBy("at")
    within = stamps.select(
        (F.col("at") - F.lag("at").over(same_day)).alias("gap"), F.lit(1).cast("bigint").alias("n")
    ).filter("gap IS NOT NULL")
    repeated = stamps.filter("n > 1").select(F.lit(0).cast("bigint").alias("gap"), (F.col("n") - 1).alias("n"))
    days = stamps.groupBy("customer_id", "day").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    by_day = Window.partitionBy("customer_id").orderBy("day")
    between = days.select(
        (F.col("first") - F.lag("last").over(by_day)).alias("gap"), F.lit(1).cast("bigint").alias("n")
    ).filter("gap IS NOT NULL")
    return within.unionByName(repeated).unionByName(between).groupBy("gap").agg(F.sum("n").alias("n"))


def repurchase_interval(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    gaps = written(order_gaps(shop), "gaps")
    median = percentiles(gaps, {"gap": {"median": 0.5}}, "n")["gap"]["median"]
    mean = (F.sum(F.col("gap").cast("decimal(20,0)") * F.col("n")) / F.sum("n")).cast("decimal(28,6)")
    days = F.lit(DAY).cast("decimal(18,0)")
    # Without any gap there is no row of medians.
    return gaps.agg(mean.alias("mean")).where("mean IS NOT NULL").select(
        F.round(F.lit(median).cast("double").cast("decimal(28,6)") / days, 1).cast("double").alias("median_repurchase_days"),
        F.round(F.col("mean") / days, 1).cast("double").alias("avg_repurchase_days"),
    )


def _is_churned(days: Column, params: Params) -> Column:
    return days > params.churn_days


def last_activity(shop: Shop, params: Params) -> DataFrame:
    activity = completed_orders(shop).groupBy("customer_id").agg(
        F.to_date(F.max("order_date")).alias("last_order_date"), F.count("*").alias("total_orders")
    )
    return activity.withColumn(
        "days_since_last_order", F.datediff(analysis_day(shop, params), F.col("last_order_date"))
    )


def churn_status(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    churned = _is_churned(F.col("days_since_last_order"), params)
    return last_activity(shop, params).withColumn(
        "churn_status", F.when(churned, "Churned").otherwise("Active")
    )


def _rate(*group: str):
    def summarise(df: DataFrame) -> DataFrame:
        return df.groupBy(*group).agg(
            F.count("*").alias("total_customers"),
            F.count_if(F.col("churn_status") == "Churned").alias("churned_customers"),
            percent(F.count_if(F.col("churn_status") == "Churned"), F.count("*")).alias("churn_rate_pct"),
        )

    return summarise


def churn_rate(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return churn_status(shop, params).transform(_rate())


def churn_rate_by_segment(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    segments = shop.customers.select("customer_id", "customer_segment")
    return churn_status(shop, params).join(segments, "customer_id").transform(_rate("customer_segment"))


def valuable_churned(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """The churned customers with the highest spend, customer_id as tie-break."""
    days = F.datediff(analysis_day(shop, params), F.col("last_order"))
    return (
        customer_facts(shop)
        .select(
            "customer_id", "total_spend", "total_orders", F.col("last_order").alias("last_order_date"),
            days.alias("days_since_last_order"),
        )
        .filter(_is_churned(F.col("days_since_last_order"), params))
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(params.churned_limit)
    )
