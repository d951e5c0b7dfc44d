"""Measures of the business report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketloom.functions.numeric import mean_of, percent, ratio
from marketloom.operators.anomaly import flagged, revenue_z
from marketloom.operators.base import completed_orders, order_facts, with_row
from marketloom.operators.forecast import forecast_totals
from marketloom.operators.rfm import edge_segment_summary
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

TOP_SEGMENTS = ("Champions", "Loyal Customers")


def headline_figures(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    sales = order_facts(shop).agg(F.sum("net").alias("revenue"), mean_of(F.col("net"), 2).alias("aov"))
    orders = completed_orders(shop).agg(F.count("*")).scalar()
    customers = shop.customers.agg(F.count("*")).scalar()
    spend = shop.marketing_campaigns.agg(F.sum("spend")).scalar()
    refunds = shop.returns.agg(F.sum("refund_amount")).scalar()
    return sales.select(
        F.round("revenue", 2).alias("total_revenue"),
        orders.alias("total_orders"),
        "aov",
        customers.alias("total_customers"),
        spend.alias("total_spend"),
        refunds.alias("total_refunds"),
        ratio(spend, customers, 2).alias("overall_cac"),
    )


def outlook(features: DataFrame, priority: DataFrame, future: DataFrame) -> DataFrame:
    """Churned share, spend of the priority list, forecast totals."""
    churned = features.agg(percent(F.sum("churned"), F.count("*")).alias("churn_rate_pct"))
    at_risk = priority.agg(F.coalesce(F.round(F.sum("total_spend"), 2), F.lit(0).cast("decimal(28,2)"))).scalar()
    totals = forecast_totals(future)
    return with_row(churned.withColumn("high_risk_value", at_risk), totals, "t").select(
        "churn_rate_pct", "high_risk_value", *[f"t.{c}" for c in totals.columns]
    )


def unfinished_share(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.orders.agg(
        percent(F.count_if(F.col("order_status").isin("Cancelled", "Pending")), F.count("*"), 1)
        .alias("cancelled_or_pending_pct")
    )


def segment_shares(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Revenue share per segment; at most nine rows, so the total is a window over them."""
    total = F.sum("total_monetary").over(Window.partitionBy())
    return edge_segment_summary(shop, params).select(
        "rfm_segment", "num_customers", "total_monetary",
        percent(F.col("total_monetary"), total, 1, money=True).alias("revenue_pct"), "avg_recency_days",
    )


def top_segment_shares(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    top = F.col("rfm_segment").isin(*TOP_SEGMENTS)
    people, money = F.col("num_customers"), F.col("total_monetary")
    return edge_segment_summary(shop, params).agg(
        percent(F.sum(F.when(top, people).otherwise(0)), F.sum(people), 1).alias("customers_pct"),
        percent(F.sum(F.when(top, money).otherwise(0)), F.sum(money), 1, money=True).alias("revenue_pct"),
    )


def worst_day(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    worst = F.min_by(F.struct("order_day", "revenue", "z_score"), F.struct("z_score", "order_day"))
    return flagged(revenue_z(shop, params)).agg(worst.alias("w")).filter("w IS NOT NULL").select("w.*")
