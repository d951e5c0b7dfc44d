"""Dashboard measures (M1–M7), as (item, label, value) rows where several measures share a board."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.functions.dates import month_of
from marketloom.functions.numeric import percent, ratio
from marketloom.operators.base import customer_facts
from marketloom.operators.churn import churn_status
from marketloom.operators.customers import cohort_retention, new_customers, orders_per_customer
from marketloom.operators.funnel import device_conversion, step_conversion
from marketloom.operators.marketing import acquisition_cost, channel_performance, channel_sales
from marketloom.operators.products import category_summary, product_pairs, product_performance, return_reasons
from marketloom.operators.ranking import written
from marketloom.operators.report import headline_figures
from marketloom.operators.sales import monthly_revenue
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def month_changes(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Every month of sales against the month before it in the series: revenue, orders, acquisition cost."""
    spend = shop.marketing_campaigns.groupBy(month_of(F.col("date")).alias("order_month")).agg(
        F.sum("spend").alias("spend")
    )
    signups = new_customers(shop).withColumnRenamed("signup_month", "order_month")
    months = (
        monthly_revenue(shop).select("order_month", "net_revenue", "total_orders")
        .join(spend, "order_month", "left").join(signups, "order_month", "left")
        .withColumn("cac", ratio(F.col("spend"), F.col("new_customers"), 2))
    )

    def change(name: str) -> Column:
        before = F.lag(name).over(Window.orderBy("order_month"))
        return percent(F.col(name).cast("decimal(28,6)") - before.cast("decimal(28,6)"), before, money=True)

    return months.select(
        "order_month", "net_revenue", change("net_revenue").alias("revenue_change_pct"),
        "total_orders", change("total_orders").alias("orders_change_pct"),
        "cac", change("cac").alias("cac_change_pct"),
    )


def latest_month(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    changes = month_changes(shop, params)
    return changes.orderBy(F.desc("order_month")).limit(1)


def category_returns(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return product_performance(shop, params).groupBy("category").agg(
        F.sum("revenue").alias("revenue"),
        percent(F.sum("return_count"), F.sum("units_sold")).alias("return_rate_pct"),
    )


def overall_margin(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return product_performance(shop, params).agg(
        percent(F.sum("gross_margin"), F.sum("revenue"), money=True).alias("gross_margin_pct")
    )


def _rows(df: DataFrame, label: Column | str, measures: dict[str, str], digits: int = 2) -> DataFrame:
    """One (item, label, value) row per row of ``df`` and measure; ``measures`` maps item to column."""
    text = (F.col(label) if isinstance(label, str) else label).cast("string")
    return df.select(F.inline(F.array(*[
        F.struct(
            F.lit(item).alias("item"), text.alias("label"),
            F.round(F.col(column).cast("decimal(28,6)"), digits).cast("double").alias("value"),
        )
        for item, column in measures.items()
    ])))


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def executive_board(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Five of the measures start from the items; these are read and added up once."""
    shop = shop.keeping(written)
    figures = headline_figures(shop, params)
    sales = channel_sales(shop)
    value = sales.agg(F.sum("attributed_revenue").alias("revenue"), F.sum("buyers").alias("buyers"))
    cac = figures.select(F.col("overall_cac").cast("decimal(18,2)")).scalar()
    clv_to_cac = value.select(ratio(F.col("revenue"), F.col("buyers") * cac, 2, money=True).alias("clv_to_cac"))
    everyone = F.lit("all")
    return _stack([
        _rows(figures, everyone,
              _same("total_revenue", "total_orders", "total_customers", "aov", "overall_cac")),
        _rows(overall_margin(shop, params), everyone, _same("gross_margin_pct")),
        _rows(clv_to_cac, everyone, _same("clv_to_cac")),
        _rows(new_customers(shop), "signup_month", _same("new_customers")),
        _rows(month_changes(shop, params), "order_month", {"revenue_growth_pct": "revenue_change_pct"}),
        _rows(sales, "channel", {"revenue_by_channel": "attributed_revenue"}),
        _rows(category_summary(shop), "category", {"revenue_by_category": "revenue"}),
    ])


def customer_board(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Revenue and buyers by place and customer segment, repeat buyers, churn status, first-month retention."""
    places = shop.customers.select("customer_id", "country", "city", "customer_segment")
    buyers = customer_facts(shop).join(places, "customer_id")
    by_segment = buyers.groupBy("customer_segment").agg(F.sum("total_spend").alias("revenue"))
    by_place = buyers.groupBy("country", "city").agg(
        F.sum("total_spend").alias("revenue"), F.count("*").alias("buyers")
    )
    repeat = orders_per_customer(shop).agg(F.count_if(F.col("num_orders") > 1).alias("repeat_customers"))
    churned = churn_status(shop, params).groupBy("churn_status").agg(F.count("*").alias("customers"))
    retained = cohort_retention(shop, params).filter("month_number = 1")
    return _stack([
        _rows(by_segment, "customer_segment", {"revenue_by_segment": "revenue"}),
        _rows(by_place, F.concat_ws(" / ", "country", "city"),
              {"revenue_by_place": "revenue", "buyers_by_place": "buyers"}),
        _rows(repeat, F.lit("all"), _same("repeat_customers")),
        _rows(churned, "churn_status", {"customers_by_churn_status": "customers"}),
        _rows(retained, "cohort_month", {"month_1_retention_pct": "retention_pct"}),
    ])


def growth_board(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return _stack([
        _rows(channel_performance(shop, params), "channel",
              _same("total_spend", "attributed_revenue", "ctr_pct", "conversion_rate_pct", "roas"), 3),
        _rows(acquisition_cost(shop, params), "channel", _same("cac")),
        _rows(device_conversion(shop, params), "device", {"device_conversion_pct": "conversion_pct"}),
        _rows(step_conversion(shop, params), F.lit("all"), _same("overall_conversion_pct")),
    ])


def product_board(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    shop = shop.keeping(written, "product-totals")
    pair = F.concat_ws(" + ", "product_a_name", "product_b_name")
    return _stack([
        _rows(product_performance(shop, params), "product_id",
              _same("revenue", "gross_margin", "margin_pct", "units_sold", "return_rate_pct")),
        _rows(category_summary(shop), "category", {"revenue_by_category": "revenue"}),
        _rows(return_reasons(shop), "return_reason", {"returns_by_reason": "num_returns"}),
        _rows(product_pairs(shop, params), pair, {"bought_together": "times_bought_together"}),
    ])
