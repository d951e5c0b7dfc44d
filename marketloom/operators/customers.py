"""Customer growth, repeat purchase, lifetime and cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketloom.functions.dates import month_index, month_of
from marketloom.functions.numeric import percent, ratio
from marketloom.operators.base import completed_orders
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def new_customers(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.customers.groupBy(month_of(F.col("signup_date")).alias("signup_month")).agg(
        F.count("*").alias("new_customers")
    )


def customer_months(shop: Shop) -> DataFrame:
    """Completed orders per customer and month: at most one row per month of a customer's life."""
    return completed_orders(shop).groupBy(
        "customer_id", month_of(F.col("order_date")).alias("order_month")
    ).agg(F.count("*").alias("orders"))


def new_and_returning(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    first = F.min("order_month").over(Window.partitionBy("customer_id"))
    tagged = customer_months(shop).filter("customer_id IS NOT NULL").withColumn(
        "customer_type", F.when(F.col("order_month") == first, "New").otherwise("Returning")
    )
    return tagged.groupBy("order_month", "customer_type").agg(
        F.count("*").alias("customers"), F.sum("orders").alias("orders")
    )


def orders_per_customer(shop: Shop) -> DataFrame:
    return completed_orders(shop).groupBy("customer_id").agg(
        F.count("*").alias("num_orders"),
        F.to_date(F.min("order_date")).alias("first_order"),
        F.to_date(F.max("order_date")).alias("last_order"),
    )


def repeat_purchase_rate(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    counted = orders_per_customer(shop).agg(
        F.count("*").alias("total_customers_with_orders"),
        F.count_if(F.col("num_orders") > 1).alias("repeat_customers"),
    )
    return counted.withColumn(
        "repeat_purchase_rate_pct", percent(F.col("repeat_customers"), F.col("total_customers_with_orders"))
    )


def purchase_frequency(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return orders_per_customer(shop).groupBy(F.col("num_orders").alias("orders_placed")).agg(
        F.count("*").alias("num_customers")
    )


def customer_lifetime(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return orders_per_customer(shop).filter("num_orders > 1").select(
        "customer_id", "first_order", "last_order",
        F.datediff("last_order", "first_order").alias("customer_lifetime_days"),
        F.col("num_orders").alias("total_orders"),
    )


def average_lifetime(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    total = F.sum("customer_lifetime_days")
    customers = F.count("customer_lifetime_days")
    return customer_lifetime(shop).agg(
        ratio(total, customers, 1).alias("avg_customer_lifetime_days"),
        ratio(total, customers * 30, 1).alias("avg_customer_lifetime_months"),
    )


def cohort_activity(shop: Shop) -> DataFrame:
    """One row per customer and active month, with cohort, channel and months since signup."""
    cohorts = shop.customers.select(
        "customer_id", "acquisition_channel", month_of(F.col("signup_date")).alias("cohort_month")
    )
    since = month_index(F.col("order_month")) - month_index(F.col("cohort_month"))
    return customer_months(shop).join(cohorts, "customer_id").withColumn("month_number", since)


def cohort_retention(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    sizes = shop.customers.groupBy(month_of(F.col("signup_date")).alias("cohort_month")).agg(
        F.count("customer_id").alias("cohort_size")
    )
    active = cohort_activity(shop).filter("month_number >= 0").groupBy("cohort_month", "month_number").agg(
        F.count("*").alias("active_customers")
    )
    return active.join(sizes, "cohort_month").select(
        "cohort_month", "cohort_size", "month_number", "active_customers",
        percent(F.col("active_customers"), F.col("cohort_size")).alias("retention_pct"),
    )


def channel_retention(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    month = params.retention_month
    sizes = shop.customers.groupBy("acquisition_channel").agg(F.count("customer_id").alias("total_customers"))
    active = cohort_activity(shop).groupBy("acquisition_channel").agg(
        F.count_if(F.col("month_number") == month).alias(f"active_month_{month}")
    )
    return sizes.join(active, "acquisition_channel").select(
        "acquisition_channel", "total_customers", f"active_month_{month}",
        percent(F.col(f"active_month_{month}"), F.col("total_customers")).alias(f"retention_month{month}_pct"),
    )
