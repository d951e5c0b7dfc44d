"""First look at the data: mixes, order values, shares (EX1–EX9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marketloom.functions.numeric import mean_of, percent
from marketloom.operators.base import completed_orders, customer_facts, order_facts, product_totals, with_row
from marketloom.operators.ranking import percentiles, written
from marketloom.operators.sales import monthly_net
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def item_facts(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Items of completed orders with order day, customer and discounted value."""
    orders = completed_orders(shop).select("order_id", "customer_id", "order_date", "discount")
    kept = 1 - F.coalesce("discount", F.lit(0).cast("decimal(6,4)"))
    return shop.order_items.join(orders, "order_id").select(
        "order_item_id", "order_id", "customer_id", "product_id", F.to_date("order_date").alias("order_day"),
        "quantity", "line_total", (F.col("line_total") * kept).cast("decimal(18,6)").alias("net_value"),
    )


def monthly_series(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return monthly_net(shop)


def status_mix(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Orders without status count in the total only; one row per status, so the total is a window over them."""
    total = F.sum("orders").over(Window.partitionBy())
    counts = shop.orders.groupBy("order_status").agg(F.count("*").alias("orders"))
    return counts.withColumn("pct_of_total", percent(F.col("orders"), total, 1)).filter("order_status IS NOT NULL")


def channel_mix(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.customers.filter("acquisition_channel IS NOT NULL").groupBy("acquisition_channel").agg(
        F.count("*").alias("customers")
    )


def order_values(shop: Shop) -> DataFrame:
    return order_facts(shop).select("order_id", F.col("net").alias("order_value"))


def order_value_statistics(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    values = written(order_values(shop), "order-values")
    median = percentiles(values, {"order_value": {"median": 0.5}})["order_value"]["median"]
    return values.agg(mean_of(F.col("order_value"), 2).alias("mean_order_value")).withColumn(
        "median_order_value", F.round(F.lit(median).cast("decimal(28,6)"), 2)
    )


def order_value_histogram(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Equal bins from the least to the greatest value below the quantile; the last bin is closed."""
    bins = params.histogram_bins
    values = written(order_values(shop).select(F.col("order_value").cast("double").alias("v")), "order-values")
    cut = percentiles(values, {"v": {"cut": params.histogram_quantile}})["v"]["cut"]
    kept = values.filter(F.col("v") < F.lit(cut).cast("double"))
    span = kept.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    place = F.floor((F.col("v") - F.col("span.low")) * bins / (F.col("span.high") - F.col("span.low")))
    counted = with_row(kept, span, "span").select(
        F.when(F.col("span.high") == F.col("span.low"), F.floor(F.lit(bins / 2)))
        .otherwise(F.least(place, F.lit(bins - 1))).alias("bin")
    ).groupBy("bin").agg(F.count("*").alias("n"))
    every_bin = shop.spark.range(bins).select(F.col("id").alias("bin"))
    width = (F.col("span.high") - F.col("span.low")) / bins
    return with_row(every_bin.join(counted, "bin", "left"), span, "span").select(
        "bin",
        F.round(F.col("span.low") + width * F.col("bin"), 2).alias("bin_start"),
        F.round(F.col("span.low") + width * (F.col("bin") + 1), 2).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("orders"),
    )


def category_share(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Discounted revenue per category; items are added up per order and product before the products join."""
    per_product = item_facts(shop).groupBy("product_id").agg(F.sum("net_value").alias("net"))
    per_category = (
        per_product.join(shop.products.select("product_id", "category"), "product_id", "left")
        .filter("category IS NOT NULL")
        .groupBy("category").agg(F.sum("net").cast("decimal(28,6)").alias("revenue"))
    )
    # A handful of rows: the total comes from a window over them, not from a second pass.
    total = F.sum("revenue").over(Window.partitionBy())
    return per_category.withColumn("share_pct", percent(F.col("revenue"), total, 2, money=True))


def device_orders(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    per_customer = completed_orders(shop).groupBy("customer_id").agg(F.count("*").alias("n"))
    devices = shop.customers.select("customer_id", "device")
    return per_customer.join(devices, "customer_id", "left").filter("device IS NOT NULL").groupBy("device").agg(
        F.sum("n").alias("orders")
    )


def key_figures(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    orders = shop.orders.agg(
        F.count_if(F.col("order_status") == "Completed").alias("completed_orders"),
        F.to_date(F.min("order_date")).alias("first_day"),
        F.to_date(F.max("order_date")).alias("last_day"),
    )
    customers = shop.customers.agg(F.count("*")).scalar()
    values = written(order_values(shop), "order-values")
    figures = values.agg(
        F.sum("order_value").alias("net_revenue"), mean_of(F.col("order_value"), 2).alias("aov")
    )
    median = percentiles(values, {"order_value": {"median": 0.5}})["order_value"]["median"]
    return with_row(orders, figures, "f").select(
        customers.alias("customers"), "completed_orders", F.round("f.net_revenue", 2).alias("net_revenue"),
        "f.aov", F.round(F.lit(median).cast("decimal(28,6)"), 2).alias("median_order_value"), "first_day", "last_day",
    )
