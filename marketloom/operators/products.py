"""Product performance, classification, returns and baskets (H1–H5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketloom.functions.numeric import percent, ratio
from marketloom.operators.base import completed_orders, product_totals
from marketloom.operators.ranking import percentiles, written
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop


def product_sales(shop: Shop) -> DataFrame:
    """Sold products with a valid price: units, revenue and margin."""
    valid = shop.products.filter(~F.col("price_is_invalid")).select(
        "product_id", "product_name", "category", "cost"
    )
    cost = F.col("units_sold") * F.coalesce("cost", F.lit(0).cast("decimal(12,2)"))
    return product_totals(shop).join(valid, "product_id").select(
        "product_id", "product_name", "category", "units_sold", "revenue",
        (F.col("revenue") - cost).cast("decimal(28,2)").alias("gross_margin"),
    )


def product_performance(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    returned = shop.returns.groupBy("product_id").agg(F.count("*").alias("return_count"))
    joined = product_sales(shop).join(returned, "product_id", "left").withColumn(
        "return_count", F.coalesce("return_count", F.lit(0))
    )
    return joined.select(
        "product_id", "product_name", "category", "units_sold", "revenue", "gross_margin",
        percent(F.col("gross_margin"), F.col("revenue"), money=True).alias("margin_pct"),
        "return_count",
        percent(F.col("return_count"), F.col("units_sold")).alias("return_rate_pct"),
    )


def product_classes(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    sales = written(product_sales(shop), "product-sales")
    half = {"median": 0.5}
    medians = percentiles(sales, {"units_sold": half, "gross_margin": half})
    sells, earns = (F.col(c).cast("double") >= F.lit(medians[c]["median"]).cast("double") for c in medians)
    return sales.select(
        "product_id", "product_name", "category", "units_sold", "gross_margin",
        F.when(sells & earns, "Star").when(sells, "Problem Product").when(earns, "Hidden Gem")
        .otherwise("Dead Stock").alias("product_classification"),
    )


def category_summary(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return (
        product_totals(shop).join(shop.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.count("*").alias("num_products"),
            F.sum("units_sold").alias("units_sold"),
            F.sum("revenue").alias("revenue"),
            ratio(F.sum("unit_price_sum"), F.sum("priced_count"), 2).alias("avg_unit_price"),
        )
    )


def return_reasons(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.returns.groupBy("return_reason").agg(
        F.count("*").alias("num_returns"), F.round(F.sum("refund_amount"), 2).alias("total_refunded")
    )


def product_pairs(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Pairs of product names bought in one order, all of them counted.

    Lines of one product in one order are first added up, on the map side already, so a pair is met once per
    order with its number of line pairs as weight. The products of a very large order are dealt into blocks; each
    pair of blocks is a join key of its own, which spreads that order's pairs over many tasks and still meets
    every pair once. Between the joins the data change their partitioning, so Spark may split any skewed join.
    """
    names = shop.products.select("product_id", "product_name")
    items = shop.order_items.filter("order_id IS NOT NULL AND product_id IS NOT NULL")
    lines = items.groupBy("order_id", "product_id").agg(F.count("*").alias("lines"))
    # There are never more products than lines; naming the lines keeps the shuffled columns equal to those of the
    # other use of ``lines``, so that Spark shuffles the items once.
    products = F.least(F.count("*"), F.sum("lines"))
    block_count = F.ceil(products / params.pair_block).cast("int")
    orders = completed_orders(shop).select("order_id").join(
        lines.groupBy("order_id").agg(block_count.alias("blocks")), "order_id"
    )
    dealt = (
        lines.join(names, "product_id")
        .join(orders, "order_id")
        .withColumn("block", F.pmod(F.xxhash64("product_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "order_id", "product_id", "product_name", "lines", "block",
            F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        )
    )
    a, b = dealt.alias("a"), dealt.alias("b")
    # Products of the same block meet only where both sides of the block pair are that block.
    once = (F.col("a.low") == F.col("a.high")) | (F.col("a.block") != F.col("b.block"))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("order_id", "low", "high")]
    met = a.join(b, [*same, F.col("a.product_id") < F.col("b.product_id"), once])
    return (
        met.groupBy(F.col("a.product_name").alias("product_a_name"), F.col("b.product_name").alias("product_b_name"))
        .agg(F.sum(F.col("a.lines") * F.col("b.lines")).alias("times_bought_together"))
        .filter(F.col("times_bought_together") >= params.pair_min_count)
        .orderBy(F.desc("times_bought_together"), "product_a_name", "product_b_name")
        .limit(params.pair_limit)
    )
