"""Experiment results: plain views (I1–I3) and the significance test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions.numeric import mean_of, percent
from marketloom.functions.stats import normal_quantile, two_sided_p
from marketloom.operators.base import completed_orders
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

CONTROL, TREATMENT = "control", "treatment"


def variant_results(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.experiments.groupBy("variant").agg(
        F.count("*").alias("total_customers"),
        F.sum("converted").alias("conversions"),
        percent(F.sum("converted"), F.count("*")).alias("conversion_rate_pct"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        mean_of(F.col("revenue"), 2).alias("avg_revenue_per_customer"),
    )


def side_by_side(experiments: DataFrame, *group: str) -> DataFrame:
    """Both variants in one row per group, from one aggregation; groups that lack a variant are left out."""
    columns = []
    for variant in (CONTROL, TREATMENT):
        mine = F.col("variant") == variant
        bought = mine & (F.col("converted") == 1)
        columns += [
            F.count_if(mine).alias(f"n_{variant}"),
            F.sum(F.when(mine, F.col("converted"))).alias(f"conversions_{variant}"),
            F.sum(F.when(mine, F.col("revenue"))).alias(f"revenue_{variant}"),
            F.sum(F.when(bought, F.col("revenue"))).alias(f"buyer_revenue_{variant}"),
            F.count(F.when(bought, F.col("revenue"))).alias(f"buyers_{variant}"),
        ]
    return experiments.groupBy(*group).agg(*columns).filter((F.col("n_control") > 0) & (F.col("n_treatment") > 0))


def _share(variant: str, factor: float = 1.0) -> Column:
    return F.lit(factor) * F.col(f"conversions_{variant}") / F.col(f"n_{variant}")


def _per_buyer(variant: str) -> Column:
    return F.col(f"buyer_revenue_{variant}").cast("double") / F.nullif(F.col(f"buyers_{variant}"), F.lit(0))


def uplift(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    control, treatment = _share(CONTROL, 100.0), _share(TREATMENT, 100.0)
    return side_by_side(shop.experiments).select(
        control.alias("control_conversion_pct"),
        treatment.alias("treatment_conversion_pct"),
        F.round(treatment - control, 2).alias("absolute_uplift_pct_points"),
        F.round(100 * (treatment - control) / F.nullif(control, F.lit(0.0)), 2).alias("relative_uplift_pct"),
        F.col("revenue_control").alias("control_revenue"),
        F.col("revenue_treatment").alias("treatment_revenue"),
        F.round(F.col("revenue_treatment") - F.col("revenue_control"), 2).alias("revenue_difference"),
    )


def business_impact(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """The uplift applied to every customer with a completed order."""
    buyers = completed_orders(shop).select(F.count_distinct("customer_id").alias("n")).scalar()
    points = _share(TREATMENT, 100.0) - _share(CONTROL, 100.0)
    return side_by_side(shop.experiments).select(
        buyers.alias("total_customer_base"),
        F.round(points, 2).alias("uplift_pct_points"),
        F.round(buyers * (points / 100) * _per_buyer(TREATMENT), 2).alias("estimated_additional_revenue"),
    )


# ---- Significance test, all experiments at once --------------------------------------------------------


def conversion_shares(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return side_by_side(shop.experiments, "experiment_id").withColumns(
        {"p_control": _share(CONTROL), "p_treatment": _share(TREATMENT)}
    )


def pooled_z(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    shares = conversion_shares(shop, params)
    pooled = (F.col("conversions_control") + F.col("conversions_treatment")) / (
        F.col("n_control") + F.col("n_treatment")
    )
    error = F.sqrt(F.col("p_pooled") * (1 - F.col("p_pooled")) * (1 / F.col("n_control") + 1 / F.col("n_treatment")))
    return shares.withColumn("p_pooled", pooled).withColumn(
        "z_statistic", (F.col("p_treatment") - F.col("p_control")) / F.nullif(error, F.lit(0.0))
    )


def significance(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return pooled_z(shop, params).withColumn("p_value", two_sided_p(F.col("z_statistic"))).withColumn(
        "statistically_significant", F.coalesce(F.col("p_value") < params.alpha, F.lit(False))
    )


def uplift_interval(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Unpooled interval of the uplift, in percentage points, and how to read it."""
    pc, pt = F.col("p_control"), F.col("p_treatment")
    error = F.sqrt(pc * (1 - pc) / F.col("n_control") + pt * (1 - pt) / F.col("n_treatment"))
    margin = F.lit(normal_quantile(1 - params.alpha / 2)) * error
    low, high = F.col("ci_lower_points"), F.col("ci_upper_points")
    return (
        significance(shop, params)
        .withColumns({
            "uplift_points": (pt - pc) * 100,
            "ci_lower_points": (pt - pc - margin) * 100,
            "ci_upper_points": (pt - pc + margin) * 100,
        })
        .withColumn(
            "ci_reading",
            F.when(low > 0, "positive").when(high < 0, "negative").otherwise("crosses zero"),
        )
        .withColumn("business_significant", F.col("uplift_points") >= params.business_bar_points)
    )


def revenue_per_conversion(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return conversion_shares(shop, params).select(
        "experiment_id",
        F.round(_per_buyer(CONTROL), 2).alias("revenue_per_conversion_control"),
        F.round(_per_buyer(TREATMENT), 2).alias("revenue_per_conversion_treatment"),
        "revenue_control", "revenue_treatment",
        (F.col("revenue_treatment") - F.col("revenue_control")).alias("revenue_lift"),
    )


def decided(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    real, big = F.col("statistically_significant"), F.col("business_significant")
    decision = (
        F.when(real & big & (F.col("ci_lower_points") > 0), "SHIP")
        .when(real & ~big, "DO NOT SHIP (as-is)")
        .when(~real & (F.col("uplift_points") > 0), "CONTINUE TEST")
        .otherwise("DO NOT SHIP")
    )
    return uplift_interval(shop, params).withColumn("decision", decision)


def test_summary(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return decided(shop, params).select(
        "experiment_id", "n_control", "n_treatment",
        F.round(F.col("p_control") * 100, 2).alias("conversion_rate_control_pct"),
        F.round(F.col("p_treatment") * 100, 2).alias("conversion_rate_treatment_pct"),
        F.round("uplift_points", 2).alias("absolute_uplift_pct_points"),
        F.round("ci_lower_points", 2).alias("ci_95_lower_pct_points"),
        F.round("ci_upper_points", 2).alias("ci_95_upper_pct_points"),
        F.round("z_statistic", 3).alias("z_statistic"),
        F.round("p_value", 4).alias("p_value"),
        "statistically_significant", "business_significant",
        F.round(F.col("revenue_treatment") - F.col("revenue_control"), 2).alias("revenue_lift_in_experiment"),
        "decision",
    )
