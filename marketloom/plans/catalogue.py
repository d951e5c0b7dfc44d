"""The 40 views: their public name, the order they are shown in, and the operator behind each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from marketloom.operators import churn, customers, experiments, funnel, marketing, products, rfm, sales
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

Operator = Callable[..., DataFrame]


@dataclass(frozen=True)
class View:
    name: str
    run: Operator
    # Sort keys, "-" for descending; always a total order.
    order: tuple[str, ...] = ()


VIEWS: dict[str, View] = {
    "A1": View("vw_a1_daily_revenue", sales.daily_revenue, ("order_day",)),
    "A2": View("vw_a2_monthly_revenue", sales.monthly_revenue, ("order_month",)),
    "A3": View("vw_a3_month_over_month", sales.month_over_month, ("order_month",)),
    "A4": View("vw_a4_year_over_year", sales.year_over_year, ("order_month",)),
    "A5": View("vw_a5_average_order_value", sales.average_order_value, ("order_month",)),
    "A6": View("vw_a6_units_sold_by_category", sales.units_by_category, ("-revenue", "category")),
    "B1": View("vw_b1_new_customers_per_month", customers.new_customers, ("signup_month",)),
    "B2": View("vw_b2_new_vs_returning_customers_per_month", customers.new_and_returning,
               ("order_month", "customer_type")),
    "B3": View("vw_b3_repeat_purchase_rate", customers.repeat_purchase_rate),
    "B4": View("vw_b4_customer_purchase_frequency", customers.purchase_frequency, ("orders_placed",)),
    "B5": View("vw_b5_customer_lifetime", customers.customer_lifetime, ("-customer_lifetime_days", "customer_id")),
    "B6": View("vw_b6_average_customer_lifetime", customers.average_lifetime),
    "F1": View("vw_f1_cac_per_channel", marketing.acquisition_cost, ("cac", "channel")),
    "F2": View("vw_f2_clv_per_customer", marketing.lifetime_value, ("-clv", "customer_id")),
    "F3": View("vw_f3_average_clv_per_acquisition_channel", marketing.value_to_cost,
               ("-clv_to_cac_ratio", "channel")),
    "F4": View("vw_f4_marketing_channel_performance", marketing.channel_performance, ("-roas", "channel")),
    "C1v": View("vw_c1_overall_funnel_sessions_reaching_each_stage", funnel.sessions_per_stage),
    "C2v": View("vw_c2_conversion_rate_at_each_funnel_step", funnel.step_conversion),
    "C3v": View("vw_c3_device_wise_conversion_rate", funnel.device_conversion, ("-conversion_pct", "device")),
    "C4v": View("vw_c4_channel_wise_conversion_rate", funnel.channel_conversion,
                ("-conversion_pct", "acquisition_channel")),
    "C5v": View("vw_c5_biggest_drop_off_stage", funnel.drop_off, ("-sessions_lost", "stage")),
    "D1": View("vw_d1_cohort_retention_table", customers.cohort_retention, ("cohort_month", "month_number")),
    "D2": View("vw_d2_retention_by_acquisition_channel", customers.channel_retention,
               ("-retention_month{retention_month}_pct", "acquisition_channel")),
    "E1": View("vw_e1_raw_rfm_values_per_customer", rfm.rfm_values, ("-monetary", "customer_id")),
    "E2": View("vw_e2_rfm_scores", rfm.rfm_scores, ("-rfm_total_score", "customer_id")),
    "E3": View("vw_e3_full_rfm_segmentation", rfm.rfm_segments, ("-monetary", "customer_id")),
    "E4": View("vw_e4_segment_summary", rfm.segment_summary, ("-total_monetary", "rfm_segment")),
    "G1": View("vw_g1_median_repurchase_interval", churn.repurchase_interval),
    "G2": View("vw_g2_churn_status_per_customer", churn.churn_status, ("-days_since_last_order", "customer_id")),
    "G3": View("vw_g3_overall_churn_rate", churn.churn_rate),
    "G4": View("vw_g4_churn_rate_by_customer_segment", churn.churn_rate_by_segment,
               ("-churn_rate_pct", "customer_segment")),
    "G5": View("vw_g5_high_value_churned_customers", churn.valuable_churned, ("-total_spend", "customer_id")),
    "H1": View("vw_h1_product_performance", products.product_performance, ("-revenue", "product_id")),
    "H2": View("vw_h2_product_classification", products.product_classes, ("-gross_margin", "product_id")),
    "H3": View("vw_h3_category_level_summary", products.category_summary, ("-revenue", "category")),
    "H4": View("vw_h4_return_reasons_breakdown", products.return_reasons, ("-num_returns", "return_reason")),
    "H5": View("vw_h5_basket_analysis_products_frequently_bought_together", products.product_pairs,
               ("-times_bought_together", "product_a_name", "product_b_name")),
    "I1": View("vw_i1_conversion_rate_by_variant", experiments.variant_results, ("variant",)),
    "I2": View("vw_i2_uplift_calculation", experiments.uplift),
    "I3": View("vw_i3_estimated_annualized_business_impact", experiments.business_impact),
}


def in_order(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    keys = [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc_nulls_last(c) for c in order]
    return df.orderBy(*keys) if keys else df


def view(shop: Shop, view_id: str, params: Params = DEFAULTS) -> DataFrame:
    """The view as its readers see it, in its own order. Column names in it may depend on the retention month."""
    entry = VIEWS[view_id]
    order = tuple(c.format(retention_month=params.retention_month) for c in entry.order)
    return in_order(entry.run(shop, params), order)


def register_views(shop: Shop, params: Params = DEFAULTS) -> list[str]:
    """Make every view a temporary view, so that ``spark.sql("SELECT * FROM vw_a1_daily_revenue")`` works."""
    for view_id, entry in VIEWS.items():
        view(shop, view_id, params).createOrReplaceTempView(entry.name)
    return [entry.name for entry in VIEWS.values()]
