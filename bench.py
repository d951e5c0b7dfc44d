"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default 8) choose data and cores. The shop tables are
loaded once into typed Parquet (``load_sec``), as a database would hold them; every query then runs on them,
once to warm up and ``BENCH_RUNS`` times (default 3) measured, and the median counts. Results are fully computed
and thrown away by the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from marketloom import Shop
from marketloom.operators import (
    anomaly, boards, churn, churn_model, customers, experiments, explore, funnel, marketing, products, report, rfm, sales,
)
from marketloom.schemas import CLEAN
from marketloom.session import new_folder
from marketloom.sources.testdata import star_shop
from tests.sessions import local_session

HEADLINE = {
    "A1_daily_revenue": sales.daily_revenue,
    "A2_monthly_revenue": sales.monthly_revenue,
    "A3_month_over_month": sales.month_over_month,
    "A5_average_order_value": sales.average_order_value,
    "A6_units_by_category": sales.units_by_category,
    "B2_new_and_returning": customers.new_and_returning,
    "B5_customer_lifetime": customers.customer_lifetime,
    "C2v_step_conversion": funnel.step_conversion,
    "C4v_channel_conversion": funnel.channel_conversion,
    "D1_cohort_retention": customers.cohort_retention,
    "E2_rfm_scores": rfm.rfm_scores,
    "E3_rfm_segments": rfm.rfm_segments,
    "E4_segment_summary": rfm.segment_summary,
    "EX6_order_value_histogram": explore.order_value_histogram,
    "EX7_category_share": explore.category_share,
    "F2_lifetime_value": marketing.lifetime_value,
    "F3_value_to_cost": marketing.value_to_cost,
    "F4_channel_performance": marketing.channel_performance,
    "G1_repurchase_interval": churn.repurchase_interval,
    "G4_churn_by_segment": churn.churn_rate_by_segment,
    "G5_valuable_churned": churn.valuable_churned,
    "H1_product_performance": products.product_performance,
    "H2_product_classes": products.product_classes,
    "H5_product_pairs": products.product_pairs,
    "I2_uplift": experiments.uplift,
    "K10_churn_features": churn_model.churn_features,
    "M4_executive_board": boards.executive_board,
    "N2_revenue_anomalies": anomaly.revenue_z,
    "P1_headline_figures": report.headline_figures,
    "R4_rfm_edge_segments": rfm.rfm_edge_segments,
    "X9_test_summary": experiments.test_summary,
}


def run(query, shop: Shop) -> float:
    start = time.perf_counter()
    query(shop).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session()
    star, place = star_shop(spark, folder), new_folder(spark, "bench")
    start = time.perf_counter()
    cores = spark.sparkContext.defaultParallelism
    for name in CLEAN:
        # One file per core: the test files have a single row group, which only one task can read.
        star.table(name).repartition(cores).write.parquet(f"{place}/{name}")
    load, times = time.perf_counter() - start, {}
    shop = Shop.of_parquet(spark, place)
    for name, query in HEADLINE.items():
        run(query, shop)
        times[name] = statistics.median(run(query, shop) for _ in range(repeats))
    print(json.dumps({
        "metric": "sum of median warm seconds over headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "load_sec": round(load, 3),
        "queries": {name: round(seconds, 3) for name, seconds in times.items()},
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": os.environ.get("BENCH_CPUS", "8"),
    }))


if __name__ == "__main__":
    main()
