"""Whole runs: raw files to cleaned tables, and cleaned tables to the result files of all analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.operators import anomaly, churn_model, experiments, explore, forecast, rfm
from marketloom.operators.cleaning import Cleaning
from marketloom.operators.ranking import written
from marketloom.params import DEFAULTS, Params
from marketloom.plans.catalogue import in_order
from marketloom.shop import Shop
from marketloom.sources.files import quarantine, read_raw_csv, write_csv, write_result_csv


def clean_files(spark: SparkSession, raw_folder: str, clean_folder: str, csv: bool = False) -> Shop:
    """Raw CSV folders, one per table, to cleaned Parquet (and CSV) tables; each is written once, parents first.

    ``clean_folder`` also gets ``quarantine``, the records whose fields don't match the columns, and ``rule_counts``, how many
    rows each rule left out.
    """

    own = spark.newSession()  # see Cleaning.keeping

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{clean_folder}/{name}")
        stored = own.read.schema(df.schema).parquet(f"{clean_folder}/{name}")
        if csv:
            write_csv(stored, f"{clean_folder}/csv/{name}")
        return stored

    cleaning = Cleaning(lambda t: read_raw_csv(own, f"{raw_folder}/{t}", t), keep, counting=True)
    cleaning.rule_audit(spark).write.parquet(f"{clean_folder}/rule_counts")
    quarantine(spark, raw_folder, f"{clean_folder}/quarantine")
    return Shop.of_parquet(spark, clean_folder)


def write_analyses(shop: Shop, folder: str, params: Params = DEFAULTS) -> list[str]:
    """Every result of the analyses as a CSV folder; shared facts and the two models are computed once."""
    shop = shop.keeping(written)
    forest = churn_model.churn_forest(shop, params)
    banded = written(churn_model.risk_bands(forest.scored(forest.features), params), "scores")
    outlook = forecast.revenue_forecast(shop, params).future.drop("days_ahead")
    results: dict[str, tuple[DataFrame, tuple[str, ...]]] = {
        "monthly_revenue": (explore.monthly_series(shop, params), ("order_month",)),
        "churn_features": (forest.features, ()),
        "customer_churn_risk_scores": (banded, ("-churn_probability", "customer_id")),
        "retention_priority_list": (churn_model.priority_list(banded), ("-total_spend", "customer_id")),
        "revenue_forecast_90days": (outlook, ("order_day",)),
        "anomalies_revenue": (anomaly.flagged(anomaly.revenue_z(shop, params)), ("order_day",)),
        "anomalies_order_volume": (anomaly.flagged(anomaly.orders_z(shop, params)), ("order_day",)),
        "anomalies_marketing_spend": (anomaly.flagged(anomaly.spend_z(shop, params)), ("date",)),
        "anomalies_refunds": (anomaly.flagged(anomaly.refunds_z(shop, params)), ("return_date",)),
        "ab_test_summary": (experiments.test_summary(shop, params), ("experiment_id",)),
        "rfm_segments": (rfm.rfm_edge_segments(shop, params), ()),
        "rfm_segment_summary": (rfm.edge_segment_summary(shop, params), ("-total_monetary", "rfm_segment")),
        "rfm_segment_actions": (rfm.segment_actions(shop, params), ("rfm_segment",)),
    }
    for name, (df, order) in results.items():
        write_result_csv(in_order(df, order), f"{folder}/{name}")
    return list(results)
