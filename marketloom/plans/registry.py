"""Operator id -> DataFrame on the test tables, with the SQL that checks it where SQL can.

or the operator on the fitted forest (``K16_forest``), which no SQL reproduces; the plain id then runs on scores by a
fixed rule, so that the whole computation is checked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketloom.functions.numeric import plain_types
from marketloom.operators import (
    anomaly, boards, churn_model, cleaning, evidence, experiments, explore, forecast, report, rfm, sales,
)
from marketloom.operators.base import customer_facts
from marketloom.operators.ranking import written
from marketloom.params import DEFAULTS, Params
from marketloom.plans import catalogue, sql_analysis, sql_cleaning, sql_views
from marketloom.plans.catalogue import VIEWS
from marketloom.plans.sqlparts import with_ctes
from marketloom.schemas import CLEAN, TABLES, raw_schema
from marketloom.session import frugal_session, new_folder, side_by_side
from marketloom.shop import Shop
from marketloom.sources import files
from marketloom.sources.rawdata import RawTables, star_cleaning
from marketloom.sources.testdata import StarTables, star_shop

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _add(queries: dict[str, Query], sql: dict[str, str] | None = None) -> None:
    QUERIES.update(queries)
    ORACLE.update({k: with_ctes(v) for k, v in (sql or {}).items() if k in queries})


def _shown(df: DataFrame, columns: tuple[str, ...] = (), rounding: dict[str, int] | None = None) -> DataFrame:
    df = plain_types(df)
    df = df.select(*columns) if columns else df
    return df.withColumns({c: F.round(c, n) for c, n in rounding.items()}) if rounding else df


def _on_shop(run, *columns: str, **rounding: int) -> Query:
    return lambda spark, folder: _shown(run(star_shop(spark, folder)), columns, rounding)


# ---- Views, experiment test, quantile-edge RFM ---------------------------------------------------------

_add({view_id: _on_shop(entry.run) for view_id, entry in VIEWS.items()}, sql_views.VIEWS)

_add(
    {
        "X1": _on_shop(experiments.conversion_shares, "experiment_id", "n_control", "n_treatment",
                       "conversions_control", "conversions_treatment", "p_control", "p_treatment",
                       p_control=6, p_treatment=6),
        "X2": _on_shop(experiments.pooled_z, "experiment_id", "p_pooled", "z_statistic", p_pooled=6, z_statistic=6),
        "X3": _on_shop(experiments.significance, "experiment_id", "p_value", "statistically_significant", p_value=6),
        "X4": _on_shop(experiments.uplift_interval, "experiment_id", "uplift_points", "ci_lower_points",
                       "ci_upper_points", uplift_points=6, ci_lower_points=6, ci_upper_points=6),
        "X5": _on_shop(experiments.uplift_interval, "experiment_id", "ci_reading"),
        "X6": _on_shop(experiments.uplift_interval, "experiment_id", "business_significant"),
        "X7": _on_shop(experiments.revenue_per_conversion),
        "X8": _on_shop(experiments.decided, "experiment_id", "decision"),
        "X9": _on_shop(experiments.test_summary),
    },
    sql_views.EXPERIMENT,
)

_add(
    {
        "R1": _on_shop(rfm.rfm_values_by_periods),
        "R2": _on_shop(rfm.rfm_edge_scores, "customer_id", "r_score", "m_score"),
        "R3": _on_shop(rfm.rfm_edge_scores, "customer_id", "f_score"),
        "R4": _on_shop(rfm.rfm_edge_segments),
        "R5": _on_shop(rfm.edge_segment_summary),
        "R6": _on_shop(rfm.segment_actions),
    },
    sql_views.EDGES,
)

# ---- Exploration, anomalies ----------------------------------------------------------------------------


def _flagged(series, *columns: str) -> Query:
    return _on_shop(lambda shop: anomaly.flagged(series(shop)), *columns, "z_score", z_score=4)


_add(
    {
        "EX1": _on_shop(explore.item_facts),
        "EX2": _on_shop(explore.monthly_series),
        "EX3": _on_shop(explore.status_mix),
        "EX4": _on_shop(explore.channel_mix),
        "EX5": _on_shop(explore.order_value_statistics),
        "EX6": _on_shop(explore.order_value_histogram),
        "EX7": _on_shop(explore.category_share),
        "EX8": _on_shop(explore.device_orders),
        "EX9": _on_shop(explore.key_figures),
        "N1": _on_shop(anomaly.revenue_z, z_score=4),
        "N2": _flagged(anomaly.revenue_z, "order_day", "revenue"),
        "N3": _flagged(anomaly.orders_z, "order_day", "order_count"),
        "N4": _flagged(anomaly.spend_z, "date", "spend"),
        "N5": _flagged(anomaly.refunds_z, "return_date", "refund_amount"),
        "N6": _on_shop(anomaly.drop_cause, z_score=4, orders_z_score=4),
        "N7": _on_shop(anomaly.flag_counts),
    },
    sql_analysis.ANALYSIS,
)

# ---- Fitted models: one fit per session and folder, read by every query that needs it ------------------

_fits: dict[tuple, object] = {}


def _fitted(kind: str, fit, spark: SparkSession, folder: str):
    key = (kind, spark.sparkContext.applicationId, folder)
    if key not in _fits:
        _fits[key] = fit(star_shop(spark, folder))
    return _fits[key]


def _forecast(spark: SparkSession, folder: str) -> forecast.RevenueForecast:
    return _fitted("forecast", forecast.revenue_forecast, spark, folder)


def _forest(spark: SparkSession, folder: str) -> churn_model.ChurnForest:
    return _fitted("forest", churn_model.churn_forest, spark, folder)


def _on_forecast(run, *columns: str, **rounding: int) -> Query:
    return lambda spark, folder: _shown(run(_forecast(spark, folder)), columns, rounding)


_add(
    {
        "T1": _on_shop(forecast.revenue_calendar),
        "T2": _on_shop(forecast.feature_table, "order_day", "day_index", "day_of_week", "month"),
        "T3": _on_shop(forecast.feature_table, "order_day", *forecast.FEATURES[1:]),
        "T4": _on_forecast(lambda f: f.backtest, revenue=0, prediction=0),
        "T5": _on_forecast(lambda f: forecast.forecast_errors(f.backtest), mae=1, mape_pct=4),
        "T6": _on_forecast(lambda f: forecast.error_deviation(f.backtest), residual_sigma=1),
        "T7": _on_forecast(lambda f: f.future, "order_day", "forecast_revenue", forecast_revenue=0),
        "T8": _on_forecast(lambda f: f.future, "order_day", "forecast_revenue", "lower_bound", "upper_bound",
                           forecast_revenue=0, lower_bound=0, upper_bound=0),
        "T9": _on_forecast(lambda f: forecast.forecast_totals(f.future),
                           next_30_days=0, next_60_days=0, next_90_days=0),
    },
    sql_analysis.ANALYSIS,
)

# ---- Churn model ---------------------------------------------------------------------------------------


def rule_scores(shop: Shop) -> DataFrame:
    """Buyers with a churn probability by a fixed rule: many ties, both band limits, zeros."""
    p = F.least(F.lit(1.0), F.round(F.lit(0.15) * F.col("returns"), 4))
    return churn_model.churn_features(shop).select(
        "customer_id", "total_spend", F.col("churned").alias("label"), p.alias("churn_probability")
    ).withColumn("prediction", (F.col("churn_probability") > 0.5).cast("int"))


def _of_buyers(part) -> Query:
    def run(shop: Shop) -> DataFrame:
        return part(shop).join(churn_model.buyers(shop), "customer_id", "left_semi")

    return run


def _on_rule(run, *columns: str, **rounding: int) -> Query:
    return _on_shop(lambda shop: run(written(rule_scores(shop), "rule-scores")), *columns, **rounding)


def _on_forest(run, *columns: str, **rounding: int) -> Query:
    return lambda spark, folder: _shown(run(_forest(spark, folder)), columns, rounding)


def _on_test_rows(run) -> Query:
    return _on_forest(lambda f: run(written(f.test_predictions(), "test-scores")))


def _banded_forest(forest: churn_model.ChurnForest) -> DataFrame:
    return churn_model.risk_bands(written(forest.scored(forest.features), "scores"))


def _evidence(banded: DataFrame) -> DataFrame:
    return churn_model.model_evidence(banded, churn_model.priority_list(banded))


def _trees(forest: churn_model.ChurnForest) -> DataFrame:
    rows = [(i, t.depth, t.numNodes) for i, t in enumerate(forest.model.trees)]
    return forest.features.sparkSession.createDataFrame(rows, "tree int, depth int, nodes int")


_add(
    {
        "K1": _on_shop(churn_model.buyers),
        "K2": _on_shop(churn_model.spend_habits, "customer_id", "days_since_last_purchase"),
        "K3": _on_shop(_of_buyers(churn_model.order_habits), "customer_id", "purchase_frequency"),
        "K4": _on_shop(churn_model.spend_habits, "customer_id", "total_spend"),
        "K5": _on_shop(churn_model.spend_habits, "customer_id", "avg_order_value"),
        "K6": _on_shop(churn_model.session_habits, "customer_id", "number_of_sessions"),
        "K7": _on_shop(churn_model.session_habits, "customer_id", "cart_abandonment"),
        "K8": _on_shop(churn_model.return_habits),
        "K9": _on_shop(_of_buyers(churn_model.order_habits), "customer_id", "discount_usage", discount_usage=6),
        "K10": _on_shop(churn_model.churn_features, discount_usage=6),
        "K11": _on_shop(
            lambda shop: churn_model.stratified_split(churn_model.churn_features(shop), "churned", "customer_id"),
            "customer_id", "churned", "is_test",
        ),
        "K12": _on_shop(
            lambda shop: churn_model.standardised(written(
                churn_model.stratified_split(churn_model.churn_features(shop), "churned", "customer_id"), "split"
            )),
            "customer_id", "is_test", *churn_model.FEATURES, **{c: 6 for c in churn_model.FEATURES},
        ),
        "K13": _on_forest(_trees),
        "K14": _on_forest(lambda f: f.test_predictions()),
        "K15": _on_rule(churn_model.classification_report, precision=6, recall=6, f1_score=6),
        "K16": _on_rule(churn_model.roc_auc, roc_auc=6),
        "K17": _on_rule(churn_model.average_precision, average_precision=6),
        "K18": _on_rule(churn_model.confusion_matrix),
        "K19": _on_rule(churn_model.roc_points, fpr=6, tpr=6),
        "K19_precision_recall": _on_rule(churn_model.precision_recall_points, precision=6, recall=6),
        "K15_forest": _on_test_rows(churn_model.classification_report),
        "K16_forest": _on_test_rows(churn_model.roc_auc),
        "K17_forest": _on_test_rows(churn_model.average_precision),
        "K18_forest": _on_test_rows(churn_model.confusion_matrix),
        "K19_forest": _on_test_rows(churn_model.roc_points),
        "K20": _on_forest(churn_model.feature_importance),
        "K21": _on_rule(churn_model.risk_bands, "customer_id", "churn_probability", "risk_segment"),
        "K22": _on_rule(lambda s: churn_model.priority_list(churn_model.risk_bands(s)),
                        "customer_id", "total_spend", "churn_probability"),
        "K23": _on_rule(lambda s: _evidence(churn_model.risk_bands(s))),
        "K21_forest": _on_forest(_banded_forest),
        "K22_forest": _on_forest(lambda f: churn_model.priority_list(_banded_forest(f))),
        "K23_forest": _on_forest(lambda f: _evidence(_banded_forest(f))),
    },
    sql_analysis.ANALYSIS,
)

# ---- Report measures and boards ------------------------------------------------------------------------


def _outlook(spark: SparkSession, folder: str) -> DataFrame:
    """On the rule scores; P2_forest has the forest's."""
    shop = star_shop(spark, folder)
    banded = churn_model.risk_bands(written(rule_scores(shop), "rule-scores"))
    future = _forecast(spark, folder).future
    result = report.outlook(churn_model.churn_features(shop), churn_model.priority_list(banded), future)
    return _shown(result, (), {f"next_{n}_days": 0 for n in (30, 60, 90)})


def _outlook_forest(spark: SparkSession, folder: str) -> DataFrame:
    forest = _forest(spark, folder)
    urgent = churn_model.priority_list(_banded_forest(forest))
    return _shown(report.outlook(forest.features, urgent, _forecast(spark, folder).future))


def _budgeted(shop: Shop) -> DataFrame:
    """Buyers as JSON rows per channel, a list of at most 4000 characters each."""
    channels = shop.customers.select("customer_id", F.col("acquisition_channel").alias("section"))
    items = customer_facts(shop).select("customer_id", "total_orders").join(channels, "customer_id").select(
        "section", "customer_id", F.to_json(F.struct("customer_id", "total_orders")).alias("row_json")
    )
    return evidence.within_budget(items, "section", ["customer_id"], "row_json", Params(evidence_budget=4000))


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of every conversation as a question."""
    turns = StarTables(spark, folder).read("conversations").select("conv_id", "turn", "text")
    return plain_types(evidence.routed(turns, "text").select(
        "conv_id", "turn", F.array_join("sections", ",").alias("sections")
    ))


_add(
    {
        "P1": _on_shop(report.headline_figures),
        "P2": _outlook,
        "P2_forest": _outlook_forest,
        "P3": _on_shop(report.unfinished_share),
        "P4": _on_shop(report.segment_shares),
        "P4_top_two": _on_shop(report.top_segment_shares),
        "P5": _on_shop(report.worst_day, z_score=4),
        "P7": _on_shop(_budgeted),
        "P8": _routed,
        "M1": _on_shop(boards.latest_month),
        "M1_all_months": _on_shop(boards.month_changes),
        "M2": _on_shop(boards.category_returns),
        "M3": _on_shop(boards.overall_margin),
        "M4": _on_shop(boards.executive_board),
        "M5": _on_shop(boards.customer_board),
        "M6": _on_shop(boards.growth_board),
        "M7": _on_shop(boards.product_board),
    },
    sql_analysis.ANALYSIS,
)

# ---- Cleaning ------------------------------------------------------------------------------------------


def _rule(table: str, *steps, columns: tuple[str, ...]) -> Query:
    """Single rules on the raw table of that name."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = RawTables(spark, folder).table(table)
        for step in steps:
            df = df.transform(step)
        return _shown(df, columns)

    return query


def _orphans(spark: SparkSession, folder: str) -> DataFrame:
    parents = star_cleaning(spark, folder).customers()
    rules = (cleaning.keep_first("order_id"), cleaning.with_parent(parents, "customer_id"))
    return _rule("orders", *rules, columns=("order_id", "customer_id"))(spark, folder)


_first_customer = cleaning.keep_first("customer_id")
_texts = cleaning.clean_texts(*cleaning.CUSTOMER_TEXTS)
_titles = cleaning.title_texts("country", "city")
_prices = cleaning.numbers(cost="decimal(12,2)", selling_price="decimal(12,2)")
_amounts = cleaning.numbers(discount="decimal(6,4)", shipping_cost="decimal(12,2)")
_quantities = cleaning.numbers(quantity="int", unit_price="decimal(12,2)")
_clicks = cleaning.numbers(impressions="int", clicks="int", conversions="int")

_add(
    {
        "C1": _rule("marketing_campaigns", cleaning.drop_repeated_rows,
                    lambda df: df.groupBy("channel").agg(F.count("*").alias("rows_left")), columns=()),
        "C2": _rule("orders", cleaning.keep_first("order_id"), columns=("order_id", "order_status")),
        "C3": _rule("customers", _first_customer, _texts, columns=("customer_id", "city", "device")),
        "C4": _rule("customers", _first_customer, _texts, _titles, columns=("customer_id", "country", "city")),
        "C5": _rule("customers", _first_customer, _texts, _titles, cleaning.respell_countries,
                    columns=("customer_id", "country")),
        "C6": _rule("customers", _first_customer, _texts, _titles, cleaning.fill_labels(cleaning.CUSTOMER_LABELS),
                    columns=("customer_id", "city", "device", "customer_segment")),
        "C7": _rule("orders", cleaning.keep_first("order_id"), _amounts,
                    cleaning.zero_if_missing("discount", "shipping_cost"),
                    columns=("order_id", "discount", "shipping_cost")),
        "C8": _rule("customers", _first_customer, cleaning.valid_time("signup_date", "date"),
                    columns=("customer_id", "signup_date")),
        "C9": _orphans,
        "C10": _rule("orders", cleaning.keep_first("order_id"), cleaning.listed("order_status", cleaning.STATUSES),
                     columns=("order_id", "order_status")),
        "C11": _rule("products", cleaning.keep_first("product_id"), _prices, cleaning.flag_missing_cost,
                     columns=("product_id", "cost_is_estimated")),
        "C12": _rule("products", cleaning.keep_first("product_id"), cleaning.titled_or_null("category"), _prices,
                     cleaning.fill_cost, columns=("product_id", "cost")),
        "C13": _rule("products", cleaning.keep_first("product_id"), _prices, cleaning.flag_invalid_price,
                     columns=("product_id", "price_is_invalid")),
        "C14": _rule("order_items", cleaning.keep_first("order_item_id"), _quantities, cleaning.positive_quantity,
                     columns=("order_item_id", "quantity")),
        "C15": _rule("order_items", cleaning.keep_first("order_item_id"), _quantities, cleaning.add_line_total,
                     columns=("order_item_id", "line_total")),
        "C16": _rule("marketing_campaigns", cleaning.drop_repeated_rows, cleaning.valid_time("date", "date"),
                     _clicks, cleaning.plausible_clicks, columns=("date", "channel", "clicks")),
        "C17": _rule("payments", cleaning.keep_first("payment_id"), cleaning.numbers(amount="decimal(18,2)"),
                     cleaning.no_negative_amount, columns=("payment_id", "amount")),
        "C18": lambda spark, folder: plain_types(star_cleaning(spark, folder).keeping(written).audit()),
        "C18_rules": lambda spark, folder: plain_types(
            star_cleaning(frugal_session(spark), folder).keeping(written, counting=True, parts=cleaning.in_parts).rule_audit(spark)
        ),
    },
    sql_cleaning.RULES,
)

_PIPELINES = {
    "CT1": "customers", "CT2": "products", "CT3": "orders", "CT4": "order_items", "CT5": "web_events",
    "CT6": "marketing_campaigns", "CT7": "payments", "CT8": "returns", "CT9": "experiments",
}


def _cleaned(table: str) -> Query:
    return lambda spark, folder: plain_types(star_cleaning(spark, folder).table(table))


_add({key: _cleaned(table) for key, table in _PIPELINES.items()}, sql_cleaning.PIPELINES)

# ---- Sources and sinks: written to and read back from the shared folder --------------------------------

_DAY_COLUMNS = {
    "customers": "signup_date", "orders": "order_date", "payments": "payment_date", "returns": "return_date",
    "marketing_campaigns": "date", "web_events": "event_timestamp", "experiments": "experiment_date",
}


def _raw_folder(spark: SparkSession, raw: RawTables) -> str:
    place = new_folder(spark, "raw-csv")
    side_by_side(lambda table: files.write_csv(raw.table(table).drop("_seq"), f"{place}/{table}"), TABLES)
    return place


def _raw_files(spark: SparkSession, folder: str) -> DataFrame:
    place = _raw_folder(spark, RawTables(spark, folder))
    return files.row_counts(Shop(spark, lambda t: files.read_raw_csv(spark, f"{place}/{t}", t)))


def _quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """Raw files of all tables with lines among the customers that have a field too many or break off."""
    raw = RawTables(spark, folder)
    place = _raw_folder(spark, raw)
    key = F.substring("customer_id", 2, 12).cast("bigint")
    line = F.when(key % 97 == 0, F.concat("customer_id", F.lit(",a,b,c,d,e,f,g,h"))).when(key % 89 == 0, F.concat("customer_id", F.lit(",a")))
    # One column, named as the whole header, with another separator: lines are written as they are.
    odd = raw.clean.customers().select(line.alias(",".join(raw_schema("customers").names))).na.drop()
    odd.write.mode("append").options(header=True, sep="\u0001").csv(f"{place}/customers")
    found = files.quarantine(spark, place, new_folder(spark, "quarantine")).select("table_name", "reason", "text")
    kept = files.row_counts(Shop(spark, lambda t: files.read_raw_csv(spark, f"{place}/{t}", t)))
    return found.unionByName(kept.select("table_name", F.lit("rows kept").alias("reason"), F.col("total_rows").cast("string").alias("text")))


def _clean_folder(spark: SparkSession, folder: str, tables=TABLES) -> str:
    shop, place = star_shop(spark, folder), new_folder(spark, "clean-csv")
    side_by_side(lambda table: files.write_csv(shop.table(table).select(*CLEAN[table].names), f"{place}/{table}"), tables)
    return place


def _clean_files(spark: SparkSession, folder: str) -> DataFrame:
    place = _clean_folder(spark, folder, tuple(_DAY_COLUMNS))
    result = None
    for table, day in _DAY_COLUMNS.items():
        line = files.read_clean_csv(spark, f"{place}/{table}", table).agg(
            F.count("*").alias("total_rows"), F.to_date(F.min(day)).alias("first_day"),
            F.to_date(F.max(day)).alias("last_day"),
        ).select(F.lit(table).alias("table_name"), "*")
        result = line if result is None else result.unionByName(line)
    return result


def _canonical(name: str, kind: str) -> F.Column:
    """A value as text that any engine writes alike; decimals as their unscaled number."""
    column = F.col(name)
    if kind.startswith("decimal"):
        scale = int(kind.rstrip(")").split(",")[1])
        return (column * 10**scale).cast("decimal(38,0)").cast("string")
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS") if kind == "timestamp_ntz" else column.cast("string")


def _digest(text: F.Column) -> F.Column:
    """Sum of 28 bits of each value's md5: the same in any order of rows."""
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")), F.lit(0))


def _column_digests(shop: Shop) -> DataFrame:
    """Per table and column the values there and their digest; column ``*`` is the digest of whole rows."""
    result = None
    for table in TABLES:
        texts = {f.name: _canonical(f.name, f.dataType.simpleString()) for f in CLEAN[table]}
        rows = F.concat_ws("|", *[F.coalesce(t, F.lit("<null>")) for t in texts.values()])
        lines = [
            F.struct(F.lit(c).alias("column_name"), F.count(t).alias("values_there"), _digest(t).alias("digest"))
            for c, t in {**texts, "*": rows}.items()
        ]
        line = shop.table(table).agg(F.array(*lines).alias("lines")).select(F.lit(table).alias("table_name"), F.inline("lines"))
        result = line if result is None else result.unionByName(line)
    return result


def _clean_file_columns(spark: SparkSession, folder: str) -> DataFrame:
    place = _clean_folder(spark, folder)
    return _column_digests(Shop(spark, lambda t: files.read_clean_csv(spark, f"{place}/{t}", t)))


def _loaded_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _column_digests(files.load_tables(spark, _clean_folder(spark, folder), new_folder(spark, "loaded")))


def _loaded(spark: SparkSession, folder: str) -> DataFrame:
    return files.row_counts(files.load_tables(spark, _clean_folder(spark, folder), new_folder(spark, "loaded")))


def _result_file(spark: SparkSession, folder: str) -> DataFrame:
    place = new_folder(spark, "result-csv")
    months = plain_types(sales.monthly_revenue(star_shop(spark, folder)))
    files.write_result_csv(months, place)
    return spark.read.schema(months.schema).csv(place, header=True)


def _view_names(spark: SparkSession, folder: str) -> DataFrame:
    catalogue.register_views(star_shop(spark, folder).keeping(written))
    names = sorted(t.name for t in spark.catalog.listTables() if t.name.startswith("vw_"))
    return spark.createDataFrame([(n,) for n in names], "view_name string")


def _view_samples(spark: SparkSession, folder: str) -> DataFrame:
    return evidence.view_samples(star_shop(spark, folder).keeping(written)).groupBy(
        F.col("item").alias("view_name"), "status"
    ).agg(F.count("row_json").alias("rows_returned"))


def _summary(shop: Shop) -> DataFrame:
    summary = evidence.result_summary(VIEWS["F2"].run(shop), order=VIEWS["F2"].order)
    return summary.select(
        "row_count", F.array_join("columns", ",").alias("columns"), F.size("sample").alias("sample_rows")
    )


def _sample(shop: Shop) -> DataFrame:
    """The rows that the summary shows, read back from their JSON."""
    rows = plain_types(VIEWS["F2"].run(shop))
    shown = evidence.result_summary(rows, order=VIEWS["F2"].order).select(F.posexplode("sample").alias("place", "row"))
    back = F.from_json("row", rows.schema)
    return shown.select((F.col("place") + 1).cast("bigint").alias("place"), back.alias("row")).select("place", "row.*")


def _laid_out_period(spark: SparkSession, folder: str) -> DataFrame:
    """Months of one year from facts that are partitioned by month and bucketed by order."""
    place = new_folder(spark, "laid-out")
    facts = files.lay_out(star_shop(spark, folder), place, f"facts_{place.rsplit('-', 1)[1]}")
    return plain_types(sales.monthly_revenue(facts.shop("1995-03", "1996-02")))


def _pack(spark: SparkSession, folder: str) -> DataFrame:
    """All evidence: forest, experiment, every view, forecast, anomalies, segments."""
    shop, forest = star_shop(spark, folder).keeping(written), _forest(spark, folder)
    banded = _banded_forest(forest)
    order = catalogue.in_order

    def series(name: str) -> Callable[[], DataFrame]:
        return lambda: anomaly.flagged(anomaly.SERIES[name](shop))

    sections = {
        "ml_predictions": {
            "model_evidence": lambda: order(_evidence(banded), ("item",)),
            "roc_auc": lambda: churn_model.roc_auc(written(forest.test_predictions(), "test-scores")),
        },
        "ab_testing": {"test_summary": lambda: order(experiments.test_summary(shop), ("experiment_id",))},
        "sql_analytics": {v.name: (lambda i=i: catalogue.view(shop, i)) for i, v in VIEWS.items()},
        "python_analytics": {
            "monthly_revenue": lambda: order(explore.monthly_series(shop), ("order_month",)),
            "churn_risk_scores": lambda: order(banded, ("-churn_probability", "customer_id")),
            "retention_priority": lambda: order(
                churn_model.priority_list(banded), ("-total_spend", "customer_id")),
            "revenue_forecast_90_days": lambda: order(_forecast(spark, folder).future, ("order_day",)),
            "revenue_anomalies": lambda: order(series("revenue")(), ("order_day",)),
            "order_anomalies": lambda: order(series("order_volume")(), ("order_day",)),
            "marketing_spend_anomalies": lambda: order(series("marketing_spend")(), ("date",)),
            "refund_anomalies": lambda: order(series("refunds")(), ("return_date",)),
            "rfm_segments": lambda: order(rfm.rfm_edge_segments(shop), ("-monetary", "customer_id")),
            "rfm_segment_summary": lambda: order(rfm.edge_segment_summary(shop), ("-total_monetary", "rfm_segment")),
            "rfm_segment_actions": lambda: order(rfm.segment_actions(shop), ("rfm_segment",)),
        },
    }
    return evidence.evidence_pack(spark, sections, DEFAULTS)


_VIEW_COUNTS = " UNION ALL ".join(
    f"SELECT '{VIEWS[i].name}' AS view_name, 'success' AS status, least(count(*), 30) AS rows_returned FROM "
    f"({ORACLE[i]})" for i in VIEWS
)
_add(
    {
        "S1": _raw_files, "S1_quarantine": _quarantined, "S2": _clean_files, "S2_columns": _clean_file_columns, "S3": _loaded,
        "S3_columns": _loaded_columns, "S4": _on_shop(files.row_counts), "S5": _result_file,
        "S6": _view_names, "S7": _view_samples, "S8": _on_shop(_summary),
        "S8_sample": _on_shop(_sample), "S3_period": _laid_out_period, "P6": _pack,
    },
    {
        **sql_cleaning.SOURCES,
        "S5": sql_views.VIEWS["A2"],
        "S6": " UNION ALL ".join(f"SELECT '{v.name}' AS view_name" for v in VIEWS.values()),
        "S3_period": f"SELECT * FROM ({sql_views.VIEWS['A2']}) WHERE order_month BETWEEN DATE '1995-03-01' AND DATE '1996-02-01'",
        "S8_sample": f"SELECT row_number() OVER (ORDER BY clv DESC, customer_id) AS place, * FROM ({sql_views.VIEWS['F2']}) "
                     "ORDER BY place LIMIT 20",
        "S8": "SELECT count(*) AS row_count, 'customer_id,clv,total_orders,first_order,last_order,avg_order_value' "
              "AS columns, least(count(*), 20) AS sample_rows FROM buyer",
    },
)
ORACLE["S7"] = _VIEW_COUNTS
