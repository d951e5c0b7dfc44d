"""Recency, frequency, monetary: NTILE form (E1–E4) and quantile-edge form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

from marketloom.functions.dates import whole_days
from marketloom.functions.numeric import mean_of
from marketloom.operators.base import analysis_day, customer_facts, reference_day
from marketloom.operators.ranking import between, place, places_of, selected, tile_starts, written
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

# What the R, F and M scores of each segment must satisfy; the first row that fits wins.
SEGMENT_RULES = (
    ("Champions", "r >= 4 AND f >= 4 AND m >= 4"),
    ("Loyal Customers", "r >= 3 AND f >= 3"),
    ("New Customers", "r >= 4 AND f <= 2"),
    ("Potential Loyalists", "r >= 3 AND f <= 3 AND m >= 3"),
    ("Cannot Lose Them", "r <= 2 AND f >= 4 AND m >= 4"),
    ("At Risk", "r <= 2 AND f >= 3"),
    ("Lost", "r <= 2 AND f <= 2 AND m <= 2"),
    ("Hibernating", "r <= 3 AND f <= 2"),
)
NO_SEGMENT = "Others"

# The action text that goes with each segment.
SEGMENT_ACTIONS = {
    "Champions": "VIP treatment, early access to new products, upsell premium items",
    "Loyal Customers": "Cross-sell complementary products, loyalty rewards program",
    "Potential Loyalists": "Membership/loyalty program invite to increase frequency",
    "New Customers": "Onboarding sequence, first-purchase follow-up, education content",
    "At Risk": "Targeted win-back campaign with personalized offer before they're lost",
    "Cannot Lose Them": "Urgent high-touch outreach — high past value, going cold",
    "Hibernating": "Low-cost reactivation email, otherwise low priority",
    "Lost": "Win-back campaign only if CAC-justified; otherwise deprioritize",
    "Others": "Monitor — doesn't fit a clean pattern yet",
}


def segment(r: Column, f: Column, m: Column) -> Column:
    scores, met = {"r": r, "f": f, "m": m}, {">=": Column.__ge__, "<=": Column.__le__}
    labels = []
    for name, rule in SEGMENT_RULES:
        fits = F.lit(True)
        for score, sign, bound in (condition.split() for condition in rule.split(" AND ")):
            fits = fits & met[sign](scores[score], int(bound))
        labels.append(F.when(fits, name))
    return F.coalesce(*labels, F.lit(NO_SEGMENT))


def total_score() -> Column:
    return F.col("r_score") + F.col("f_score") + F.col("m_score")


# ---- NTILE form ----------------------------------------------------------------------------------------


def rfm_values(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return customer_facts(shop).select(
        "customer_id",
        F.datediff(analysis_day(shop, params), F.col("last_order")).alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.col("total_spend").alias("monetary"),
    )


MEASURES = ("recency_days", "frequency", "monetary")


def _past(values: DataFrame, measure: str, rows: list[Row], strictly: bool = False) -> Column:
    """How many of ``rows`` a customer reaches, or passes, in the order of the measure and the customer."""
    order = [measure, "customer_id"]
    here, at = F.struct(*order), [place(values, order, (r[measure], r["customer_id"])) for r in rows]
    return sum(((here > x if strictly else here >= x).cast("int") for x in at), F.lit(0))


def rfm_scores(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.shared("rfm-scores", lambda: _rfm_scores(shop, params), params)


def _rfm_scores(shop: Shop, params: Params) -> DataFrame:
    """NTILE scores, ties by customer_id: the first customer of each tile is looked up, and all are compared with these."""
    values, groups = written(rfm_values(shop, params), "rfm-values"), params.score_groups
    starts = tile_starts(values.count(), groups)
    first = selected(values, {m: [m, "customer_id"] for m in MEASURES}, dict.fromkeys(MEASURES, starts))
    tile = {m: 1 + _past(values, m, [first[m][r] for r in starts if r in first[m]]) for m in MEASURES}
    return values.select(
        "*", (groups + 1 - tile["recency_days"]).alias("r_score"), tile["frequency"].alias("f_score"), tile["monetary"].alias("m_score"),
    ).withColumn("rfm_total_score", total_score())


def _segmented(shop: Shop, params: Params) -> DataFrame:
    return rfm_scores(shop, params).withColumn(
        "rfm_segment", segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )


def rfm_segments(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return _segmented(shop, params).select(
        "customer_id", "recency_days", "frequency", F.round("monetary", 2).alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_segment",
    )


def segment_summary(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return _segmented(shop, params).groupBy("rfm_segment").agg(
        F.count("*").alias("num_customers"),
        mean_of(F.col("monetary"), 2).alias("avg_monetary"),
        F.round(F.sum("monetary"), 2).alias("total_monetary"),
    )


# ---- Quantile-edge form --------------------------------------------------------------------------------


def rfm_values_by_periods(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """As ``rfm_values``, recency in whole 24-hour periods before the reference midnight."""
    return customer_facts(shop).select(
        "customer_id",
        whole_days(reference_day(shop, params), F.col("last_stamp")).alias("recency_days"),
        F.col("total_orders").alias("frequency"),
        F.col("total_spend").alias("monetary"),
    )


def _edge_score(value: Column, edges: Column, groups: int) -> Column:
    """Number of the right-closed interval that holds ``value``; equal edges are an error."""
    same = [edges[f"e{i}"] >= edges[f"e{i + 1}"] for i in range(groups)]
    bad = same[0]
    for more in same[1:]:
        bad = bad | more
    score = F.when(bad, F.raise_error(F.lit("quantile edges are not unique")).cast("int"))
    for i in range(1, groups):
        score = score.when(value <= edges[f"e{i}"], i)
    return score.otherwise(groups)


def rfm_edge_scores(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.shared("rfm-edge-scores", lambda: _rfm_edge_scores(shop, params), params)


def _rfm_edge_scores(shop: Shop, params: Params) -> DataFrame:
    """Scores by quantile edges: equal values share a score, except for frequency, scored by its rank.

    The rows that the edges lie between are looked up; all customers are compared with the edges.
    """
    values, groups = written(rfm_values_by_periods(shop, params), "rfm-values"), params.score_groups
    total = values.count()
    points = [i / groups for i in range(groups + 1)]
    # The quantile edges of the ranks 1 … n are 1 + (n - 1) * i / groups.
    last = [(total - 1) * i // groups + 1 for i in range(1, groups)]
    rows = selected(
        values, {m: [m, "customer_id"] for m in MEASURES},
        {"recency_days": places_of(total, points), "monetary": places_of(total, points), "frequency": sorted(set(last))},
    )

    def score(measure: str) -> Column:
        edges = [F.lit(between(rows[measure], measure, total, p)).cast("double").alias(f"e{i}") for i, p in enumerate(points)]
        return _edge_score(F.col(measure).cast("double"), F.struct(*edges), groups)

    return values.select(
        "*", (groups + 1 - score("recency_days")).alias("r_score"),
        (1 + _past(values, "frequency", [rows["frequency"][r] for r in last if r in rows["frequency"]], strictly=True)).alias("f_score"),
        score("monetary").alias("m_score"),
    ).withColumn("rfm_total_score", total_score())


def rfm_edge_segments(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return rfm_edge_scores(shop, params).withColumn(
        "rfm_segment", segment(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    )


def edge_segment_summary(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return rfm_edge_segments(shop, params).groupBy("rfm_segment").agg(
        F.count("*").alias("num_customers"),
        mean_of(F.col("monetary"), 2).alias("avg_monetary"),
        F.round(F.sum("monetary"), 2).alias("total_monetary"),
        mean_of(F.col("recency_days"), 2).alias("avg_recency_days"),
        mean_of(F.col("frequency"), 2).alias("avg_frequency"),
    )


def segment_actions(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Every segment keeps its row; those without customers have nulls."""
    actions = shop.spark.createDataFrame(
        list(SEGMENT_ACTIONS.items()), "rfm_segment string, recommended_action string"
    )
    summary = edge_segment_summary(shop, params).select("rfm_segment", "num_customers", "total_monetary")
    return actions.join(summary, "rfm_segment", "left")
