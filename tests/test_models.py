"""Split, evaluation, forest and forecast."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import churn_model, forecast
from marketloom.params import Params
from marketloom.plans.registry import _forest, rule_scores
from marketloom.sources.testdata import star_shop

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(1)
    label = rng.integers(0, 2, 400)
    score = np.round(np.clip(label * 0.2 + rng.random(400), 0, 1), 1)  # many ties
    rows = [(int(a), float(b), int(b > 0.5)) for a, b in zip(label, score)]
    return spark.createDataFrame(rows, "label int, churn_probability double, prediction int")


def test_auc_counts_pairs(scored):
    local = scored.toPandas()
    pos, neg = (local[local.label == k].churn_probability.to_numpy() for k in (1, 0))
    wins = (pos[:, None] > neg[None, :]).mean() + (pos[:, None] == neg[None, :]).mean() / 2
    assert churn_model.roc_auc(scored).first()[0] == pytest.approx(wins)


def test_average_precision_sums_steps(scored):
    local = scored.toPandas()
    total, before, result = local.label.sum(), 0.0, 0.0
    for cut in sorted(local.churn_probability.unique(), reverse=True):
        taken = local[local.churn_probability >= cut]
        recall = taken.label.sum() / total
        result += (recall - before) * taken.label.mean()
        before = recall
    assert churn_model.average_precision(scored).first()[0] == pytest.approx(result)


def test_curves_end_where_they_must(scored):
    roc = churn_model.roc_points(scored).orderBy("fpr", "tpr").collect()
    assert (roc[0].fpr, roc[0].tpr, roc[-1].fpr, roc[-1].tpr) == (0, 0, 1, 1)
    pr = churn_model.precision_recall_points(scored).orderBy("recall").collect()
    assert (pr[0].precision, pr[0].recall, pr[-1].recall) == (1, 0, 1)


def test_split_shares_are_exact_and_repeatable(spark):
    df = spark.range(1003).select(F.concat(F.lit("C"), "id").alias("customer_id"),
                                  (F.col("id") % 3 == 0).cast("int").alias("churned"))
    a, b = (churn_model.stratified_split(df, "churned", "customer_id").filter("is_test").collect() for _ in "ab")
    assert sorted(a) == sorted(b)
    sizes = {label: sum(r.churned == label for r in a) for label in (0, 1)}
    assert sizes == {0: 167, 1: 84}  # a quarter of 668 and of 335, half up
    other = churn_model.stratified_split(df, "churned", "customer_id", Params(seed=7)).filter("is_test").collect()
    assert sorted(a) != sorted(other)


def test_risk_bands_are_right_closed(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.01, 0.3, 0.31, 0.6, 0.61, 1.0)], "churn_probability double")
    got = [r.risk_segment for r in churn_model.risk_bands(df).orderBy("churn_probability").collect()]
    assert got == [None, "Low Risk", "Low Risk", "Medium Risk", "Medium Risk", "High Risk", "High Risk"]


def test_forest_on_the_test_tables(spark):
    forest = _forest(spark, FOLDER)
    assert len(forest.model.trees) == 200 and max(t.depth for t in forest.model.trees) <= 8
    predictions = forest.test_predictions()
    assert 0 <= churn_model.roc_auc(predictions).first()[0] <= 1
    assert churn_model.feature_importance(forest).agg(F.sum("importance")).first()[0] == pytest.approx(1)


def test_forest_separates_and_repeats(spark):
    rows = spark.range(400).select(
        F.concat(F.lit("C"), F.col("id")).alias("customer_id"), (F.col("id") % 2).cast("int").alias("churned"),
        *[((F.col("id") % 2) * 5 + F.col("id") % 7).cast("double").alias(c) for c in churn_model.FEATURES],
    )
    split = churn_model.stratified_split(rows, "churned", "customer_id")
    train = churn_model.class_weights(split.filter("NOT is_test"))
    assert train.agg(F.sum("weight")).first()[0] == pytest.approx(train.count())

    def probabilities():
        from pyspark.ml.classification import RandomForestClassifier

        ordered = train.repartition(4, "customer_id").sortWithinPartitions("customer_id")
        model = RandomForestClassifier(numTrees=20, maxDepth=8, seed=42, labelCol="churned", weightCol="weight").fit(
            churn_model._assembled(ordered))
        forest = churn_model.ChurnForest(rows, split, model)
        return sorted(forest.test_predictions().collect()), churn_model.roc_auc(forest.test_predictions()).first()[0]

    (first, auc), (second, _) = probabilities(), probabilities()
    assert first == second and auc > 0.9


def test_forecast_equals_least_squares(make_shop, orders_of):
    rng = np.random.default_rng(2)
    start = dt.date(2023, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(500)]
    kept = [(i, d) for i, d in enumerate(days) if i in (0, 499) or rng.random() < 0.9]
    revenue = {d: round(1000 + 3 * i + 50 * d.weekday() + float(rng.integers(0, 100)), 2) for i, d in kept}
    shop = make_shop(**orders_of(*[(f"O{i}", "C1", f"{d}T12:00:00", revenue[d]) for i, d in kept]))
    result = forecast.revenue_forecast(shop)

    def design(dates, first_index):
        return np.array([
            [1, first_index + i] + [d.weekday() == k for k in range(1, 7)] + [d.month == m for m in range(2, 13)]
            for i, d in enumerate(dates)
        ], dtype=float)

    y = np.array([revenue.get(d, 0.0) for d in days])
    x = design(days, 0)
    part = np.linalg.lstsq(x[:-60], y[:-60], rcond=None)[0]
    held = [r.prediction for r in result.backtest.orderBy("order_day").collect()]
    assert held == pytest.approx(list(x[-60:] @ part), rel=1e-6)
    sigma = (y[-60:] - x[-60:] @ part).std()
    assert forecast.error_deviation(result.backtest).first()[0] == pytest.approx(sigma, rel=1e-6)
    full = np.linalg.lstsq(x, y, rcond=None)[0]
    ahead = np.maximum(design([days[-1] + dt.timedelta(days=i) for i in range(1, 91)], 500) @ full, 0)
    future = result.future.orderBy("order_day").collect()
    assert [r.forecast_revenue for r in future] == pytest.approx(list(ahead), rel=1e-6)
    assert [r.lower_bound for r in future] == pytest.approx(list(np.maximum(ahead - 1.96 * sigma, 0)), rel=1e-6)
    totals = forecast.forecast_totals(result.future).first()
    assert tuple(totals) == pytest.approx((ahead[:30].sum(), ahead[:60].sum(), ahead.sum()), rel=1e-6)


def test_priority_list_is_above_the_median(spark):
    banded = churn_model.risk_bands(rule_scores(star_shop(spark, FOLDER)))
    listed = churn_model.priority_list(banded).toPandas()
    everyone = banded.toPandas()
    assert (listed.risk_segment == "High Risk").all()
    assert (listed.total_spend.astype(float) > everyone.total_spend.astype(float).median()).all()


def test_forest_caches_node_ids_and_deals_scoring(spark, monkeypatch):
    """Cached node ids leave the trees as they are; scoring is dealt by rows, not by the bytes of the stored features."""
    real, given = churn_model.RandomForestClassifier, []

    def fitted(**more):
        monkeypatch.setattr(churn_model, "RandomForestClassifier", lambda **options: given.append(options) or real(**options | more))
        return churn_model.churn_forest(star_shop(spark, FOLDER), Params(forest_trees=20))

    cached, plain = fitted(), fitted(cacheNodeIds=False)
    assert given[0]["cacheNodeIds"]
    trees = lambda forest: [t.toDebugString.split("\n", 1)[1] for t in forest.model.trees]
    assert trees(cached) == trees(plain)
    monkeypatch.setattr(churn_model, "SCORED_ROWS_PER_PART", 10)
    scored = cached.scored(cached.features)
    assert scored.rdd.getNumPartitions() == -(-cached.features.count() // 10)
    assert scored.count() == cached.features.count()
