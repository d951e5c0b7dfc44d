"""Churn features, labels, random forest, its evaluation, and risk lists."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions.dates import whole_days
from marketloom.operators.base import completed_orders, customer_facts, reference_day, with_row
from marketloom.operators.funnel import known_sessions, reached
from marketloom.operators.ranking import percentiles, running_totals, written
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

# Recency is left out: the label is made of it.
FEATURES = (
    "purchase_frequency", "total_spend", "avg_order_value", "number_of_sessions", "cart_abandonment", "returns",
    "discount_usage",
)
CLASSES = ("Active", "Churned")
RISK_BANDS = ("Low Risk", "Medium Risk", "High Risk")

SCORED_ROWS_PER_PART = 20_000
"""Rows that a task scores: they are few bytes but much work, so parts by size would be too few and uneven."""


# ---- Features and label --------------------------------------------------------------------------------


def buyers(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return customer_facts(shop).select("customer_id")


def order_habits(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Completed orders and the share of them with a discount, orders without items included."""
    discounted = F.coalesce(F.col("discount") > 0, F.lit(False)).cast("int")
    return completed_orders(shop).groupBy("customer_id").agg(
        F.count("*").alias("purchase_frequency"), F.avg(discounted).alias("discount_usage")
    )


def session_habits(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """Sessions and abandoned carts; events shrink to one row per customer and session first."""
    sessions = known_sessions(shop).groupBy("customer_id", "session_id").agg(
        reached("add_to_cart"), reached("purchase")
    )
    return sessions.groupBy("customer_id").agg(
        F.count("*").alias("number_of_sessions"),
        F.count_if((F.col("add_to_cart") == 1) & (F.col("purchase") == 0)).alias("cart_abandonment"),
    )


def return_habits(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return shop.returns.groupBy("customer_id").agg(F.count("*").alias("returns"))


def spend_habits(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return customer_facts(shop).select(
        "customer_id",
        whole_days(reference_day(shop, params), F.col("last_stamp")).alias("days_since_last_purchase"),
        "total_spend",
        (F.col("total_spend").cast("double") / F.col("total_orders")).alias("avg_order_value"),
    )


def churn_features(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    """One row per buyer. Every part is grouped by customer before it is joined, so no join meets a hot key."""
    joined = spend_habits(shop, params)
    for part in (order_habits(shop), session_habits(shop), return_habits(shop)):
        joined = joined.join(part, "customer_id", "left")
    return joined.fillna(0, ["number_of_sessions", "cart_abandonment", "returns"]).select(
        "customer_id", "days_since_last_purchase", *FEATURES,
        (F.col("days_since_last_purchase") > params.churn_days).cast("int").alias("churned"),
    )


# ---- Split, scaling, forest ----------------------------------------------------------------------------


def stratified_split(df: DataFrame, label: str, key: str, params: Params = DEFAULTS) -> DataFrame:
    """Adds ``is_test``: per label exactly the test share (half up), chosen by a seeded hash of the key."""
    draw = F.md5(F.concat_ws(":", F.col(key), F.lit(str(params.seed))))
    ranked = running_totals(df.withColumn("_draw", draw), [label], ["_draw", key], {"_rank": F.lit(1)})
    chosen = F.floor(F.col("_rank_all") * params.test_share + 0.5)
    return ranked.withColumn("is_test", F.col("_rank") <= chosen).select(*df.columns, "is_test")


def standardised(split: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Every row scaled by the training rows' mean and population deviation; a constant feature is centred."""
    figures = split.filter("NOT is_test").agg(
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in features],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"sigma_{c}") for c in features],
    )

    def scaled(c: str) -> Column:
        sigma = F.col(f"fit.sigma_{c}")
        return (F.col(c).cast("double") - F.col(f"fit.mean_{c}")) / F.when(sigma > 0, sigma).otherwise(1.0)

    return with_row(split, figures, "fit").withColumns({c: scaled(c) for c in features}).drop("fit")


@dataclass(frozen=True)
class ChurnForest:
    features: DataFrame
    split: DataFrame
    model: RandomForestClassificationModel

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows``, one per customer, with predicted class and probability of churn; they are counted first."""
        parts = max(1, math.ceil(rows.count() / SCORED_ROWS_PER_PART))
        rows = rows.repartition(parts, "customer_id")
        return self.model.transform(_assembled(rows)).select(
            *rows.columns, F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("churn_probability"),
        )

    def test_predictions(self) -> DataFrame:
        return self.scored(self.split.filter("is_test")).select(
            "customer_id", F.col("churned").alias("label"), "prediction", "churn_probability"
        )


def _assembled(rows: DataFrame) -> DataFrame:
    numbers = rows.withColumns({f"_{c}": F.col(c).cast("double") for c in FEATURES})
    return VectorAssembler(inputCols=[f"_{c}" for c in FEATURES], outputCol="features").transform(numbers)


def class_weights(train: DataFrame) -> DataFrame:
    """Adds ``weight``: rows / (2 * rows of the class)."""
    counts = train.agg(F.count("*").alias("n"), F.sum("churned").alias("churned"))
    of_class = F.when(F.col("churned") == 1, F.col("c.churned")).otherwise(F.col("c.n") - F.col("c.churned"))
    return with_row(train, counts, "c").withColumn("weight", F.col("c.n") / (2 * of_class)).drop("c")


def churn_forest(shop: Shop, params: Params = DEFAULTS) -> ChurnForest:
    features = written(churn_features(shop, params), "churn-features")
    split = written(stratified_split(features, "churned", "customer_id", params), "churn-split")
    train = class_weights(split.filter("NOT is_test"))
    # Bootstrapping draws per partition and row, hence a number, content and order of partitions that depend on the
    # rows only. Each tree level is one pass, so tiny partitions would cost more than they give.
    parts = max(1, math.ceil(train.count() / params.forest_rows_per_part))
    train = train.repartition(parts, "customer_id").sortWithinPartitions("customer_id")
    # Without cached node ids every level walks every row down every tree again from its root.
    forest = RandomForestClassifier(
        numTrees=params.forest_trees, maxDepth=params.forest_depth, seed=params.seed, labelCol="churned",
        weightCol="weight", maxMemoryInMB=1024, cacheNodeIds=True,
    )
    return ChurnForest(features, split, forest.fit(_assembled(train)))


def feature_importance(forest: ChurnForest) -> DataFrame:
    values = [float(v) for v in forest.model.featureImportances.toArray()]
    rows = sorted(zip(FEATURES, values), key=lambda pair: pair[1])
    return forest.features.sparkSession.createDataFrame(rows, "feature string, importance double")


# ---- Evaluation of (label, prediction, score) ----------------------------------------------------------


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    hits = predictions.groupBy("label").agg(
        *[F.count_if(F.col("prediction") == i).alias(f"predicted_{c.lower()}") for i, c in enumerate(CLASSES)]
    )
    actual = F.when(F.col("label") == 1, CLASSES[1]).otherwise(CLASSES[0])
    return hits.select(actual.alias("actual"), *[f"predicted_{c.lower()}" for c in CLASSES])


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages."""

    def count(label: int, prediction: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction)).cast("double")

    cells = predictions.agg(*[count(i, j).alias(f"c{i}{j}") for i in (0, 1) for j in (0, 1)])

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    c = {(i, j): F.col(f"c{i}{j}") for i in (0, 1) for j in (0, 1)}
    everything = c[0, 0] + c[0, 1] + c[1, 0] + c[1, 1]
    rates, supports = [], []
    for k in (0, 1):
        precision = share(c[k, k], c[0, k] + c[1, k])
        recall = share(c[k, k], c[k, 0] + c[k, 1])
        rates.append((precision, recall, share(2 * precision * recall, precision + recall)))
        supports.append(c[k, 0] + c[k, 1])
    accuracy = share(c[0, 0] + c[1, 1], everything)
    nothing = F.lit(None).cast("double")
    lines = [(CLASSES[k], *rates[k], supports[k]) for k in (0, 1)]
    lines.append(("accuracy", nothing, nothing, accuracy, everything))
    lines.append(("macro avg", *[(a + b) / 2 for a, b in zip(*rates)], everything))
    weighted = [share(a * supports[0] + b * supports[1], everything) for a, b in zip(*rates)]
    lines.append(("weighted avg", *weighted, everything))
    names = ("precision", "recall", "f1_score", "support")
    return cells.select(F.inline(F.array(*[
        F.struct(F.lit(title).alias("class"), *[v.alias(n) for n, v in zip(names, values)])
        for title, *values in lines
    ]))).withColumn("support", F.col("support").cast("bigint"))


def score_curve(predictions: DataFrame, score: str = "churn_probability") -> DataFrame:
    """Per distinct score, from the highest: positives and negatives at it and (``tp``, ``fp``) down to it."""
    tied = predictions.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    return running_totals(tied, [], [F.desc("score")], {"tp": F.col("pos"), "fp": F.col("neg")})


def roc_auc(predictions: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half."""
    right = F.col("neg").cast("decimal(18,0)") * (2 * F.col("tp") - F.col("pos")).cast("decimal(18,0)")
    pairs = F.max("tp_all").cast("double") * F.max("fp_all")
    return score_curve(predictions).agg((F.sum(right).cast("double") / (2 * pairs)).alias("roc_auc"))


def average_precision(predictions: DataFrame) -> DataFrame:
    """Sum over the distinct scores of recall gained times precision reached."""
    step = F.col("pos") / F.col("tp_all") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return score_curve(predictions).agg(F.sum(step).alias("average_precision"))


def roc_points(predictions: DataFrame) -> DataFrame:
    origin = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return score_curve(predictions).select(
        F.col("score").alias("threshold"),
        (F.col("fp") / F.col("fp_all")).alias("fpr"),
        (F.col("tp") / F.col("tp_all")).alias("tpr"),
    ).unionByName(origin)


def precision_recall_points(predictions: DataFrame) -> DataFrame:
    end = predictions.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return score_curve(predictions).select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.col("tp_all")).alias("recall"),
    ).unionByName(end)


# ---- Risk lists ----------------------------------------------------------------------------------------


def risk_bands(scored: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Right-closed bands; a probability of exactly 0 lies in none of them."""
    p = F.col("churn_probability")
    low, medium, high = RISK_BANDS
    band = (
        F.when(p <= 0, F.lit(None).cast("string"))
        .when(p <= params.risk_low, low).when(p <= params.risk_high, medium).when(p <= 1, high)
    )
    return scored.withColumn("risk_segment", band)


def priority_list(banded: DataFrame) -> DataFrame:
    """High-risk customers whose spend is above the median of all scored customers."""
    median = F.lit(percentiles(banded, {"total_spend": {"median": 0.5}})["total_spend"]["median"]).cast("double")
    return banded.filter(F.col("risk_segment") == RISK_BANDS[2]).filter(
        F.col("total_spend").cast("double") > median
    )


def model_evidence(banded: DataFrame, priority: DataFrame) -> DataFrame:
    """Counts as (item, customers): all scored, every band, the priority list."""
    everyone = banded.agg(F.count("*").alias("customers")).select(
        F.lit("customers_with_purchase_history").alias("item"), "customers"
    )
    bands = banded.groupBy("risk_segment").agg(F.count("*").alias("customers")).select(
        F.concat(F.lit("risk_segment: "), F.coalesce("risk_segment", F.lit("none"))).alias("item"), "customers"
    )
    urgent = priority.agg(F.count("*").alias("customers")).select(
        F.lit("high_value_high_risk_customers").alias("item"), "customers"
    )
    return everyone.unionByName(bands).unionByName(urgent)
