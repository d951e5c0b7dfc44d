"""Compact evidence for reporting: first rows as JSON, size budget, question routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketloom.operators.ranking import running_totals
from marketloom.params import DEFAULTS, Params
from marketloom.plans.catalogue import VIEWS, in_order, view
from marketloom.shop import Shop

SECTIONS = ("ml_predictions", "ab_testing", "sql_analytics", "python_analytics")

# Words of a question and the sections that answer it.
ROUTES = (
    (("checkout", "experiment", "a/b", "ab test", "variant", "ship"), ("ab_testing",)),
    (("churn", "retention", "risk", "at-risk", "high risk"), ("ml_predictions", "python_analytics")),
    (
        ("rfm", "segment", "customer value", "clv", "loyal", "champion"),
        ("python_analytics", "sql_analytics", "ml_predictions"),
    ),
    (
        ("revenue", "sales", "aov", "order", "product", "category", "marketing", "cac", "funnel", "conversion",
         "cohort"),
        ("sql_analytics", "python_analytics"),
    ),
    (("forecast", "anomaly", "prediction", "predict"), ("python_analytics",)),
    (("growth", "strategy", "recommend", "opportunity", "what should"), SECTIONS),
)

ITEM_SCHEMA = "section string, item string, status string, ordinal int, row_json string, error string"


def row_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def first_rows(section: str, item: str, rows: int, build) -> list[tuple]:
    """At most ``rows`` JSON rows of ``build()``; an error becomes one row that says so."""
    try:
        df = build()
        texts = [r[0] for r in df.limit(rows).select(row_json(df)).collect()]
    except Exception as error:  # one broken result must not stop the others
        return [(section, item, "error", None, None, str(error).splitlines()[0])]
    if not texts:
        return [(section, item, "success", None, None, None)]
    return [(section, item, "success", i, text, None) for i, text in enumerate(texts, 1)]


def view_samples(shop: Shop, params: Params = DEFAULTS, views: tuple[str, ...] = tuple(VIEWS)) -> DataFrame:
    """The first rows of every view in its own order; bounded by views times rows."""
    lines: list[tuple] = []
    for view_id in views:
        lines += first_rows(
            "sql_analytics", VIEWS[view_id].name, params.evidence_rows, lambda v=view_id: view(shop, v, params)
        )
    return shop.spark.createDataFrame(lines, ITEM_SCHEMA)


def result_summary(df: DataFrame, params: Params = DEFAULTS, order: tuple[str, ...] = ()) -> DataFrame:
    """Row count, column names and the first rows in ``order`` as JSON, missing values as null.

    ``order`` is that of a view; rows that it leaves equal follow by all their values, so the sample is always the same.
    """
    first = in_order(df, (*order, *df.columns)).limit(params.sample_rows).select(row_json(df).alias("j"))
    numbered = first.withColumn("n", F.monotonically_increasing_id())
    sample = numbered.agg(F.array_sort(F.collect_list(F.struct("n", "j")))["j"].alias("sample")).scalar()
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count", F.array(*[F.lit(c) for c in df.columns]).alias("columns"), sample.alias("sample")
    )


def evidence_pack(spark: SparkSession, sections: dict[str, dict], params: Params = DEFAULTS) -> DataFrame:
    """``sections`` maps section -> item -> function giving a DataFrame in the order to be shown."""
    lines: list[tuple] = []
    for section, items in sections.items():
        for item, build in items.items():
            lines += first_rows(section, item, params.evidence_rows, build)
    return spark.createDataFrame(lines, ITEM_SCHEMA)


def within_budget(
    items: DataFrame, section: str, order: list[str], text: str, params: Params = DEFAULTS
) -> DataFrame:
    """Per section the leading items whose list, written as JSON, stays within the budget.

    A list of k items takes 2 characters for brackets and 2 per separator. Before an item is added only the list
    so far and the item itself are measured, hence one separator less. Lengths only grow, so the kept items are
    always a prefix; sections of any size are summed part by part.
    """
    summed = running_totals(
        items, [section], order, {"_chars": F.length(text).cast("bigint"), "_place": F.lit(1).cast("bigint")}
    )
    size = F.col("_chars") + 2 + 2 * F.greatest(F.col("_place") - 2, F.lit(0))
    return summed.filter(size <= params.evidence_budget).select(*items.columns)


def routed(questions: DataFrame, text: str) -> DataFrame:
    """Adds ``sections``, in fixed order; all of them where no word matches."""
    lowered = F.lower(text)

    def asks_for(section: str) -> Column:
        words = [w for group, targets in ROUTES if section in targets for w in group]
        found = lowered.contains(words[0])
        for word in words[1:]:
            found = found | lowered.contains(word)
        return F.when(found, section)

    matched = F.array_compact(F.array(*[asks_for(s) for s in SECTIONS]))
    everything = F.array(*[F.lit(s) for s in SECTIONS])
    return questions.withColumn("sections", matched).withColumn(
        "sections", F.when(F.size("sections") > 0, F.col("sections")).otherwise(everything)
    )
