"""Rows at given ranks, found without sorting, against sorted tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import ranking
from marketloom.operators.ranking import percentiles, selected


@pytest.mark.parametrize("rows,bracket,sample", [(3001, 150, 40), (300, 10, 8), (300, 10_000, 20)])
def test_selected_equals_sorting(spark, monkeypatch, rows, bracket, sample):
    """Whatever the samples are like; two orders at once, with ties, nulls and a value that a third of all rows share."""
    monkeypatch.setattr(ranking, "BRACKET_ROWS", bracket)
    monkeypatch.setattr(ranking, "SAMPLE_ROWS", sample)
    df = spark.range(rows).select(
        F.concat(F.lit("k"), "id").alias("key"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 211).alias("v"),
        F.when(F.col("id") % 4 > 0, F.concat(F.lit("ü"), F.col("id") * 7 % 50)).alias("t"),
    ).persist()
    ranks = [1, 2, rows // 3, rows // 2, rows - 1, rows, rows + 1]
    found = selected(df, {"a": ["v", "key"], "b": ["t", "key"]}, {"a": ranks, "b": ranks})
    for name, order in (("a", ["v", "key"]), ("b", ["t", "key"])):
        plain = df.orderBy(*order).collect()
        assert {r: row.key for r, row in found[name].items()} == {r: plain[r - 1].key for r in ranks if r <= rows}


def test_percentiles_by_selection(spark, monkeypatch):
    values = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 211).alias("v")).persist()
    monkeypatch.setattr(ranking, "BRACKET_ROWS", 60)
    monkeypatch.setattr(ranking, "SAMPLE_ROWS", 30)
    points = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    found = percentiles(values, {"v": points, "id": points})
    local = values.toPandas()
    for column in ("v", "id"):
        assert found[column] == pytest.approx({name: np.quantile(local[column], p) for name, p in points.items()})
    weighted = spark.createDataFrame([(1, 3), (5, 1), (None, 9)], "v int, n int")
    assert percentiles(weighted, {"v": {"m": 0.5}}, "n") == {"v": {"m": 1.0}}
    assert percentiles(weighted.limit(0), {"v": {"m": 0.5}}) == {"v": {"m": None}}
