"""Distributed ranks and percentiles against plain windows and numpy."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from marketloom.operators import ranking
from marketloom.operators.ranking import exact_percentiles, running_totals, selected, tile_starts


@pytest.fixture(params=["merged", "separate"], autouse=True)
def range_parts(spark, request):
    """Small data end up in one range; ``separate`` keeps all of them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param == "merged")
    yield
    spark.conf.unset(name)


@pytest.fixture(scope="module")
def values(spark):
    # A third of all rows share one value; two groups, one of them null.
    return spark.range(3001).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 211).alias("v"),
        F.when(F.col("id") % 5 > 1, "a").alias("g"),
    )


def test_ranges_are_kept_apart(spark, values, range_parts, request):
    summed = running_totals(values, [], ["v", "id"], {"rank": F.lit(1)})
    assert summed.agg(F.countDistinct("rank"), F.max("rank")).first()[:] == (3001, 3001)
    files = len({f for f in values.repartitionByRange("v", "id").select(F.spark_partition_id()).distinct().collect()})
    assert files > 1 or "merged" in request.node.name


def test_running_totals_equal_a_window(values):
    summed = running_totals(values, ["g"], ["v", "id"], {"total": F.col("v"), "rank": F.lit(1)})
    w = Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = values.select("*", F.sum("v").over(w).alias("total"), F.row_number().over(
        Window.partitionBy("g").orderBy("v", "id")).alias("rank"))
    columns = ["id", "g", "total", "rank"]
    assert sorted(map(repr, summed.select(*columns).collect())) == sorted(map(repr, plain.select(*columns).collect()))
    assert summed.filter("g = 'a'").agg(F.max("rank_all"), F.count("*")).first()[:] == (1800, 1800)


@pytest.mark.parametrize("rows", [1, 4, 5, 7, 23, 1000])
def test_tiles_equal_ntile(spark, rows):
    df = spark.range(rows).select(F.col("id").cast("string").alias("k"), (F.col("id") % 4).alias("v"))
    starts = tile_starts(rows, 5)
    first = selected(df, {"v": ["v", "k"]}, {"v": starts})["v"]
    tile = 1 + sum((F.struct("v", "k") >= ranking.place(df, ["v", "k"], (first[r].v, first[r].k))).cast("int") for r in starts if r in first)
    plain = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).alias("t"))
    assert sorted(df.select("k", (F.lit(0) + tile).alias("t")).collect()) == sorted(plain.collect())


def test_percentiles_equal_numpy(values):
    points = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    rows = {r.g: r for r in exact_percentiles(values, ["g"], "v", points).collect()}
    local = values.toPandas()
    for group in ("a", None):
        mine = local[local.g.isna() if group is None else local.g == group].v
        for name, p in points.items():
            assert rows[group][name] == pytest.approx(np.quantile(mine, p))


def test_percentiles_leave_nulls_out_and_take_weights(spark):
    df = spark.createDataFrame([(1, 3), (5, 1), (None, 9)], "v int, n int")
    assert exact_percentiles(df, [], "v", {"m": 0.5}, F.col("n")).first().m == 1.0
    assert exact_percentiles(df, [], "v", {"m": 0.5}).first().m == 3.0
