"""Column arithmetic against the standard library's."""

import math

import pytest
from pyspark.sql import functions as F

from marketloom.functions.stats import two_sided_p
from marketloom.operators import experiments
from marketloom.sources.testdata import star_shop


def test_two_sided_p_over_a_grid(spark):
    grid = [k / 100 for k in range(-900, 901)] + [1e-12, 12.5, 37.0, 60.0, 1e300, math.inf, -math.inf]
    rows = spark.createDataFrame([(z,) for z in grid], "z double").select("z", two_sided_p(F.col("z")).alias("p")).collect()
    for z, p in rows:
        exact = math.erfc(abs(z) / math.sqrt(2))
        assert p == pytest.approx(exact, rel=1e-11, abs=1e-300), z


def test_two_sided_p_of_nothing(spark):
    rows = spark.createDataFrame([(None,), (math.nan,)], "z double").select(two_sided_p(F.col("z"))).collect()
    assert [r[0] for r in rows] == [None, None]


def test_no_python_worker_in_the_experiment_summary(spark, capsys):
    experiments.test_summary(star_shop(spark, "/root/testdata/sf0.001")).explain("formatted")
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "Python" not in plan
