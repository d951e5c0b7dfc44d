"""Segments, recency, gaps and pairs, where the rules are easy to get wrong."""

import datetime as dt
import itertools
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.functions.dates import epoch_micros, fill_days, parse_timestamp, whole_days
from marketloom.operators import anomaly, churn, products, rfm
from marketloom.params import Params


def expected_segment(r, f, m):
    table = [
        ("Champions", r >= 4 and f >= 4 and m >= 4), ("Loyal Customers", r >= 3 and f >= 3),
        ("New Customers", r >= 4 and f <= 2), ("Potential Loyalists", r >= 3 and f <= 3 and m >= 3),
        ("Cannot Lose Them", r <= 2 and f >= 4 and m >= 4), ("At Risk", r <= 2 and f >= 3),
        ("Lost", r <= 2 and f <= 2 and m <= 2), ("Hibernating", r <= 3 and f <= 2),
    ]
    return next((name for name, fits in table if fits), "Others")


def test_all_score_triples(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int")
    labels = df.select("*", rfm.segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert all(x.s == expected_segment(x.r, x.f, x.m) for x in labels)
    assert not any(x.s == "Others" for x in labels)


def test_edge_scores_equal_qcut(make_shop, orders_of):
    rng = np.random.default_rng(5)
    rows, n = [], 0
    for c in range(200):
        for _ in range(int(rng.integers(1, 6))):
            day = dt.datetime(2025, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 8000)))
            rows.append((f"O{n}", f"C{c:03}", day.isoformat(), int(rng.integers(1, 10**6)) / 100))
            n += 1
    shop = make_shop(**orders_of(*rows))
    params = Params(reference_date=dt.date(2025, 12, 31))
    mine = rfm.rfm_edge_scores(shop, params).toPandas().sort_values("customer_id").reset_index(drop=True)
    raw = pd.DataFrame(rows, columns=["o", "c", "at", "v"])
    raw["at"] = pd.to_datetime(raw["at"])
    g = raw.groupby("c").agg(at=("at", "max"), f=("o", "nunique"), m=("v", "sum")).reset_index()
    recency = (pd.Timestamp("2025-12-31") - g["at"]).dt.days
    assert list(mine.recency_days) == list(recency)
    assert list(mine.r_score) == list(pd.qcut(recency, 5, labels=[5, 4, 3, 2, 1]).astype(int))
    assert list(mine.f_score) == list(pd.qcut(g.f.rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int))
    assert list(mine.m_score) == list(pd.qcut(g.m, 5, labels=[1, 2, 3, 4, 5]).astype(int))


def test_repeated_edges_are_an_error(make_shop, orders_of):
    shop = make_shop(**orders_of(*[(f"O{i}", f"C{i}", "2025-01-01", 5) for i in range(10)]))
    with pytest.raises(Exception, match="edges are not unique"):
        rfm.rfm_edge_scores(shop).collect()


def test_whole_days_round_down(spark):
    cases = [
        ("2025-12-31 00:00:00", 0), ("2025-12-31 05:00:00", -1), ("2025-12-30 05:00:00", 0),
        ("2025-12-30 00:00:00", 1), ("2025-10-02 01:00:00", 89), ("2025-10-01 23:00:00", 90),
        ("2025-10-01 00:00:00", 91),
    ]
    df = spark.createDataFrame(cases, "t string, n int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert all(a == b for a, b in df.select(whole_days(F.lit(dt.date(2025, 12, 31)), F.col("t")), "n").collect())


def test_parsing_never_fails(spark):
    texts = ["2024-02-29", "2024-02-30", "2024/03/01", "03/04/2024", "2024-05-06 07:08:09", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_timestamp(F.col("t"))).collect()]
    assert got == [
        dt.datetime(2024, 2, 29), None, dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 4),
        dt.datetime(2024, 5, 6, 7, 8, 9), None, None,
    ]


def test_epoch_micros_ignores_time_zones(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-31 02:30:00.000001' AS t")
    expected = int((dt.datetime(2024, 3, 31, 2, 30) - dt.datetime(1970, 1, 1)).total_seconds()) * 10**6 + 1
    assert df.select(epoch_micros(F.col("t"))).first()[0] == expected


def test_calendar_has_no_gap(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 27), 5), (dt.date(2024, 3, 2), 7)], "d date, v int")
    assert [r.v for r in fill_days(df, "d", "v").orderBy("d").collect()] == [5, 0, 0, 0, 7]


def test_rolling_z_needs_rows_and_spread(spark):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 5) for i in range(20)]
    constant = anomaly.rolling_z(spark.createDataFrame(days, "d date, v int"), "d", "v")
    assert constant.filter("z_score IS NOT NULL OR is_anomaly").count() == 0
    short = [(d, i) for i, (d, _) in enumerate(days[:14])]
    assert anomaly.rolling_z(spark.createDataFrame(short, "d date, v int"), "d", "v").filter(
        "z_score IS NOT NULL").count() == 0
    spike = [(d, 100 if i == 19 else i % 2) for i, (d, _) in enumerate(days)]
    flagged = anomaly.flagged(anomaly.rolling_z(spark.createDataFrame(spike, "d date, v int"), "d", "v"))
    values = pd.Series([v for _, v in spike], dtype=float)
    z = ((values - values.rolling(30, min_periods=15).mean()) / values.rolling(30, min_periods=15).std()).iloc[-1]
    assert [r.z_score for r in flagged.collect()] == [pytest.approx(z)]


def test_gaps_within_days_between_days_and_repeated_times(make_shop, orders_of):
    rng = np.random.default_rng(3)
    stamps = [
        (f"C{int(rng.integers(0, 3))}", dt.datetime(2025, 1, 1) + dt.timedelta(hours=int(rng.integers(0, 400))))
        for _ in range(150)
    ]
    shop = make_shop(**orders_of(*[(f"O{i}", c, t.isoformat(), 1) for i, (c, t) in enumerate(stamps)]))
    counted = Counter({r.gap: r.n for r in churn.order_gaps(shop).collect()})
    expected = Counter()
    for customer in {c for c, _ in stamps}:
        times = sorted(t for c, t in stamps if c == customer)
        expected.update(int((b - a).total_seconds()) * 10**6 for a, b in zip(times, times[1:]))
    assert counted == expected
    days = np.array(sorted(expected.elements())) / 86_400_000_000
    row = churn.repurchase_interval(shop).first()
    assert row.median_repurchase_days == pytest.approx(np.median(days), abs=0.0501)
    assert row.avg_repurchase_days == pytest.approx(days.mean(), abs=0.0501)


@pytest.mark.parametrize("block", [2, 3, 512])
def test_pairs_equal_brute_force(make_shop, block):
    """One order holds a third of all lines; names are shared and lines repeated."""
    rng = np.random.default_rng(11)
    shelf = [{"product_id": f"P{i:02}", "product_name": f"N{i % 7}"} for i in range(15)]
    orders = [{"order_id": f"O{i}", "order_status": "Completed" if i % 4 else "Pending"} for i in range(1, 40)]
    lines = [("O1", f"P{int(rng.integers(0, 15)):02}") for _ in range(60)]
    lines += [(f"O{int(rng.integers(1, 40))}", f"P{int(rng.integers(0, 16)):02}") for _ in range(120)]
    shop = make_shop(
        products=shelf, orders=orders,
        order_items=[{"order_item_id": str(i), "order_id": o, "product_id": p} for i, (o, p) in enumerate(lines)],
    )
    names = {s["product_id"]: s["product_name"] for s in shelf}
    done = {o["order_id"] for o in orders if o["order_status"] == "Completed"}
    expected = Counter()
    for (o1, p1), (o2, p2) in itertools.product(lines, repeat=2):
        if o1 == o2 and o1 in done and p1 < p2 and p1 in names and p2 in names:
            expected[names[p1], names[p2]] += 1
    got = products.product_pairs(shop, Params(pair_block=block, pair_limit=1000)).collect()
    assert {(a, b): n for a, b, n in got} == {k: n for k, n in expected.items() if n >= 5}


def test_segments_for_other_numbers_of_groups(spark):
    from pyspark.sql import functions as F

    from marketloom.operators.rfm import segment

    rows = spark.createDataFrame([(10, 10, 10), (9, 1, 1), (1, 9, 9), (2, 2, 2), (1, 1, 9)], "r int, f int, m int")
    names = [r[0] for r in rows.select(segment(F.col("r"), F.col("f"), F.col("m"))).collect()]
    assert names == ["Champions", "New Customers", "Cannot Lose Them", "Lost", "Hibernating"]


def test_views_under_another_retention_month(spark):
    from marketloom import Params
    from marketloom.plans import catalogue
    from marketloom.sources.testdata import star_shop

    shop = star_shop(spark, "/root/testdata/sf0.001")
    assert "retention_month2_pct" in catalogue.view(shop, "D2", Params(retention_month=2)).columns
