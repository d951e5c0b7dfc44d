"""Published ratios from their published counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions.numeric import percent, ratio
from marketloom.operators import churn, customers, experiments, funnel, marketing, sales
from marketloom.schemas import CLEAN
from marketloom.shop import Shop

FUNNEL = (123738, 80272, 43187, 20878, 8640)


@pytest.fixture(scope="module")
def funnel_shop(spark):
    reach = F.array(*[F.when(F.col("id") < n, F.lit(s)) for n, s in zip(FUNNEL, funnel.STAGES)])
    events = spark.range(FUNNEL[0]).select(
        F.concat(F.lit("S"), F.col("id")).alias("session_id"), F.lit("C1").alias("customer_id"),
        F.explode(F.array_compact(reach)).alias("event_name"),
    )
    noise = spark.range(1000).select(
        F.lit("UNKNOWN_SESSION").alias("session_id"), F.lit("C1").alias("customer_id"),
        F.lit("purchase").alias("event_name"),
    )
    return Shop.of_frames(spark, {"web_events": events.unionByName(noise)})


def test_funnel_steps(funnel_shop):
    assert tuple(funnel.sessions_per_stage(funnel_shop).first()) == FUNNEL
    assert tuple(funnel.step_conversion(funnel_shop).first())[5:] == (64.87, 53.80, 48.34, 41.38, 6.98)


def test_drop_off(funnel_shop):
    lost = {r.stage: r.sessions_lost for r in funnel.drop_off(funnel_shop).collect()}
    assert lost["page_view -> product_view"] == 43466
    assert lost["product_view -> add_to_cart"] == 37085
    assert lost["add_to_cart -> checkout"] == 22309
    assert lost["checkout -> purchase"] == 12238


def _buyers(spark, n, repeaters, churned):
    """n customers; the first ``repeaters`` order twice; the first ``churned`` last ordered 91 days before the end."""
    first = spark.range(n).select(
        F.concat(F.lit("C"), "id").alias("customer_id"), F.concat(F.lit("O"), "id").alias("order_id"),
        F.when(F.col("id") < churned, F.lit("2025-10-01")).otherwise(F.lit("2025-12-31"))
        .cast("timestamp_ntz").alias("order_date"),
    )
    again = first.limit(0).unionByName(
        spark.range(repeaters).select(
            F.concat(F.lit("C"), "id").alias("customer_id"), F.concat(F.lit("R"), "id").alias("order_id"),
            F.lit("2025-01-01").cast("timestamp_ntz").alias("order_date"),
        )
    )
    return Shop.of_frames(
        spark, {"orders": first.unionByName(again).withColumn("order_status", F.lit("Completed"))}
    )


def test_repeat_rate_and_churn_rate(spark):
    shop = _buyers(spark, 10436, 7210, 5384)
    assert tuple(customers.repeat_purchase_rate(shop).first()) == (10436, 7210, 69.09)
    assert tuple(churn.churn_rate(shop).first()) == (10436, 5384, 51.59)


def test_month_over_month(make_shop, orders_of):
    shop = make_shop(**orders_of(
        ("O1", "C1", "2023-01-05", 335487.13, 0.1), ("O2", "C1", "2023-02-05", 2690095.67, 0.75),
    ))
    rows = sales.month_over_month(shop).orderBy("order_month").collect()
    assert [float(r.net_revenue) for r in rows] == [301938.417, 672523.9175]
    assert [r.mom_growth_pct for r in rows] == [None, 122.74]


def test_channel_ratios(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    assert value(ratio(F.lit(5643688.65).cast("decimal(18,2)"), F.lit(1220), 2)) == 4625.97
    assert value(ratio(F.lit(65785.32).cast("decimal(18,2)"), F.lit(4625.97), 2, money=True)) == 14.22
    assert value(percent(F.lit(235257), F.lit(9341051), 3)) == 2.519
    assert value(ratio(F.lit(1), F.lit(0), 2)) is None
    assert value(ratio(F.lit(-1), F.lit(8), 2)) == -0.13  # half away from zero


def _experiment(spark, control, treatment, experiment="E"):
    """(n, conversions, revenue of all buyers together) per variant."""
    frames = []
    for variant, (n, conversions, revenue) in (("control", control), ("treatment", treatment)):
        frames.append(spark.range(n).select(
            F.lit(experiment).alias("experiment_id"), F.lit(variant).alias("variant"),
            (F.col("id") < conversions).cast("int").alias("converted"),
            F.when(F.col("id") == 0, revenue).otherwise(0).cast("decimal(12,2)").alias("revenue"),
        ))
    return frames[0].unionByName(frames[1])


def test_experiment_views_and_test(spark):
    shop = Shop.of_frames(spark, {"experiments": _experiment(
        spark, (3981, 467, 1000000.00), (4019, 563, 1308259.38)
    )})
    uplift = experiments.uplift(shop).first()
    assert (uplift.absolute_uplift_pct_points, uplift.relative_uplift_pct) == (2.28, 19.42)
    assert float(uplift.revenue_difference) == 308259.38
    row = experiments.test_summary(shop).first()
    assert (row.z_statistic, row.p_value, row.decision) == (3.041, 0.0024, "SHIP")
    assert (row.ci_95_lower_pct_points, row.ci_95_upper_pct_points) == (0.81, 3.74)
    assert row.statistically_significant and row.business_significant


def test_four_decisions(spark):
    cases = {
        "SHIP": ((4000, 400, 1), (4000, 600, 1)),
        "DO NOT SHIP (as-is)": ((400000, 40000, 1), (400000, 42000, 1)),
        "CONTINUE TEST": ((400, 40, 1), (400, 45, 1)),
        "DO NOT SHIP": ((400, 45, 1), (400, 40, 1)),
    }
    frame = None
    for name, sides in cases.items():
        part = _experiment(spark, *sides, experiment=name)
        frame = part if frame is None else frame.unionByName(part)
    shop = Shop.of_frames(spark, {"experiments": frame})
    assert {r.experiment_id: r.decision for r in experiments.decided(shop).collect()} == {n: n for n in cases}


def test_free_items_stay_out_of_order_value(make_shop, orders_of):
    tables = orders_of(("O1", "C1", "2023-01-05", 100), ("O2", "C1", "2023-01-06", 0))
    row = sales.average_order_value(make_shop(**tables)).first()
    assert (row.order_month, row.total_orders, row.aov) == (dt.date(2023, 1, 1), 1, 100.0)


def test_channels_without_revenue_keep_their_row(make_shop):
    shop = make_shop(marketing_campaigns=[
        {"date": "2023-01-01", "channel": "Email", "spend": 10, "impressions": 0, "clicks": 0, "conversions": 0}
    ])
    row = marketing.channel_performance(shop).first()
    assert row.channel == "Email" and row.ctr_pct is None and row.roas is None


def test_schemas_name_every_table():
    assert len(CLEAN) == 9
