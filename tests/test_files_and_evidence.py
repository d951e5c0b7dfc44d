"""Files, views by name, evidence."""

import json

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql
from marketloom.operators import base, evidence, sales
from marketloom.operators.cleaning import Cleaning
from marketloom.operators.ranking import written
from marketloom.params import Params
from marketloom.plans import catalogue, jobs, registry
from marketloom.schemas import CLEAN, TABLES
from marketloom.shop import Shop
from marketloom.sources import files
from marketloom.sources.rawdata import RawTables
from marketloom.sources.testdata import star_shop
from tools.compare import compare, database

FOLDER = "/root/testdata/sf0.001"


def test_clean_files_show_a_change_in_any_column(spark):
    db = database(FOLDER)
    assert compare(spark, db, "S2_columns", FOLDER, oracle_sql()["S2_columns"]) == f"ok ({sum(len(CLEAN[t]) + 1 for t in TABLES)})"
    shop = star_shop(spark, FOLDER).keeping(written)

    def digests(table: str, column: str, change) -> set:
        def read(name):
            df = shop.table(name)
            return df.withColumn(column, change(F.col(column))) if name == table else df.limit(0)

        found = registry._column_digests(Shop(spark, read)).where(F.col("table_name") == table).collect()
        return {tuple(r) for r in found}

    for table, column in (("order_items", "unit_price"), ("products", "brand")):
        same, other = digests(table, column, lambda c: c), digests(table, column, lambda c: F.when(c != F.lit("0"), c))
        lost = digests(table, column, lambda c: F.lit(None).cast(CLEAN[table][column].dataType))
        assert {r[1] for r in same - lost} == {column, "*"} and (same == other) == (column == "brand")


def test_raw_csv_keeps_order_and_nulls(spark, tmp_path):
    text = "customer_id,customer_name,signup_date,country,city,device,acquisition_channel,customer_segment\n"
    text += 'C1,"a, ""b""",2024-01-01,NULL,nan,N/A,x,"two words"\n' + "C1,late,2024-01-01,a,b,c,d,e\n"
    (tmp_path / "customers.csv").write_text(text)
    df = files.read_raw_csv(spark, str(tmp_path), "customers")
    first = df.orderBy("_seq").first()
    assert first.customer_name == 'a, "b"' and first.customer_segment == "two words"
    assert first.country is None and first.city is None and first.device is None
    assert Cleaning(lambda _: df).customers().first().customer_name == 'a, "b"'


def test_clean_csv_round_trip_and_bad_types(spark, tmp_path):
    shop = star_shop(spark, FOLDER)
    for table in TABLES:
        files.write_csv(shop.table(table).select(*CLEAN[table].names), f"{tmp_path}/csv/{table}")
    loaded = files.load_tables(spark, f"{tmp_path}/csv", f"{tmp_path}/parquet")
    for table in ("orders", "web_events", "products"):
        assert sorted(map(repr, loaded.table(table).collect())) == sorted(map(repr, shop.table(table).collect()))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.csv").write_text("date,channel,campaign,spend,impressions,clicks,conversions\nx,,,,,,\n")
    with pytest.raises(Exception):
        files.read_clean_csv(spark, str(tmp_path / "bad"), "marketing_campaigns").collect()


def test_laid_out_facts(spark, tmp_path, make_shop, capsys):
    """A period reads its own months only; orders meet their items without a shuffle; nothing is lost on the way."""
    stamps = {"O1": "2024-01-31 23:59:59", "O2": "2024-02-01 00:00:00", "O3": "2024-03-05 10:00:00", "O4": None}
    orders = [{"order_id": o, "customer_id": "C1", "order_date": t, "order_status": "Completed"} for o, t in stamps.items()]
    items = [
        {"order_item_id": f"{o}-{n}", "order_id": o, "product_id": "P1", "quantity": 1, "unit_price": 2, "line_total": 2}
        for o in [*stamps, "absent", None] for n in range(3)
    ]
    # The repeated order's items must not be repeated.
    small = make_shop(orders=orders + orders[:1], order_items=items)
    facts = files.lay_out(small, f"{tmp_path}/small", "small", buckets=3)
    for table in ("orders", "order_items"):
        assert sorted(map(repr, facts.shop().table(table).collect())) == sorted(map(repr, small.table(table).collect()))
    ids = lambda shop: sorted({r.order_id for r in shop.order_items.collect()})
    assert ids(facts.shop("2024-02", "2024-02")) == ["O2"] and ids(facts.shop(last_month="2024-02")) == ["O1", "O2"]
    assert facts.shop("2025-01").orders.count() == 0

    shop = star_shop(spark, FOLDER)
    facts = files.lay_out(shop, f"{tmp_path}/facts", "facts", buckets=2)
    whole = sales.monthly_revenue(shop).where("order_month between '1996-03-01' and '1996-05-01'").collect()
    period = facts.shop("1996-03", "1996-05")
    capsys.readouterr()
    # Sizes are small here: without this the join would broadcast instead of using the buckets.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base.order_facts(period).explain("formatted")
        assert sorted(sales.monthly_revenue(period).collect()) == sorted(whole) and len(whole) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plan = capsys.readouterr().out
    assert plan.count("PartitionFilters: [isnotnull(order_month") == 2 and "Exchange" not in plan


def test_whole_run(spark, tmp_path):
    raw = RawTables(spark, FOLDER)
    for table in TABLES:
        files.write_csv(raw.table(table).drop("_seq"), f"{tmp_path}/raw/{table}")
    shop = jobs.clean_files(spark, f"{tmp_path}/raw", f"{tmp_path}/clean")
    direct = Cleaning(raw.table)
    for table in TABLES:
        assert shop.table(table).count() == direct.table(table).count(), table
    names = jobs.write_analyses(shop, f"{tmp_path}/results", Params(forest_trees=5))
    assert len(names) == 13
    summary = spark.read.csv(f"{tmp_path}/results/ab_test_summary", header=True)
    assert {"z_statistic", "p_value", "decision"} <= set(summary.columns) and summary.count() == 1
    assert spark.read.csv(f"{tmp_path}/results/revenue_forecast_90days", header=True).count() == 90


def test_views_answer_sql(spark):
    shop = star_shop(spark, FOLDER).keeping(written)
    names = catalogue.register_views(shop)
    assert len(names) == 40
    months = [r.order_month for r in spark.sql("SELECT * FROM vw_a2_monthly_revenue").collect()]
    assert months == sorted(months) and len(months) > 12
    monetary = [r.monetary for r in spark.sql("SELECT * FROM vw_e3_full_rfm_segmentation LIMIT 20").collect()]
    assert monetary == sorted(monetary, reverse=True)


def test_one_broken_view_does_not_stop_the_rest(spark):
    good = star_shop(spark, FOLDER)

    def read(name):
        if name == "web_events":
            raise RuntimeError("no such table")
        return good.table(name)

    got = evidence.view_samples(Shop(spark, read), Params(evidence_rows=3), ("B1", "C1v", "H4")).collect()
    assert {(r.item, r.status) for r in got} == {
        ("vw_b1_new_customers_per_month", "success"),
        ("vw_c1_overall_funnel_sessions_reaching_each_stage", "error"),
        ("vw_h4_return_reasons_breakdown", "success"),
    }
    first = [r for r in got if r.item.startswith("vw_b1")]
    assert [r.ordinal for r in first] == [1, 2, 3]
    assert set(json.loads(first[0].row_json)) == {"signup_month", "new_customers"}


def test_summary_shows_missing_values_as_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    row = evidence.result_summary(df).first()
    assert row.row_count == 2 and row.columns == ["a", "b"] and len(row["sample"]) == 2
    assert {"a": 1, "b": None} in [json.loads(s) for s in row["sample"]]
    many = spark.createDataFrame([(k % 7, str(k)) for k in range(100)], "a int, b string").repartition(5)
    row = evidence.result_summary(many, Params(sample_rows=30), ("-a",)).first()
    expected = sorted(((k % 7, str(k)) for k in range(100)), key=lambda r: (-r[0], r[1]))[:30]
    assert row.row_count == 100 and [tuple(json.loads(s).values()) for s in row["sample"]] == expected


@pytest.mark.parametrize("budget", [0, 2, 40, 41, 100, 333, 10_000])
def test_budget_keeps_the_prefix_that_fits(spark, budget):
    texts = [f"{i:0{5 + i % 9}d}" for i in range(40)]
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)] + [("t", 0, "x")], "s string, i int, t string")
    kept = evidence.within_budget(df, "s", ["i"], "t", Params(evidence_budget=budget)).filter("s = 's'").collect()
    result = []
    for text in texts:
        # the list so far as JSON (brackets and ", " between) plus the item
        if 2 + sum(map(len, result)) + 2 * max(len(result) - 1, 0) + len(text) > budget:
            break
        result.append(text)
    assert [r.t for r in sorted(kept, key=lambda r: r.i)] == result


def test_routes(spark):
    questions = {
        "Should we SHIP the new page?": ["ab_testing"],
        "Who will churn?": ["ml_predictions", "python_analytics"],
        "Which rfm group?": ["ml_predictions", "sql_analytics", "python_analytics"],
        "Revenue last month": ["sql_analytics", "python_analytics"],
        "forecast please": ["python_analytics"],
        "What should we do?": list(evidence.SECTIONS),
        "Hello": list(evidence.SECTIONS),
    }
    df = spark.createDataFrame([(q,) for q in questions], "q string")
    assert {r.q: r.sections for r in evidence.routed(df, "q").collect()} == questions


def test_csv_keeps_padding_and_refuses_line_breaks(spark, tmp_path):
    import pytest

    from marketloom.sources import files

    rows = spark.createDataFrame([("  a b ", "x"), ("q\"t,", "")], "left string, right string")
    files.write_csv(rows, f"{tmp_path}/padded")
    back = spark.read.options(header=True, escape='"').csv(f"{tmp_path}/padded")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect())) or {r[0] for r in back.collect()} == {"  a b ", "q\"t,"}
    broken = spark.createDataFrame([("x\ny",)], "left string")
    with pytest.raises(Exception, match="line break"):
        files.write_csv(broken, f"{tmp_path}/broken")
    files.write_csv(broken, f"{tmp_path}/lines", multi_line=True)
    assert spark.read.options(header=True, escape='"', multiLine=True).csv(f"{tmp_path}/lines").first()[0] == "x\ny"


def test_malformed_records(spark, tmp_path):
    """Surplus and missing fields are set aside with their text; quoted separators and empty fields are none."""
    folder = tmp_path / "raw" / "payments"
    folder.mkdir(parents=True)
    good = ["P1,O1,5.00,Success,2024-01-01 00:00:00", 'P2,"O,2",,"a ""b"", c",', ",,,,"]
    bad = {"P3,O1,5.00": "missing fields", "P4,O1,5.00,Success,2024-01-01 00:00:00,more": "surplus fields", 'P5,"a,b",1,x': "missing fields"}
    (folder / "one.csv").write_text("\n".join(["payment_id,order_id,amount,payment_status,payment_date", *good, *bad]) + "\n")
    rows = files.read_raw_csv(spark, str(folder), "payments")
    assert rows.count() == 3
    assert [r.order_id for r in rows.orderBy("_seq").collect()] == ["O1", "O,2", None]
    found = files.quarantine(spark, str(tmp_path / "raw"), str(tmp_path / "quarantine"), ["payments"])
    assert {r.text: r.reason for r in found.collect()} == bad
    assert {r.table_name for r in found.collect()} == {"payments"}
    assert all(r.file.endswith("one.csv") for r in found.collect())


def test_laid_out_by_many_tasks(spark, tmp_path):
    """Rows are written by month and bucket, not by bucket alone, and still as one file for each."""
    # Sizes are small here: without this one task would get all parts.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.lay_out(star_shop(spark, FOLDER), f"{tmp_path}/facts", "dealt_facts", buckets=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for table in ("orders", "order_items"):
        stored = list((tmp_path / "facts" / table).glob("order_month=*/*.parquet"))
        assert len({f.parent for f in stored}) == len(stored)
        # A file's name begins with part- and its task.
        assert len({f.name.split("-")[1] for f in stored}) > 1


def test_views_share_what_they_have_in_common(spark):
    """In a keeping shop customers, sessions and channels are added up once for all views."""
    kept = []
    shop = star_shop(spark, FOLDER).keeping(lambda df, name: kept.append(name) or written(df, name))
    plain = star_shop(spark, FOLDER)
    rows = lambda df: sorted(map(repr, df.collect()))
    for view_id in ("F1", "F2", "F3", "F4", "C1v", "C2v", "C3v", "C4v", "C5v", "G2", "G3"):
        run = catalogue.VIEWS[view_id].run
        assert rows(run(shop)) == rows(run(plain)), view_id
    shared = {"customer-facts", "visits", "channel-totals", "channel-sales", "last-day"}
    assert shared <= set(kept) and len(kept) == len(set(kept))
