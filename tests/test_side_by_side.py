"""Independent tables are stored side by side, and the short cuts of the rules give what the rules say."""

import threading

import pytest
from pyspark.sql import functions as F

from marketloom.functions.dates import DATE_SPELLINGS, parse_timestamp
from marketloom.functions.text import strip, title_case
from marketloom.operators.cleaning import Cleaning, whole_number
from marketloom.operators.ranking import written
from marketloom.schemas import TABLES, raw_schema
from marketloom.session import side_by_side
from marketloom.sources import files
from marketloom.sources.testdata import cents
from tests.test_cleaning import RAW


def raw_reader(spark, asked):
    def raw(name):
        asked.append(name)
        schema = raw_schema(name).add("_seq", "long")
        return spark.createDataFrame([(*row, i) for i, row in enumerate(RAW[name])], schema)

    return raw


def test_tables_without_parents_are_stored_side_by_side(spark):
    meet, asked = threading.Barrier(4, timeout=60), []

    def keep(df, name):
        if name in ("customers", "products", "marketing_campaigns", "experiments"):
            meet.wait()  # four at a time, or an error
        return written(df, name)

    cleaning = Cleaning(raw_reader(spark, asked)).keeping(keep)
    got = {r.table_name: r.clean_rows for r in cleaning.audit().collect()}
    assert got == {
        "customers": 3, "products": 6, "orders": 3, "order_items": 2, "payments": 2, "returns": 1, "marketing_campaigns": 1,
        "web_events": 2, "experiments": 1,
    }
    # Once to clean and once to count, also what is a parent.
    assert sorted(asked) == sorted(2 * TABLES)


def test_rules_are_counted_side_by_side(spark):
    meet = threading.Barrier(2, timeout=60)

    def keep(df, name):
        if name in ("customers", "products"):
            meet.wait()
        return written(df, name)

    own = spark.newSession()
    lines = Cleaning(raw_reader(own, [])).keeping(keep, counting=True).rule_audit(spark).collect()
    items = [(r.rule, r.rows_in, r.rows_out) for r in lines if r.table_name == "order_items"]
    assert items == [("C2", 7, 6), ("C9", 6, 5), ("C9", 5, 4), ("C14", 4, 2)]


def test_files_are_loaded_side_by_side(spark, monkeypatch, tmp_path):
    meet = threading.Barrier(2, timeout=60)

    def read(session, path, table):
        meet.wait()
        return session.createDataFrame([], files.CLEAN[table])

    monkeypatch.setattr(files, "read_clean_csv", read)
    files.load_tables(spark, "unread", str(tmp_path), ("customers", "orders"))


def test_an_error_in_one_of_several_is_raised():
    with pytest.raises(ZeroDivisionError):
        side_by_side(lambda x: 1 // x, [1, 0, 2])


@pytest.mark.parametrize("text", ["a\nb", "a\rb"])
def test_line_breaks_are_refused(spark, tmp_path, text):
    with pytest.raises(Exception, match="holds a line break"):
        files.write_csv(spark.createDataFrame([(text,), ("plain",)], "t string"), str(tmp_path / "out"))


def test_short_cuts_give_what_the_rules_say(spark):
    texts = [
        None, "", " ", " a b ", "o'neil-town", "new  york", "ÉCOLE été", "a1b", "\t x\n", "2024/02/29", "02/29/2024", "2024-02-29 10:00:00", "/",
        "2", " 2 ", "+2", "-2", "2.0", "2.", "2e0", "2.5", "99999999999", "1e400", "x", "ab ", "1_000",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    respelled = F.col("t")
    for pattern, iso in DATE_SPELLINGS:
        respelled = F.regexp_replace(respelled, pattern, iso)
    exact = F.col("t").try_cast("decimal(38,9)")
    runs = F.transform(F.regexp_extract_all("t", F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1)), F.initcap)
    pairs = {
        "strip": (strip(F.col("t")), F.regexp_replace("t", r"^\s+|\s+$", "")),
        "title": (title_case(F.col("t")), F.array_join(runs, "")),
        "time": (parse_timestamp(F.col("t")), respelled.try_cast("timestamp_ntz")),
        "int": (whole_number("t", "int"), F.when(exact == F.floor(exact), exact).try_cast("int")),
        "bigint": (whole_number("t", "bigint"), F.when(exact == F.floor(exact), exact).try_cast("bigint")),
    }
    for name, (short, plain) in pairs.items():
        assert [r for r in rows.select("t", short.alias("a"), plain.alias("b")).collect() if r.a != r.b] == [], name


def test_cents_are_rounded_half_up(spark):
    values = [None, 0.0, 0.005, 0.015, 1.005, 2.675, -0.005, -1.115, 10.0, 901.0, 0.00499999999, 45036.99, 1e15, 3.125, -3.125]
    rows = spark.createDataFrame([(v,) for v in values], "x double").selectExpr("x", f"{cents('x')} AS a", "cast(round(x * 100) AS bigint) AS b")
    assert [r for r in rows.collect() if r.a != r.b] == []
