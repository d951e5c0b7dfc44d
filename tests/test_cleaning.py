"""One hand-made dirty row per cleaning rule."""

import datetime as dt
from decimal import Decimal as D

import pytest

from marketloom.operators.cleaning import Cleaning, keep_first
from marketloom.schemas import raw_schema

RAW = {
    "customers": [
        ("C1", "Ann", "2024-01-05", " india ", "o'neil-town", "Mobile", " Email ", "VIP"),
        ("C1", "Ann", "2024-01-05", " india ", "o'neil-town", "Mobile", " Email ", "VIP"),
        ("C1", "Changed", "2024-01-06", "uk", "x", "Mobile", "Email", "VIP"),
        ("C2", "Bob", "01/31/2024", "usa", "nan", None, "Direct", "  "),
        ("C3", "Cid", "no date", "uae", "  ", "Tablet", "Direct", "New"),
        ("C4", "Dee", "2024-02-30", "UK", "rome", "Tablet", "Direct", "New"),
        ("C5", "Eve", "2024/02/29", "UK", "new  york", " Desktop", None, "New"),
    ],
    "products": [
        ("P1", "a", "home", "s", "b", "10.00", "20.00"), ("P1", "z", "home", "s", "b", "99.00", "20.00"),
        ("P2", "b", " Home", "s", "nan", "20.00", "0"), ("P3", "c", "HOME ", "s", "b", None, "-1"),
        ("P4", "d", "books", "s", "b", None, None), ("P5", "e", None, "s", "b", None, "5"),
        ("P6", "f", "   ", "s", "b", "40.00", "5"),
    ],
    "orders": [
        ("O1", "C1", "2024-03-01 10:00:00", "Completed", " UPI ", None, None),
        ("O1", "C1", "2024-03-02 10:00:00", "Pending", "UPI", "0.1", "5"),
        ("O2", "C9", "2024-03-01", "Completed", "COD", "0.1", "5"),
        ("O3", "C3", "2024-03-01", "Completed", "COD", "0.1", "5"),
        ("O4", "C2", "later", "Completed", "COD", "0.1", "5"),
        ("O5", "C2", "2024-03-01", "Lost", "COD", "0.1", "5"),
        ("O6", "C2", "2024-03-01", "Returned", None, "0.1", "5"),
        ("O7", "C2", "2024-03-01", "Pending", "net-banking", "0.25", "5.5"),
    ],
    "order_items": [
        ("I1", "O1", "P1", "2", "3.50"), ("I1", "O1", "P1", "9", "9.00"), ("I2", "O1", "P1", "0", "3.50"),
        ("I3", "O1", "P1", "-1", "3.50"), ("I4", "O2", "P1", "1", "3.50"), ("I5", "O1", "P9", "1", "3.50"),
        ("I6", "O6", "P4", "3", "0"),
    ],
    "payments": [
        ("Y1", "O1", "7.00", "Success", "2024-03-01"), ("Y2", "O1", "-0.01", "Success", "2024-03-01"),
        ("Y3", "O1", "0", "Failed", "2024-03-01"), ("Y4", "O2", "7", "Success", "2024-03-01"),
        ("Y5", "O1", "7", "Success", "never"), ("Y1", "O1", "8.00", "Success", "2024-03-01"),
    ],
    "returns": [
        ("R1", "O1", "C1", "P1", "2024-04-01", None, "7.00"), ("R1", "O1", "C1", "P1", "2024-04-02", "x", "1.00"),
        ("R2", "O4", "C2", "P1", "2024-04-01", "x", "7.00"), ("R3", "O1", "C1", "P1", "?", "x", "7.00"),
    ],
    "marketing_campaigns": [
        ("2024-01-01", "Email", "a", None, "100", "10", "1"), ("2024-01-01", "Email", "a", None, "100", "10", "1"),
        ("2024-01-01", "Email", "b", "5", "10", "11", "1"), ("2024-01-01", "Email", "c", "5", "100", "10", "11"),
        ("?", "Email", "d", "5", "100", "10", "1"), ("2024-01-01", "Email", "e", "5", None, "10", "1"),
    ],
    "web_events": [
        ("E1", "C1", "2024-01-01 00:00:01", "page_view", None, None),
        ("E1", "C1", "2024-01-01 00:00:02", "login", "S1", None),
        ("E2", "C1", "2024-01-01 00:00:01", "scroll", "S1", None),
        ("E3", "C3", "2024-01-01 00:00:01", "login", "S1", None), ("E4", "C1", "x", "login", "S1", None),
        ("E5", "C2", "2024-01-01 00:00:01", "wishlist", "S1", "P1"),
    ],
    "experiments": [
        ("X", "C1", "control", "2024-06-01", "1", "5.00"), ("X", "C1", "control", "2024-06-01", "1", "5.00"),
        ("X", "C2", "holdout", "2024-06-01", "0", "0"), ("X", "C3", "treatment", "soon", "0", "0"),
    ],
}


@pytest.fixture(scope="module")
def cleaning(spark):
    def raw(name):
        schema = raw_schema(name).add("_seq", "long")
        return spark.createDataFrame([(*row, i) for i, row in enumerate(RAW[name])], schema).repartition(4)

    return Cleaning(raw)


def rows(df, key):
    return [tuple(r) for r in df.orderBy(key).collect()]


def test_customers(cleaning):
    assert rows(cleaning.customers(), "customer_id") == [
        ("C1", "Ann", dt.date(2024, 1, 5), "India", "O'Neil-Town", "Mobile", "Email", "VIP"),
        ("C2", "Bob", dt.date(2024, 1, 31), "USA", "Unknown", "Unknown", "Direct", "Unclassified"),
        ("C5", "Eve", dt.date(2024, 2, 29), "UK", "New  York", "Desktop", None, "New"),
    ]


def test_products(cleaning):
    got = {r.product_id: r for r in cleaning.products().collect()}
    assert {k: r.cost for k, r in got.items()} == {
        "P1": D("10.00"), "P2": D("20.00"), "P3": D("15.00"),  # median of the category
        "P4": D("20.00"), "P5": D("20.00"), "P6": D("40.00"),  # overall median where the category has none
    }
    assert {k for k, r in got.items() if r.cost_is_estimated} == {"P3", "P4", "P5"}
    assert {k for k, r in got.items() if r.price_is_invalid} == {"P2", "P3"}
    assert (got["P2"].category, got["P5"].category, got["P6"].category) == ("Home", None, "")
    assert got["P2"].brand is None and got["P1"].product_name == "a"


def test_orders(cleaning):
    assert rows(cleaning.orders(), "order_id") == [
        ("O1", "C1", dt.datetime(2024, 3, 1, 10), "Completed", "Upi", D("0.0000"), D("0.00")),
        ("O6", "C2", dt.datetime(2024, 3, 1), "Returned", None, D("0.1000"), D("5.00")),
        ("O7", "C2", dt.datetime(2024, 3, 1), "Pending", "Net-Banking", D("0.2500"), D("5.50")),
    ]


def test_children_of_orders(cleaning):
    assert rows(cleaning.order_items(), "order_item_id") == [
        ("I1", "O1", "P1", 2, D("3.50"), D("7.00")), ("I6", "O6", "P4", 3, D("0.00"), D("0.00")),
    ]
    assert [r[:3] for r in rows(cleaning.payments(), "payment_id")] == [
        ("Y1", "O1", D("7.00")), ("Y3", "O1", D("0.00")),
    ]
    assert rows(cleaning.returns(), "return_id") == [
        ("R1", "O1", "C1", "P1", dt.date(2024, 4, 1), "Not Specified", D("7.00")),
    ]


def test_events_marketing_experiments(cleaning):
    assert [(r[0], r[3], r[4]) for r in rows(cleaning.web_events(), "event_id")] == [
        ("E1", "page_view", "UNKNOWN_SESSION"), ("E5", "wishlist", "S1"),
    ]
    assert rows(cleaning.marketing_campaigns(), "campaign") == [
        (dt.date(2024, 1, 1), "Email", "a", D("0.00"), 100, 10, 1),
    ]
    assert rows(cleaning.experiments(), "customer_id") == [
        ("X", "C1", "control", dt.date(2024, 6, 1), 1, D("5.00")),
    ]


def test_audit(cleaning):
    got = {r.table_name: (r.raw_rows, r.clean_rows) for r in cleaning.audit().collect()}
    assert got == {
        "customers": (7, 3), "products": (7, 6), "orders": (8, 3), "order_items": (7, 2), "payments": (6, 2),
        "returns": (4, 1), "marketing_campaigns": (6, 1), "web_events": (6, 2), "experiments": (4, 1),
    }


def test_keeping_the_first_is_idempotent_and_limits_map_tasks(cleaning):
    once = cleaning.raw("orders").transform(keep_first("order_id"))
    assert sorted(once.collect()) == sorted(once.transform(keep_first("order_id")).collect())
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_whole_numbers_in_any_spelling(spark):
    from marketloom.operators.cleaning import whole_number

    rows = spark.createDataFrame([("2",), ("2.0",), ("1e1",), ("-3.00",), ("2.5",), ("x",), (None,)], "n string")
    assert [r[0] for r in rows.select(whole_number("n", "int")).collect()] == [2, 2, 10, -3, None, None, None]
