"""The cleaning run that counts rules leaves little on disk: no shuffle files, one part of a large table at a time."""

import threading
import time

from __spark_entry__ import queries
from marketloom.operators import cleaning as rules
from marketloom.operators.cleaning import CHILDREN, Cleaning
from marketloom.operators.ranking import written
from marketloom.schemas import TABLES, raw_schema
from marketloom.session import frugal_session
from marketloom.sources.rawdata import star_cleaning
from tests.test_cleaning import RAW

FOLDER = "/root/testdata/sf0.001"


def raw_reader(spark):
    def raw(name):
        # More rows of some keys, far apart, and rows without a key.
        lines = RAW[name] + [(None, *row[1:]) for row in RAW[name][:2]] + RAW[name]
        return spark.createDataFrame([(*row, i) for i, row in enumerate(lines)], raw_schema(name).add("_seq", "long")).repartition(4)

    return raw


def in_three(name, raw):
    return 3 if name in ("orders", "order_items") else 1


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {path for path in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in path}


def test_parts_make_up_the_tables(spark):
    stored, lock = {}, threading.Lock()

    def keep(df, name):
        with lock:
            stored.setdefault(name, []).append(kept := written(df, name))
        return kept

    own = frugal_session(spark)
    in_parts = Cleaning(raw_reader(own)).keeping(keep, counting=True, parts=in_three)
    whole = Cleaning(raw_reader(own)).keeping(written, counting=True)
    assert sorted(in_parts.rule_audit(spark).collect()) == sorted(whole.rule_audit(spark).collect())
    assert {name: len(parts) for name, parts in stored.items()} == {name: in_three(name, None) for name in TABLES}
    for name in TABLES:
        assert sorted(map(repr, in_parts.table(name).collect())) == sorted(map(repr, whole.table(name).collect())), name
    assert sum(part.count() > 0 for part in stored["orders"]) > 1


def test_children_are_stored_one_after_another(spark):
    at_work, most, lock = set(), [], threading.Lock()

    def keep(df, name):
        with lock:
            at_work.add(name)
            most.append(len(at_work & set(CHILDREN)))
        kept = written(df, name)
        with lock:
            at_work.remove(name)
        return kept

    Cleaning(raw_reader(frugal_session(spark))).keeping(keep, parts=in_three).tables()
    assert max(most) == 1


def test_only_large_tables_are_stored_in_parts(spark, monkeypatch):
    raw = star_cleaning(spark, FOLDER).raw("order_items")
    assert rules.in_parts("order_items", raw) == 1
    monkeypatch.setattr(rules, "PART_BYTES", 1)
    assert rules.in_parts("order_items", raw) == rules.PARTS["order_items"] > 1
    assert rules.in_parts("returns", star_cleaning(spark, FOLDER).raw("returns")) == 1


def test_rules_are_counted_alike_in_parts_and_leave_no_shuffle_files(spark, monkeypatch):
    whole = sorted(queries()["C18_rules"](spark, FOLDER).collect())
    monkeypatch.setattr(rules, "PART_BYTES", 1)
    before = shuffle_files(spark)
    assert sorted(queries()["C18_rules"](spark, FOLDER).collect()) == whole
    until = time.time() + 30  # files are removed in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_shuffle_partitions_are_those_of_the_given_session(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "11")
    assert frugal_session(own).conf.get("spark.sql.shuffle.partitions") == "11"
