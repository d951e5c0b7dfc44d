"""The pipeline's stages keep users' columns, whatever these are called."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marketloom.llm import decontamination, mixing, near_copies
from tests.llm.corpus import documents, prose

FOLDER = "/root/testdata/sf0.001"
NAMES = (
    "_hash", "_nth", "_doc_id", "_text_hash", "_copy", "_copies", "_source", "_size", "_hits", "row", "nth", "id", "hash", "copies", "copy", "rows",
    "keep_id", "of_id", "words", "src", "lang_pred", "first", "node", "part", "a.b",
)


@pytest.fixture(scope="module")
def named(spark):
    """Documents whose other columns hold their names and ids."""
    return documents(spark).drop("hits").withColumns({n: F.concat_ws("-", F.lit(n), "doc_id") for n in NAMES}).persist()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_columns_are_kept(spark, named, name, stage):
    after = stage(spark, named, FOLDER)
    assert after.columns == named.columns
    whole = collections.Counter(tuple(r) for r in named.collect())
    found = after.collect()
    assert found and {tuple(r) for r in found} <= set(whole)
    if name != "mix":
        assert all(n <= whole[row] for row, n in collections.Counter(map(tuple, found)).items())


def test_last_stage_takes_any_columns(spark, named):
    assert corpus_pipeline.STAGES[-1][1](spark, named, FOLDER).count() == named.count()


def test_copies_of_repeated_rows_are_dealt_out(spark):
    """One of three equal rows is taken if the mix takes one, and none is lost to rounding."""
    rows = [(1, "a b c d", "s", k) for k in range(3)] + [(k, "x y z", "t", k) for k in range(10, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mark long")
    for weights in ((1, 1), (1, 100), (3, 5)):
        target = {r.doc_id: 0 for r in docs.collect()}
        whole = mixing.taken_words(docs, weights).collect()
        for r in whole:
            target[r.doc_id] += r.taken
        found = collections.Counter(r.doc_id for r in mixing.mixed_documents(docs, weights).collect())
        assert abs(4 * found[1] - target[1]) <= 2
        marks = collections.Counter(r.mark for r in mixing.mixed_documents(docs, weights).where("doc_id = 1").collect())
        assert not marks or max(marks.values()) - min(marks[k] for k in range(3)) <= 1


def test_one_row_of_repeated_ones_stays(spark):
    rows = [(1, "one two three four five", "x")] * 4 + [(None, "six seven eight nine ten", "y")] * 2 + [(3, None, "z")] * 2
    found = near_copies.without_copies(spark.createDataFrame(rows, "doc_id long, text string, nth string")).collect()
    assert sorted((r.nth for r in found)) == ["x", "y", "z", "z"]


def test_items_without_id_are_found(spark):
    items = [(None, prose(800, "en", 40)), (2, prose(801, "de", 40)), (None, prose(802, "en", 30))]
    data = [(k, f"{prose(k, 'de', 30)} {text}") for k, (_, text) in enumerate(items)] + [(9, prose(900, "en", 200))]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert [r.doc_id for r in decontamination.clean(docs, benchmark).collect()] == [9]
    found = decontamination.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(0, None), (1, 2), (2, None)}
