"""Phrase mining against brute force over all phrases."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import phrases
from tests.llm.corpus import SCHEMA, documents, rows

LOWER = {i: i + 32 for i in range(65, 91)}
VOCABULARY = ["The", "a", "é", "x-y", "zz", "\x1cq", "W" * 30]


def words_of_pieces(text):
    return [re.findall("[^\x20\x09]+", piece) for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))]


def all_counts(texts):
    found = collections.Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        for words in words_of_pieces(text):
            if words:
                found[lang, 0, ""] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    found[lang, k, " ".join(words[i:i + k])] += 1
    return found


def best_phrases(texts, least, top):
    """Everything by definition: all phrases, all cuts, all longer candidates."""
    found, result = all_counts(texts), []
    for lang in {key[0] for key in found}:
        f = {tuple(p.split(" ")): n for (at, k, p), n in found.items() if at == lang and k}
        n = found[lang, 0, ""]
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {
            p[i:j] for p, a in chosen.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and chosen[p[i:j]] <= a
        }
        ranked = []
        for p, a in chosen.items():
            if p not in inside:
                score, cut = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(result)


@pytest.fixture(scope="module")
def texts():
    rng, data = random.Random(1), []
    for d in range(300):
        words = [rng.choice(VOCABULARY[:rng.choice([2, 4, 7])]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", " ,"]) for _ in range(rng.randrange(60))]
        data.append((d if d % 50 else None, rng.choice(["en", "en", "de", None, "und"]), "".join(words) if d % 40 else None))
    return [*data, data[3], (999, "en", "the a " * 5000 + "é"), (1000, "fr", ""), (1001, "fr", " ,; ")]


@pytest.mark.parametrize("least,top", [(20, 2000), (5, 7)])
def test_collocations(spark, texts, least, top):
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").withColumns(
        {"phrase": F.lit("x"), "n": F.lit(3), "k": F.lit(0), "rank": F.lit(0)}
    ).repartition(4)
    found = sorted(tuple(r) for r in phrases.collocations(docs, least, top).collect())
    assert found and found == best_phrases([(lang, text) for _, lang, text in texts], least, top)


def test_corpus_and_empty_table(spark):
    wanted = best_phrases([(r[2], r[1]) for r in rows()], 12, 2000)
    assert sorted(tuple(r) for r in phrases.collocations(documents(spark), 12).collect()) == wanted
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("share", [0, 10**9])  # every further pass is a closing one, or none is
def test_border_failures_are_counted(spark, texts, monkeypatch, share):
    """Whatever is proposed, and nothing at all, the frequent phrases are the same."""
    monkeypatch.setattr(phrases, "CLOSING_SHARE", share)
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    wanted = {key: n for key, n in all_counts([(lang, text) for _, lang, text in texts]).items() if n >= 25 or key[1] == 0}
    odd = spark.createDataFrame([("en", "the a"), ("en", "never seen"), ("xx", "a")], "lang string, phrase string")
    for proposed in (None, odd):
        found = phrases.frequent(docs, 25, proposed)
        assert {(r.lang, r.k, r.phrase): r.n for r in found.collect() if r.n} == wanted


@pytest.mark.parametrize("flush,piece", [(50, 7), (7, 3), (1000, 40)])
def test_counts_do_not_depend_on_where_texts_are_cut(texts, monkeypatch, flush, piece):
    class Everything:
        def holds(self, hashes):
            return np.ones(len(hashes), bool)

    monkeypatch.setattr(phrases, "FLUSH_WORDS", flush)
    monkeypatch.setattr(phrases, "SLICE", piece)
    monkeypatch.setattr(phrases, "KEPT_WORDS", 5)
    counter, found = phrases.PhraseCounter(None, Everything()), collections.Counter()
    pairs = [(lang or "und", text) for _, lang, text in texts if text is not None]
    tables = [t for lang, text in pairs for t in counter.feed(lang, text)] + list(counter.flush())
    for table in tables:
        for row in table.to_pylist():
            words = len(row["phrase"].split(" ")) if row["phrase"] else 0
            found[row["lang"], words, row["phrase"]] += row["n"]
    assert +found == all_counts(pairs)


def test_bitmap(spark):
    proposed = spark.createDataFrame([("en", f"word{k} and") for k in range(2000)], "lang string, phrase string")
    bitmap = phrases.bitmap_of(proposed)

    def hashes(lang, texts):
        out = np.full(len(texts), phrases._hash(lang.encode()), np.uint64)
        for words in zip(*[t.encode().split(b" ") for t in texts]):
            out = phrases.extended(out, np.array([phrases._hash(w) for w in words], np.uint64))
        return out

    assert bitmap.holds(hashes("en", [f"word{k} and" for k in range(2000)])).all()
    assert bitmap.holds(hashes("de", [f"word{k} and" for k in range(2000)])).mean() < 0.01


def test_scores_beyond_64_bits(spark):
    big = 7 * 10**12
    known = spark.createDataFrame(
        [("en", 0, "", 9 * 10**13), ("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big)], "lang string, k int, phrase string, n long"
    )
    row = phrases.scored(known).first()
    assert row.score == 1000 * big * 9 * 10**13 // ((big + 1) * (big + 3))


def test_counted_phrases_travel_as_one_key(spark):
    texts = [("a\nb", "one two. one two"), ("a", "b one two"), ("", "one"), (None, "é é;\n\n"), ("a\n", "one two")]
    docs = spark.createDataFrame([(k, *row) for k, row in enumerate(texts)], "doc_id long, lang string, text string")
    everything = phrases.Bitmap(phrases.LEAST_BITS, b"\xff" * (1 << (phrases.LEAST_BITS - 3)))
    found = phrases.counts(docs, None, everything)
    assert {(r.lang, r.k, r.phrase): r.n for r in found.collect()} == all_counts(texts)
    assert "hashpartitioning(key" in found._jdf.queryExecution().executedPlan().toString()
    often = phrases.counts(docs, None, everything, least=2).collect()
    assert {(r.lang, r.phrase): r.n for r in often if r.k} == {("a\nb", p): 2 for p in ("one", "two", "one two")} | {("und", "é"): 2}


def test_rare_phrases_are_counted_by_hash_only(spark, monkeypatch):
    """Of thousands of rare pairs of frequent words, next to none is shuffled as text."""
    rng = random.Random(4)
    texts = [(d, "en", " ".join(["of the"] + [f"w{rng.randrange(150)}" for _ in range(40)])) for d in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(3)
    counts, met = phrases.counts, []

    def counted(docs, counted, proposed, most=5, closing=False, least=1, *more):
        met.append(counts(docs, counted, proposed, most, closing, 1, *more).where("k >= 2").count())
        return counts(docs, counted, proposed, most, closing, least, *more)

    monkeypatch.setattr(phrases, "counts", counted)
    found = {r.phrase: r.n for r in phrases.frequent(docs, 100).where("k >= 2").collect()}
    every = {p: n for (_, k, p), n in all_counts([t[1:] for t in texts]).items() if k >= 2}
    assert found == {p: n for p, n in every.items() if n >= 100} and len(every) > 60_000
    assert sum(met) < 100


def test_counts_by_hash(spark, texts, monkeypatch):
    """Whatever tasks let go at a time, sums by hash are those by text."""
    monkeypatch.setattr(phrases, "HASH_ROWS", 50)
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string").repartition(4)
    everything = phrases.Bitmap(phrases.LEAST_BITS, b"\xff" * (1 << (phrases.LEAST_BITS - 3)))
    found = collections.Counter((r.k, r.n) for r in phrases.frequent_hashes(docs, None, everything, least=3).collect())
    wanted = all_counts([(lang, text) for _, lang, text in texts])
    assert found == collections.Counter((k, n) for (_, k, _), n in wanted.items() if k and n >= 3)
