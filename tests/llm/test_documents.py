"""Operators on documents against brute force."""

import collections
import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest

from marketloom.llm import language, mixing, near_copies, repeats, sharding, token_files
from tests.llm.corpus import SCHEMA, documents, rows


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def table_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_language(docs, none):
    found = {r.doc_id: r for r in language.identified(docs).collect()}
    assert language.identified(none).count() == 0
    assert all(0 <= r.score <= 1 for r in found.values())
    for doc_id in (80, 81, 82, 84):
        assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
    known = [(i, lang) for i, _, lang, *_ in rows()[:60]]
    assert all(found[i].lang_pred == lang for i, lang in known)
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in known)
    kept = language.accepted(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 4


def test_language_pieces_lose_no_gram(monkeypatch):
    text = " " + "abcdefghij " * 30
    whole = np.sort(np.concatenate(list(language.gram_buckets(text))))
    monkeypatch.setattr(language, "STEP", 7)
    assert np.array_equal(np.sort(np.concatenate(list(language.gram_buckets(text)))), whole)


def test_shards(docs, none):
    found = sharding.sharded(docs, 4).collect()
    assert sharding.sharded(none).count() == 0
    assert len(found) == docs.count()
    assert {r.law for r in found} == {"bytes"}
    of_text = collections.defaultdict(set)
    for r in found:
        of_text[r.text_crc32, r.size].add(r.shard)
    assert all(len(s) == 1 for s in of_text.values())
    slots = collections.defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows()}
    assert all(sizes[r.doc_id] == (r.size, r.text_crc32) for r in found)


@pytest.mark.parametrize("shards", [1, 3, 5, 6, 7])
def test_shards_of_any_number_are_even(spark, shards):
    data = [(k, f"{k} " * (k % 50 + 1), "de", "b" if k % 3 else "c") for k in range(3_000)]
    found = sharding.sharded(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), shards)
    sums = {r[0]: r[1] for r in found.groupBy("shard").sum("size").collect()}
    assert sorted(sums) == list(range(shards)) and max(sums.values()) <= 1.05 * min(sums.values())


def test_shards_are_even_and_split_a_giant_group(spark):
    data = [(k, "x" * 300, "en", "a") for k in range(600)] + [(k, f"{k} " * (k % 50 + 1), "de", "b") for k in range(600, 2000)]
    found = sharding.sharded(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), 8)
    sums = [r[0] for r in found.groupBy("shard").sum("size").select("sum(size)").collect()]
    assert len(sums) == 8 and max(sums) <= 1.05 * min(sums)


def test_repeats(docs, none, monkeypatch):
    assert repeats.without_repeats(none).count() == 0
    data = [(i, (t or "").encode()) for i, t, *_ in rows()]
    seen = collections.Counter(b[k:k + 200] for _, b in data for k in range(len(b) - 199))
    wanted = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        wanted.append((i, len(b), int(gone.sum()), starts, hashlib.sha256(kept).hexdigest()))
    assert table_of(repeats.without_repeats(docs)) == sorted(wanted, key=repr)
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", 1)  # everything counted by window
    assert table_of(repeats.without_repeats(docs)) == sorted(wanted, key=repr)


def test_longest_matches():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 99, rng.integers(1, 40)).astype(np.uint8)) for _ in range(30)]
    found, at = repeats.longest_matches(texts), 0
    for t, text in enumerate(texts):
        for k in range(len(text)):
            best = max(
                next((n for n in range(min(len(text) - k, len(o) - j)) if text[k + n] != o[j + n]), min(len(text) - k, len(o) - j))
                for u, o in enumerate(texts) for j in range(len(o)) if (t, k) != (u, j)
            )
            assert found[at + k] == best
        at += len(text) + 1


def test_tokens(docs, none):
    from tokenizers import Tokenizer

    assert token_files.tokenized(none).count() == 0
    found = token_files.tokenized(docs).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(token_files.vocabulary())
    wanted = collections.Counter()
    for i, text, *_ in rows():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        wanted[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    order = [r.doc_id for r in found]
    assert order[-1] is None and order[:-1] == sorted(order[:-1])
    assert [r.start for r in found] == list(np.cumsum([0] + [r.n_tokens for r in found])[:-1])


def test_segments_are_read_without_a_shuffle(spark, tmp_path):
    held = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        texts = spark.range(8).selectExpr("id AS doc_id", "repeat('a ', 600000) AS text")
        token_files.write_tokens(texts, str(tmp_path / "tokens"), token_files.vocabulary())
        segments = token_files.read_tokens(spark, str(tmp_path / "tokens"))
        assert segments.groupBy("part").count().where("count > 1").count() > 0
        assert "SortMergeJoin" not in segments._jdf.queryExecution().executedPlan().toString()
        found = token_files.document_digests(segments).orderBy("doc_id").collect()
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
    assert [r.start for r in found] == list(np.cumsum([0] + [r.n_tokens for r in found])[:-1])
    assert len(found) == 8 and found[0].n_tokens > 600_000


def test_elias_fano_round_trip():
    rng = np.random.default_rng(2)
    for values in ([], [0], [5, 5, 5], list(range(300)), sorted(rng.integers(0, 1 << 40, 500).tolist())):
        coded, end = token_files.EliasFano.read(token_files.EliasFano.of(np.array(values, np.uint64)).to_bytes(), 0)
        assert coded.all().tolist() == values
        assert [coded.select(k) for k in range(len(values))] == values
    assert len(coded.to_bytes()) < 500 * 8
    packed = token_files.Segment.unpack(token_files.Segment.pack([-4, 9, None], [2, 0, 1], np.array([7, 8, 9], "<u4").tobytes(), 2))
    assert packed.doc_ids == [-4, 9, None] and [packed.document(k).tolist() for k in range(3)] == [[7, 8], [], [9]]


def test_mix(docs, none):
    assert mixing.taken_words(none).count() == 0
    found = mixing.taken_words(docs, block_words=16).collect()
    assert len(found) == docs.count()
    assert table_of(mixing.taken_words(docs, block_words=16)) == sorted((tuple(r) for r in found), key=repr)
    words = {i: len((t or "").split(None)) if t is None or t.isascii() else len(t.encode().split()) for i, t, *_ in rows()}
    assert all(words[r.doc_id] == r.size and 0 <= r.taken <= 3 * r.size for r in found)
    source_of, sizes = {}, collections.Counter()
    for i, text, _, source, *_ in rows():
        source_of[i] = source
        sizes[source] += words[i]
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not full:
            break
        target.update({s: 3.0 * sizes[s] for s in full})
        left, open_ = left - sum(3 * sizes[s] for s in full), open_ - full
    target.update(share)
    taken = collections.Counter()
    for r in found:
        taken[source_of[r.doc_id]] += r.taken
        assert r.target == pytest.approx(target[source_of[r.doc_id]]) and r.source_size == sizes[source_of[r.doc_id]]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)


def test_schedule_is_spread(spark):
    sources = spark.createDataFrame([(0, 300.0), (1, 100.0), (2, 600.0)], "src int, target double").persist()
    slots = mixing.schedule(sources, 1).orderBy("slot").collect()
    assert collections.Counter(r.src for r in slots) == {0: 300, 1: 100, 2: 600}
    for src, share in ((0, 0.3), (1, 0.1), (2, 0.6)):
        mine = [r for r in slots if r.src == src]
        assert [r.block for r in mine] == list(range(len(mine)))
        half = sum(r.src == src for r in slots[:500])
        assert abs(half - 500 * share) < 12


def test_near_copies(docs, none):
    assert near_copies.near_duplicates(none).count() == 0
    sets, texts = {}, {}
    for i, text, *_ in rows():
        words = (text or "").encode().lower().split() if (text or "").isascii() else "".join(
            c.lower() if c.isascii() else c for c in text).encode().split()
        sets[i] = set(zip(words, words[1:])) or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted((i for i in sets if i is not None))
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = near_copies.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    kept = near_copies.without_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [i for i in ids if find(i) == i]


def test_crowded_regions_keep_components(docs, monkeypatch):
    before = table_of(near_copies.near_duplicates(docs))
    for name, value in (("REGION", 2), ("PART_ROWS", 4), ("GROUP_LINKS", 5)):
        monkeypatch.setattr(near_copies, name, value)
    assert table_of(near_copies.near_duplicates(docs)) == before


def test_copies_linked_by_their_original_only(spark, monkeypatch):
    """Each copy is near its original, but copies aren't near each other; without the original they stay alone."""
    rng = np.random.default_rng(3)

    def copies(name: str, n: int) -> list[str]:
        base, out = [f"{name}{k}" for k in range(400)], []
        for c in range(n):
            words = list(base)
            for place in rng.choice(np.arange(1, 399, 2), 19, replace=False):
                words[place] = f"{name}x{c}y{place}"
            out.append(" ".join(words))
        return [*out, " ".join(base)]

    texts = copies("a", 150) + copies("b", 60)[:-1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(near_copies, "BLOCK", 32, raising=False)
    found = {r.doc_id: r.component_id for r in near_copies.near_duplicates(docs).collect()}
    assert found == {k: 0 if k <= 150 else k for k in range(len(texts))}


@pytest.mark.parametrize("noise", [2, 12, 40])
def test_comparison_by_whole_sets_joins_what_links_join(noise):
    rng = np.random.default_rng(noise)
    base = rng.integers(0, 1 << 63, 100, np.uint64)
    sets = [
        np.unique(np.concatenate([base[noise // 2:], rng.integers(0, 1 << 63, rng.integers(1, noise + 1), np.uint64)])) for _ in range(40)
    ] + [rng.integers(0, 1 << 63, 7, np.uint64)]
    names = [bytes([k // 2]) for k in range(len(sets))]  # two sets to a component
    entries = [(names[k], asks, sets[k].tobytes()) for k in range(len(sets)) for asks in (False, True)]
    rows_ = pd.DataFrame(entries, columns=["component", "asks", "shingles"])

    def merged(pairs):
        group = {n: {n} for n in names}
        for a, b in pairs:
            both = group[a] | group[b]
            for n in both:
                group[n] = both
        return {frozenset(g) for g in group.values()}

    links = [
        (names[i], names[k]) for i in range(len(sets)) for k in range(i)
        if 100 * len(c := set(sets[i]) & set(sets[k])) >= 80 * (len(sets[i]) + len(sets[k]) - len(c))
    ]
    found = list(near_copies._joining(rows_))
    assert merged(found) == merged(links)
    assert len(found) == len(set(names)) - len(merged(links))
