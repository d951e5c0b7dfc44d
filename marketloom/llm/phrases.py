"""Phrase collocations by Toivonen's mining: a sample proposes phrases, full passes count them and their negative border.

A phrase is proposed if it is frequent in a sample of the texts' pieces at a lowered threshold. A full pass counts every
phrase whose two parts without the last and without the first word are proposed: the proposed phrases and their negative
border. Most of them are rare, so this pass counts by hash, as in Park, Chen and Yu's mining: equal phrases have equal
hashes, so what has too few occurrences by its hash is rare for certain. If a hash is frequent but wasn't proposed, its
extensions may be frequent too: it is added, and a further pass counts what that brings in, until the proposals are
nearly closed. A last pass counts, exactly and by text, the phrases of frequent hashes and all that the last unproposed
ones bring in. So the sample decides how many passes there are and never what they return.

Proposals and frequent hashes reach the tasks as bitmaps of bounded size. A false positive in them, or two phrases of one
hash, makes a pass count a phrase more. Tasks number words and phrases by dictionaries, so counts by text are exact.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketloom.llm.common import stored

MOST_WORDS = 5
LEAST = 100
"""Occurrences that make a phrase a candidate."""

TOP = 2000
SAMPLE_SHARE = 8
"""The sample is one piece of text in so many, so that a phrase that recurs within a single document is met as well."""

SAMPLE_SLACK = 0.4
"""The sample's threshold as a part of what it would hold of a phrase at the threshold, which leaves few phrases out."""

CLOSING_SHARE = 20
"""Border failures that cover at most one in so many words are settled by one further pass."""

TEXT_BYTES = 32 << 20
"""Counts by text that a task collects before it adds them up."""

FLUSH_WORDS = 1 << 20
"""Words that a task counts at a time."""

KEPT_WORDS = 400_000
"""Words whose numbers a task keeps from one count to the next."""

SLICE = 1 << 22
"""Characters of a text split at a time, and the rest of the word there."""

LEAST_BITS, MOST_BITS = 20, 28
"""The bitmap has 2 to the power of these bits, thus at most 32 MB."""

BUCKET = 15
BLOCK_BITS, HASH_BITS, K_BITS = 12, 41, 3
"""Counts by hash keep the first ``HASH_BITS`` bits and, behind them, the number of words. Their first ``BLOCK_BITS`` bits are
the block by which they are shuffled, the other 32 are what it holds: at 5 billion different phrases of tasks, 5 MB."""

HASH_ROWS = 3 << 20
"""Counts by hash that a task collects before it adds them up and lets them go."""

SEPARATORS = r"[.,;:!?\x0A-\x0D]"
_BLANKS = re.compile(r"[\x20\x09.,;:!?\x0A-\x0D]")
_NORMAL = bytes(
    0x0A if c in b".,;:!?\x0A\x0B\x0C\x0D" else 0x20 if c == 0x09 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)
_FACTOR, _MIX, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0xC2B2AE3D27D4EB4F)


def extended(hashes: np.ndarray, word_hashes: np.ndarray) -> np.ndarray:
    """Hashes of phrases, from those without the last word and the last words'."""
    mixed = hashes * _FACTOR + word_hashes
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    return mixed ^ (mixed >> np.uint64(32))


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def kept_bits(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - HASH_BITS) << np.uint64(64 - HASH_BITS)


def added_up(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in ascending order, with their sums."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n


@dataclass(frozen=True)
class Bitmap:
    """A set of hashes: two bits each. What was added is found; little else is."""

    bits: int
    data: bytes

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        hashes, shift = kept_bits(hashes), np.uint64(64 - bits)
        return hashes >> shift, (hashes * _SECOND) >> shift

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found, data = np.ones(len(hashes), bool), np.frombuffer(self.data, np.uint8)
        for place in self.places(hashes, self.bits):
            found &= (data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


@dataclass(frozen=True)
class Either:
    """What any of several bitmaps holds."""

    bitmaps: tuple

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        for bitmap in self.bitmaps:
            found |= bitmap.holds(hashes)
        return found


def bitmap_of(proposed: DataFrame) -> Bitmap:
    """Proposals (``lang, phrase``) as a bitmap."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.empty(batch.num_rows, np.uint64)
            for k, (lang, phrase) in enumerate(zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist())):
                one = np.array([_hash(lang.encode())], np.uint64)
                for word in phrase.encode().split(b" "):
                    one = extended(one, np.array([_hash(word)], np.uint64))
                hashes[k] = one[0]
            yield pa.record_batch({"hash": hashes.view(np.int64)})

    return bitmap_of_hashes(proposed.select("lang", "phrase").mapInArrow(hashed, "hash long"))


def bitmap_of_hashes(hashes: DataFrame) -> Bitmap:
    """Hashes (``hash``) as a bitmap of 16 bits each, up to ``MOST_BITS``; the driver gets its blocks of 4 KB."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, hashes.count()) * 16))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Bitmap.places(batch["hash"].to_numpy().view(np.uint64), bits)
            yield pa.record_batch({"place": np.concatenate(found).astype(np.int64)})

    blocks = hashes.select("hash").mapInArrow(places, "place long").groupBy(
        F.shiftright("place", BUCKET).alias("block")
    ).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << BUCKET) - 1)).alias("data"))
    data = bytearray(1 << (bits - 3))
    for block, part in blocks.collect():
        at = block << (BUCKET - 3)
        data[at:at + len(part)] = part
    return Bitmap(bits, bytes(data))


class _Words(dict):
    """Word -> number, from 1; new words get the next one. 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b"\n": 0})
        self.words, self.hashes = [b"\n"], array("Q", [0])

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.hashes.append(_hash(word))
        return number


class PhraseCounter:
    """Counts the phrases of one task: all whose parts are ``proposed``, without those whose parts are ``counted``.

    Of these and of words, it counts those that are ``frequent`` after all, if that is given. ``hashed``: by hash, else by text.
    """

    def __init__(
        self, counted: Bitmap | Either | None, proposed: Bitmap | Either | None, most: int = MOST_WORDS, closing: bool = False,
        frequent: Bitmap | None = None, hashed: bool = False,
    ):
        self.counted, self.proposed, self.most, self.closing = counted, proposed, most, closing
        self.frequent, self.hashed = frequent, hashed
        self.entries, self.times, self.collected = [], [], 0
        self.words = _Words()
        self.streams: dict[str, list[np.ndarray]] = {}
        self.size = 0
        self.carried = 0
        self.first = counted is None or frequent is not None

    def feed(self, lang: str, text: str) -> Iterator[pa.RecordBatch]:
        begin = 0
        while begin < len(text):
            cut = _BLANKS.search(text, begin + SLICE) if len(text) - begin > SLICE else None
            end = cut.start() if cut else len(text)
            words = text[begin:end].encode("utf-8", "replace").translate(_NORMAL).replace(b"\n", b" \n ").split(b" ")
            words = list(filter(None, words))
            self.streams.setdefault(lang, []).append(np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)))
            self.size, begin = self.size + len(words), end
            if self.size >= FLUSH_WORDS:
                yield from self.flush(lang if begin < len(text) else None)
        if lang in self.streams:
            self.streams[lang].append(np.zeros(1, np.int64))

    def flush(self, unfinished: str | None = None) -> Iterator[pa.RecordBatch]:
        """Counts of what was fed. Of a text that goes on, the last words stay, so that no phrase is lost or counted twice."""
        hashes = np.frombuffer(self.words.hashes, np.uint64)
        for lang, parts in self.streams.items():
            yield from self._counts(lang, np.concatenate(parts), hashes)
        left = [] if unfinished is None else np.concatenate(self.streams[unfinished])[-(self.most - 1):].tolist()
        del hashes
        tail = [self.words.words[k] for k in left]
        if len(self.words.words) > KEPT_WORDS:
            self.words = _Words()
        self.streams, self.size, self.carried = {}, 0, len(tail)
        self.carrying = unfinished
        if tail:
            self.streams[unfinished] = [np.array([self.words[w] for w in tail], np.int64)]

    def _counts(self, lang: str, ids: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = self.carried if self.carried and lang == self.carrying else 0  # where words begin that weren't counted before
        words = self.words.words
        times = np.bincount(ids[new:], minlength=len(words))
        times[0] = 0
        used = np.zeros(len(words), bool)
        used[ids] = True
        used[0] = False
        used = np.flatnonzero(used)
        code_hash = np.zeros(len(words), np.uint64)
        code_hash[used] = extended(np.full(len(used), _hash(lang.encode()), np.uint64), hashes[used])
        if self.first:
            seen = np.flatnonzero(times)
            if self.frequent is not None:
                seen = seen[self.frequent.holds(code_hash[seen])]
            if self.hashed:
                yield from self._collect(1, code_hash[seen], times[seen])
            else:
                yield self._rows(lang, [words[k] for k in seen.tolist()], times[seen])
                yield self._rows(lang, [b""], [int(times.sum())])
        if self.proposed is None:
            return
        wanted, done = np.zeros(len(words), bool), np.zeros(len(words), bool)
        wanted[used] = self.proposed.holds(code_hash[used])
        if self.counted is not None:
            done[used] = self.counted.holds(code_hash[used])
        code, wanted_at, done_at = ids, wanted[ids], done[ids]
        for k in range(2, self.most + 1):
            starts = np.flatnonzero(wanted_at[:-1] & wanted_at[1:])
            starts = starts[starts + k <= len(ids)]
            if not len(starts):
                return
            last = ids[starts + k - 1]
            found, at, which = np.unique(code[starts] * len(words) + last, return_index=True, return_inverse=True)
            times = np.bincount(which[starts + k > new], minlength=len(found))
            old = done_at[starts[at]] & done_at[starts[at] + 1]
            code_hash = extended(code_hash[code[starts[at]]], hashes[last[at]])
            fresh = ~old if self.frequent is None else ~old | self.frequent.holds(code_hash)
            fresh = np.flatnonzero(fresh & (times > 0))
            if self.hashed:
                yield from self._collect(k, code_hash[fresh], times[fresh])
            elif len(fresh):
                begins = starts[at[fresh]]
                columns = [[words[w] for w in ids[begins + j].tolist()] for j in range(k)]
                yield self._rows(lang, list(map(b" ".join, zip(*columns))), times[fresh])
            if k == self.most:
                return
            in_wanted = self.proposed.holds(code_hash)
            if self.closing:
                in_wanted |= ~old
            in_done = old & self.counted.holds(code_hash) if self.counted is not None else old
            next_code, wanted_at, done_at = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool), np.zeros(len(ids), bool)
            next_code[starts], wanted_at[starts], done_at[starts] = which, in_wanted[which], in_done[which]
            code = next_code

    def _collect(self, k: int, hashes: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.entries.append(kept_bits(hashes) | np.uint64(k << 64 - HASH_BITS - K_BITS))
        self.times.append(times)
        self.collected += len(times)
        if self.collected >= HASH_ROWS:
            yield from self.blocks()

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """What was counted by hash, a row for each block: the entries' last 32 bits, and occurrences."""
        if not self.collected:
            return
        entries, n = added_up(np.concatenate(self.entries), np.concatenate(self.times))
        self.entries, self.times, self.collected = [], [], 0
        block, at = np.unique((entries >> np.uint64(64 - BLOCK_BITS)).astype(np.int32), return_index=True)
        ends = pa.py_buffer((np.append(at, len(entries)) * 4).astype(np.int32))

        def of(values: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(block), [None, ends, pa.py_buffer(values.astype("<u4"))])

        rest = entries >> np.uint64(64 - HASH_BITS - K_BITS)
        yield pa.record_batch({"block": block, "entries": of(rest & np.uint64(0xFFFFFFFF)), "n": of(np.minimum(n, 0xFFFFFFFF))})

    @staticmethod
    def _rows(lang: str, phrases: list[bytes], times) -> pa.RecordBatch:
        return pa.record_batch({
            "lang": pa.repeat(pa.scalar(lang, pa.string()), len(phrases)),
            "phrase": pa.array(phrases, pa.binary()).cast(pa.string()), "n": np.asarray(times, np.int64),
        })


def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Phrase, line break and language as one short key: nearly all that a pass shuffles are these rows."""
    return pa.record_batch({"key": pc.binary_join_element_wise(batch["phrase"], batch["lang"], "\n"), "n": batch["n"]})


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task, keys that recur added up; what doesn't shrink to half is let go, so that little is held."""
    kept, size = [], 0

    def summed() -> pa.Table:
        table = pa.Table.from_batches(kept).group_by("key", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"key": table["key"], "n": table["n_sum"]})

    for batch in batches:
        kept.append(batch)
        size += batch.nbytes
        if size >= TEXT_BYTES:
            table = summed()
            kept, size = table.to_batches(), table.nbytes
            if size * 2 > TEXT_BYTES:
                yield from table.to_batches()
                kept, size = [], 0
    if kept:
        yield from summed().to_batches()


def in_blocks(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts by text, a row for each block of keys."""
    block = np.fromiter(map(zlib.crc32, batch["key"].cast(pa.binary()).to_pylist()), np.int64, batch.num_rows) >> 32 - BLOCK_BITS
    order = np.argsort(block, kind="stable")
    blocks, at = np.unique(block[order], return_index=True)
    ends, batch = pa.array(np.append(at, len(order)), pa.int32()), batch.take(pa.array(order))
    return pa.record_batch({
        "block": pa.array(blocks, pa.int32()), "keys": pa.ListArray.from_arrays(ends, batch["key"]), "times": pa.ListArray.from_arrays(ends, batch["n"]),
    })


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")


def frequent_hashes(
    docs: DataFrame, counted: Either | None, proposed: Either | None, most: int = MOST_WORDS, least: int = LEAST,
) -> DataFrame:
    """``hash, k, n, open``: what ``counts`` would count, by hash, with at least ``least`` occurrences; ``open`` if not proposed.

    Words are in the first pass only, the one without ``counted``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counted, proposed))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(*shared.value, most, hashed=True)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                yield from counter.feed(lang.as_py(), text.as_py())
        yield from counter.flush()
        yield from counter.blocks()

    def summed(block: pa.Table) -> pa.Table:
        def values(name: str) -> np.ndarray:
            return np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in block[name]])

        entries, n = added_up(values("entries"), values("n").astype(np.int64))
        entries, n = entries[n >= least], n[n >= least]
        first = np.uint64(block["block"][0].as_py() << 64 - BLOCK_BITS)
        hashes = kept_bits(entries.astype(np.uint64) << np.uint64(64 - HASH_BITS - K_BITS) | first)
        known = shared.value[1]
        return pa.table({
            "hash": hashes.view(np.int64), "k": (entries & np.uint32((1 << K_BITS) - 1)).astype(np.int32), "n": n,
            "open": np.ones(len(n), bool) if known is None else ~known.holds(hashes),
        })

    packed = texts_of(docs).mapInArrow(count, "block int, entries binary, n binary")
    return packed.groupBy("block").applyInArrow(summed, "hash long, k int, n long, open boolean")


def counts(
    docs: DataFrame, counted: Bitmap | Either | None, proposed: Bitmap | Either | None, most: int = MOST_WORDS, closing: bool = False,
    least: int = 1, frequent: Bitmap | None = None,
) -> DataFrame:
    """``lang, k, phrase, n``: exact counts over all texts of the phrases of ``k`` words that ``proposed`` adds to ``counted``.

    Those with fewer than ``least`` occurrences are left out. The first pass, without ``counted``, also has all words, and each language's number of words as ``k`` = 0. A ``closing``
    pass takes all phrases that it counts anew for proposed ones, and so counts their extensions at once. With
    ``frequent``, words and phrases that it holds are counted as well, whether or not ``counted`` has them; each task's counts,
    which have the same phrases again and again, then travel in blocks.
    """
    shared = docs.sparkSession.sparkContext.broadcast((counted, proposed, most, closing, frequent))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(*shared.value)

        def counted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, text in zip(batch["lang"], batch["text"]):
                    yield from counter.feed(lang.as_py(), text.as_py())
            yield from counter.flush()

        yield from combined(map(keyed, counted()))

    def count_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(in_blocks, count(batches))

    def summed_block(block: pa.Table) -> pa.Table:
        found = pa.table({"key": pc.list_flatten(block["keys"]), "n": pc.list_flatten(block["times"])})
        found = found.group_by("key", use_threads=False).aggregate([("n", "sum")])
        kept = pc.or_(pc.greater_equal(found["n_sum"], least), pc.starts_with(found["key"], "\n"))
        return pa.table({"key": found["key"], "n": found["n_sum"]}).filter(kept)

    if frequent is None:
        summed = texts_of(docs).mapInArrow(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    else:
        summed = texts_of(docs).mapInArrow(count_in_blocks, "block int, keys array<string>, times array<long>").groupBy("block").applyInArrow(
            summed_block, "key string, n long"
        )
    phrase = F.substring_index("key", "\n", 1)
    found = summed.where((F.col("n") >= least) | F.col("key").startswith("\n")).select(
        F.expr("substring(key, length(substring_index(key, '\n', 1)) + 2)").alias("lang"), phrase.alias("phrase"), "n"
    )
    k = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return found.select("lang", k.alias("k"), "phrase", "n")


def closed(docs: DataFrame, least: int, proposed: Either | None, most: int = MOST_WORDS) -> tuple[Either | None, DataFrame]:
    """Proposals, extended until few words or none are covered by frequent phrases without, and the frequent hashes of all passes."""
    counted, found, words = None, None, 0
    while True:
        new = stored(frequent_hashes(docs, counted, proposed, most, least), "frequent-hashes")
        found = new if found is None else found.unionByName(new)
        open_ = new.where(F.col("open") & (F.col("k") < most))
        new_words, extended_ = new.agg(F.sum(F.when(F.col("k") == 1, F.col("n"))), F.sum(F.when(F.col("open") & (F.col("k") < most), F.col("n")))).first()
        words += new_words or 0
        # Few occurrences to extend: a closing pass counts little more than a plain one.
        if not extended_ or extended_ * CLOSING_SHARE <= words:
            return proposed, found
        counted, proposed = proposed or Either(()), Either(((*proposed.bitmaps,) if proposed else ()) + (bitmap_of_hashes(open_),))


def frequent(docs: DataFrame, least: int, proposed: DataFrame | Bitmap | None = None, most: int = MOST_WORDS) -> DataFrame:
    """``lang, k, phrase, n`` of all phrases of up to ``most`` words with at least ``least`` occurrences; ``k`` = 0 as in ``counts``.

    ``proposed`` (``lang, phrase``, or their bitmap) are counted at once; what turns out frequent besides takes further passes.
    """
    if isinstance(proposed, DataFrame):
        proposed = bitmap_of(proposed)
    counted, found = closed(docs, least, None if proposed is None else Either((proposed,)), most)
    counted, known = counted or Either(()), bitmap_of_hashes(found)
    return stored(counts(docs, counted, Either((*counted.bitmaps, known)), most, True, least, known), "phrases")


def proposals(docs: DataFrame, least: int, share: int = SAMPLE_SHARE, most: int = MOST_WORDS) -> Bitmap:
    """Phrases that are frequent in one piece of text in ``share``, at a lowered threshold."""
    drawn = F.filter(
        F.split("text", SEPARATORS), lambda piece, k: F.pmod(F.xxhash64(F.col("doc_id"), k, F.lit("phrases")), F.lit(share)) == 0
    )
    sample = stored(docs.select("lang", F.array_join(drawn, "\n").alias("text")).where("text <> ''"), "phrase-sample")
    lowered = max(2, round(SAMPLE_SLACK * least / share))
    return bitmap_of_hashes(closed(sample, lowered, None, most - 1)[1])


def _joined(words: Column, first, size) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(known: DataFrame) -> DataFrame:
    """Candidates of ``known`` with their lowest-scoring cut: ``lang, phrase, k, a, l, r, n, score``."""
    totals = known.where("k = 0").select("lang", F.col("n").alias("total"))
    words = F.split("phrase", " ")
    cuts = known.where("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"), words.alias("words")).withColumn(
        "cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    ).select(
        "lang", "phrase", "k", "a", "cut", _joined(F.col("words"), F.lit(1), F.col("cut")).alias("left"),
        _joined(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"),
    )
    parts = known.where("k >= 1")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(
        parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"]
    ).join(totals, "lang")
    # 38 digits: 1000 * a * n of up to 10^17 words.
    big = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = cuts.withColumns({"above": F.lit(1000).cast("decimal(4,0)") * big("a") * big("total"), "under": big("l") * big("r")})
    return cuts.withColumn("score", F.expr("above div under")).groupBy("lang", "phrase", "k", "a", F.col("total").alias("n")).agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("best")
    ).select("lang", "phrase", "k", "a", "best.l", "best.r", "n", "best.score")


def maximal(candidates: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Candidates that aren't part of a longer one with as many occurrences.

    Phrases between the two have these occurrences as well, so those that are a word longer are enough.
    """
    words = F.split("phrase", " ")
    longer = candidates.where("k >= 3").select(
        "lang", "a", F.explode(F.array(_joined(words, F.lit(1), F.col("k") - 1), _joined(words, F.lit(2), F.col("k") - 1))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return candidates.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < a").drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SAMPLE_SHARE) -> DataFrame:
    """Per language (null: ``und``) the ``top`` phrases of two to five words: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` occurrences, ``l`` and ``r`` those of the two parts, ``n`` words of the language, ``score`` = floor(1000 a n / (l r)) at the cut
    where it is lowest, at the first of such cuts. Ties in score are ranked by ``a``, then by the phrase in code point order.
    Null and empty texts have no words; repeated rows count each; texts of any length are counted whole; an empty table
    gives no rows. Columns besides ``doc_id``, ``lang`` and ``text`` are ignored.
    """
    known = frequent(docs, least, proposals(docs, least, share))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return maximal(stored(scored(known), "collocations")).withColumn("rank", F.row_number().over(order).cast("long")).where(
        F.col("rank") <= top
    ).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
