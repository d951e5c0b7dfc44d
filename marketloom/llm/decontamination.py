"""Benchmark decontamination: passages of training documents query a BM25 index of benchmark items.

The index holds units, stretches of at most ``UNIT_WORDS`` words of an item, with BM25 impacts divided by the unit's own
score: a passage that holds a whole unit scores 1. Units lie in blocks; a block keeps the largest impact per term.
As in block-max WAND a passage first gets the sum of these bounds per block, and only blocks whose bound reaches the
threshold are scored, each unit of them, so every unit above the threshold is found. Hits are verified by the overlap
with the item's question and with its answer, or with the whole of an item that has no question mark: the share of
five-word shingles in the document or of words in order in one stretch of it, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

UNIT_WORDS = 48
PASSAGE_WORDS = 128
"""Passages overlap by half, so each stretch of 64 words lies whole in one of them."""

BLOCK_UNITS = 16
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
K1, B = 1.2, 0.75

INDEX_BYTES = 8 << 20
"""Text of the items in one broadcast index. Beyond it the items are dealt to several, each scanned in turn."""

HITS = "array<struct<item_id:long,score:double,question_overlap:double,answer_overlap:double,first_word:long>>"
HITS_TYPE = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
    ("first_word", pa.int64()),
]))

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256)
)
"""A-Z to lower case; ASCII characters other than letters and digits to blanks."""


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()


def question_and_answer(text: str, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """Up to the first question mark and the rest; without one, or with nothing behind it, all words and none."""
    question, _, answer = text.partition("?")
    parts = words_of(question), words_of(answer)
    return parts if all(parts) else (words, [])


def shingles(words: list[bytes]) -> set[bytes]:
    """Five-word shingles; a shorter text is one shingle."""
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[k:k + SHINGLE]) for k in range(len(words) - SHINGLE + 1)}


def in_order(part: list[bytes], words: list[bytes]) -> int:
    """Most words of ``part`` that one stretch of ``words``, a quarter longer than ``part``, holds in order.

    Stretches begin every eighth of the part's length and are that much longer, so none is missed in between. Those with
    the most words that ``part`` has come first, until no other can hold more than what was found.
    """
    size = len(part)
    step = max(1, size // 8)
    width = size + max(2, size // 4) + step
    masks: dict[bytes, int] = {}
    for k, w in enumerate(part):
        masks[w] = masks.get(w, 0) | 1 << k
    shared = np.fromiter((w in masks for w in words), bool, len(words))
    before = np.concatenate([[0], np.cumsum(shared)])
    starts = np.arange(0, max(1, len(words)), step)
    most = before[np.minimum(starts + width, len(words))] - before[starts]
    full, best = (1 << size) - 1, 0
    for at in np.argsort(-most, kind="stable").tolist():
        if most[at] <= best or best == size:
            break
        start, row = int(starts[at]), full  # a zero bit per word of the longest common subsequence
        for w in words[start:start + width]:
            if mask := masks.get(w):
                met = row & mask
                row = (row + met) | (row - met)
        best = max(best, size - (row & full).bit_count())
    return best


@dataclass
class Item:
    """An item without question and answer has all its words in ``question`` and none in ``answer``."""

    item_id: int
    words: list[bytes]
    question: list[bytes]
    answer: list[bytes]

    def overlaps(self, words: list[bytes]) -> tuple[float, float]:
        """Shares of the question and of the answer that ``words`` hold; twice that of the whole item if it has no answer."""
        by_size: dict[int, set[bytes]] = {}

        def share(part: list[bytes]) -> float:
            if not part:
                return 1.0
            size = min(SHINGLE, len(part))
            if size not in by_size:
                by_size[size] = {b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)}
            own = shingles(part)
            shingled = len(own & by_size[size]) / len(own)
            return shingled if shingled == 1 else max(shingled, in_order(part, words) / len(part))

        if not self.answer:
            half = (len(self.words) + 1) // 2
            whole = share(self.words)
            if whole < 1:  # the halves may stand apart
                whole = max(whole, min(share(self.words[:half]), share(self.words[half:])))
            return whole, whole
        question, answer = share(self.question), share(self.answer)
        if min(question, answer) < 1 and min(len(self.question), len(self.answer)) < SHINGLE:
            # One word is more than a fifth of a short part: it may differ if the rest of the item is there.
            if in_order(self.words, words) >= len(self.words) - 1:
                rest = (len(self.words) - 1) / len(self.words)
                question = max(question, rest) if question > 0 else question
                answer = max(answer, rest) if answer > 0 else answer
        return question, answer


class Index:
    """Units of items with dense impacts per block."""

    def __init__(self, items: list[tuple[int, str]], frequencies: dict[bytes, int], total: int, mean: float):
        self.items = [Item(i, w, *question_and_answer(t, w)) for i, t in items if (w := words_of(t))]
        units = []
        for place, item in enumerate(self.items):
            pieces = max(1, -(-len(item.words) // UNIT_WORDS))
            step = -(-len(item.words) // pieces)
            units += [(place, item.words[k:k + step]) for k in range(0, len(item.words), step)]
        # Units of like words side by side: a block's bound is then close to its units' scores.
        units.sort(key=lambda u: (min(u[1], key=lambda w: (frequencies.get(w, 1), w)), u[0]))
        self.of_unit = np.array([p for p, _ in units], np.int64)
        self.terms: dict[bytes, int] = {}
        rows, columns, values = [], [], []
        for u, (_, words) in enumerate(units):
            counts: dict[bytes, int] = {}
            for w in words:
                counts[w] = counts.get(w, 0) + 1
            impacts = {
                w: np.log(1 + (total - frequencies.get(w, 1) + 0.5) / (frequencies.get(w, 1) + 0.5))
                * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean)) for w, n in counts.items()
            }
            own = sum(impacts.values())
            for w, x in impacts.items():
                rows.append(self.terms.setdefault(w, len(self.terms)))
                columns.append(u)
                values.append(x / own)
        blocks = -(-len(units) // BLOCK_UNITS)
        self.rows, self.columns = np.array(rows, np.int64), np.array(columns, np.int64)
        self.values, self.blocks = np.array(values, np.float32), blocks
        self.bounds = self._dense(self.columns // BLOCK_UNITS, blocks)
        order = np.argsort(self.columns, kind="stable")
        self.rows, self.columns, self.values = self.rows[order], self.columns[order], self.values[order]
        self.starts = np.searchsorted(self.columns, np.arange(blocks + 1) * BLOCK_UNITS)

    def _dense(self, columns: np.ndarray, width: int) -> np.ndarray:
        """Largest impact per term and column; the last row, for words that no item has, is 0."""
        table = np.zeros((len(self.terms) + 1, width), np.float32)
        np.maximum.at(table, (self.rows, columns), self.values)
        return table

    def impacts(self, block: int) -> np.ndarray:
        part = slice(self.starts[block], self.starts[block + 1])
        table = np.zeros((len(self.terms) + 1, BLOCK_UNITS), np.float32)
        table[self.rows[part], self.columns[part] - block * BLOCK_UNITS] = self.values[part]
        return table

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_opened"}

    def opened(self, block: int) -> np.ndarray:
        """Impacts of a block's units; the last few blocks are kept."""
        kept = self.__dict__.setdefault("_opened", {})
        if block not in kept:
            if len(kept) >= 64:
                kept.clear()
            kept[block] = self.impacts(block)
        return kept[block]

    def candidates(self, words: list[bytes], threshold: float) -> dict[int, tuple[float, int]]:
        """Per item found its best score over passages and units, and the first word of that passage."""
        found: dict[int, tuple[float, int]] = {}
        if not self.items or not words:
            return found
        none = len(self.terms)
        get = self.terms.get
        ids = np.fromiter((get(w, none) for w in words), np.int32, len(words))
        step = PASSAGE_WORDS // 2
        passages = max(1, -(-(len(ids) - step) // step))
        padded = np.full((passages + 1) * step, none, np.int32)
        padded[:len(ids)] = ids
        for begin in range(0, passages, 1024):
            windows = np.lib.stride_tricks.sliding_window_view(padded, PASSAGE_WORDS)[::step][begin:begin + 1024]
            windows = np.sort(windows, axis=1)  # each term of a passage counts once
            windows[:, 1:][windows[:, 1:] == windows[:, :-1]] = none
            bound = np.zeros((len(windows), self.blocks), np.float32)
            for k in range(0, len(windows), 64):
                bound[k:k + 64] = self.bounds[windows[k:k + 64]].sum(axis=1)
            reached = bound >= threshold - 1e-4
            for block in np.flatnonzero(reached.any(axis=0)):
                which = np.flatnonzero(reached[:, block])
                scores = self.opened(int(block))[windows[which]].sum(axis=1)
                for row, unit in zip(*np.nonzero(scores >= threshold)):
                    item = int(self.of_unit[block * BLOCK_UNITS + unit])
                    score = float(scores[row, unit])
                    if item not in found or score > found[item][0]:
                        found[item] = (score, int(begin + which[row]) * step)
        return found

    def hits(self, text: str | None, threshold: float, overlap: float) -> list[dict]:
        words, hits = words_of(text), []
        for place, (score, first) in sorted(self.candidates(words, threshold).items()):
            question, answer = self.items[place].overlaps(words)
            if question >= overlap and answer >= overlap:
                hits.append({
                    "item_id": self.items[place].item_id, "score": score, "question_overlap": question,
                    "answer_overlap": answer, "first_word": first,
                })
        return hits


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of at most about ``INDEX_BYTES`` of item text each; term statistics are those of all items."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), "text")
    size, total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    parts = max(1, -(-size // INDEX_BYTES))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))

    @F.udf("array<binary>")
    def distinct_words(text: str) -> list[bytes]:
        return sorted(set(words_of(text)))

    terms = dealt.select("part", F.explode(distinct_words("text")).alias("term"))
    counts = terms.groupBy("term").agg(F.count("*").alias("n"))
    for part in range(parts):
        mine = dealt.where(F.col("part") == part).select("item_id", "text").collect()
        mine = sorted(map(tuple, mine), key=lambda item: (item[0] is None, item[0] or 0, item[1]))
        own = counts if parts == 1 else counts.join(terms.where(F.col("part") == part), "term", "left_semi")
        frequencies = {bytes(r[0]): r[1] for r in own.collect()}
        yield Index(mine, frequencies, total, UNIT_WORDS / 2)


def _scanning(shared: Broadcast, threshold: float, overlap: float) -> Callable[[str, str], Column]:
    """Hits of earlier indexes and those of this one. Of a row, Python gets the text and these hits only."""

    @F.arrow_udf(HITS)
    def scan(texts: pa.Array, earlier: pa.Array) -> pa.Array:
        new = [(old.as_py() or []) + shared.value.hits(t.as_py(), threshold, overlap) for t, old in zip(texts, earlier)]
        return pa.array(new, HITS_TYPE)

    return scan


def with_hits(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, name: str = "hits",
) -> DataFrame:
    """``docs``, all columns, plus array ``name`` of the benchmark items that a document's passages contain.

    An item counts if a passage scores at least ``threshold`` of a unit's own BM25 score and the document holds at least
    ``overlap`` both of its question and of its answer, or of the whole item if it has no question mark with words on
    both sides: of the five-word shingles, or of the words in order within one stretch a quarter longer. Of questions
    and answers under five words one word may differ if all other words of the item are there in order; an answer of
    one word must be there. Null and empty texts, and any text beside an empty benchmark, have no hits; items without
    text are never hit, items without id are hit like others. Repeated rows are judged alike. Documents are read once per index and never shuffled.
    """
    if name in docs.columns:
        raise ValueError(f"documents have a column {name} already")
    result = docs.withColumn(name, F.lit(None).cast(HITS))
    for index in indexes(benchmark):
        scan = _scanning(docs.sparkSession.sparkContext.broadcast(index), threshold, overlap)
        result = result.withColumn(name, scan("text", name))
    return result


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found: ``doc_id`` and the fields of a hit."""
    return with_hits(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without hits, with their own columns, whatever these are called.

    Null and empty texts stay, and all documents beside an empty benchmark. Repeated rows are judged alike, texts of any
    length whole; an empty table stays empty.
    """
    rows = docs.select(F.struct("*").alias("row"), "text")
    return with_hits(rows, benchmark).where(F.size("hits") == 0).select("row.*")
