"""Exact repeats: bytes covered by a 200-byte string that starts more than once in the corpus.

Each 200-byte window belongs to its anchor, the 64-byte string in it with the least hash. Equal windows have equal anchors,
so only windows of one anchor need to be compared: neighbouring windows of one anchor form a context, the stretch of text
they cover, and contexts of an anchor that occurs once are done with. A context that occurs twice as a whole is
repeated. Of the others, the distinct ones of many anchors are indexed together: suffixes are sorted, the
Burrows-Wheeler transform is cut into runs, and match lengths are computed at the ends of runs only; streaming over the text
gives all others, each one less than the match before it. Windows whose match reaches 200 bytes are repeated. Anchors with
very many distinct contexts are counted window by window instead, with map-side sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marketloom.llm.common import stored

LENGTH = 200
ANCHOR = 64
SPAN = LENGTH - ANCHOR + 1
"""Anchors in a window; also the most windows of one context."""

STEP = 1 << 18
"""Windows of a text that are hashed at once."""

BUCKET_CONTEXTS = 2_000
"""Contexts that one index holds, about."""

MOST_CONTEXTS = 4_000
"""Anchors with more distinct contexts are counted by window."""

KEY = ["doc_id", "text_crc"]
"""What tells documents apart; rows that agree in both are the same text twice."""

_BASE = 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, for texts of ``STEP`` windows."""
    if not _tables:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(STEP + LENGTH + 1, base, np.uint64)
            table[0] = 1
            _tables[name] = np.multiply.accumulate(table)
    return _tables["up"], _tables["down"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of any stretch of a text, from prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[begin]) * self.down[begin])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, from minima within blocks towards both sides."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def contexts_of(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchor, context`` hashes, ``begin``, ``windows`` and ``times`` of each context of a text.

    ``times``: equal contexts that begin at so many neighbouring bytes, in text of one repeated byte, are one entry.
    """
    for offset in range(0, max(0, len(data) - LENGTH + 1), STEP):
        part = data[offset:offset + STEP + LENGTH - 1]
        hashes = Hashes(part)
        anchors = hashes.windows(ANCHOR)
        owner = _least(anchors, SPAN)
        # The next window has another anchor if the least hash changes or this window begins with its anchor.
        change = (owner[1:] != owner[:-1]) | (anchors[:len(owner) - 1] == owner[:-1])
        begin = np.concatenate([[0], np.flatnonzero(change) + 1])
        end = np.append(begin[1:], len(owner))
        anchor, context = owner[begin].view(np.int64), hashes.of(begin, end + LENGTH - 1).view(np.int64)
        new = np.concatenate([[True], (context[1:] != context[:-1]) | (anchor[1:] != anchor[:-1]) | (np.diff(begin) != 1)])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(begin)))
        yield anchor[first], context[first], begin[first] + offset, (end - begin)[first], times


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def occurrences(docs: DataFrame) -> DataFrame:
    """``anchor, context, doc_id, text_crc, begin, windows, times`` of all contexts."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, rows = [], []
            for row, text in enumerate(batch["text"]):
                for part in contexts_of(np.frombuffer(as_bytes(text), np.uint8)):
                    parts.append(part)
                    rows.append(np.full(len(part[0]), row))
            if parts:
                anchor, context, begin, windows, times = map(np.concatenate, zip(*parts))
                which = np.concatenate(rows)
                yield pd.DataFrame({
                    "anchor": anchor, "context": context, "doc_id": batch["doc_id"].array[which],
                    "text_crc": batch["text_crc"].to_numpy()[which], "begin": begin, "windows": windows, "times": times,
                })

    return _keyed(docs).mapInPandas(scan, "anchor long, context long, doc_id long, text_crc int, begin int, windows int, times int")


def _keyed(docs: DataFrame) -> DataFrame:
    crc = F.shiftright(F.xxhash64(F.coalesce("text", F.lit(""))), 32).cast("int").alias("text_crc")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), crc, "text")


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``text`` by their first 512 symbols (longer than any context), by doubling."""
    n = len(text)
    rank = np.zeros(n, np.uint64)
    for k in range(4):
        rank[:n - k] |= text[k:].astype(np.uint64) << np.uint64(16 * (3 - k))
    known = 4
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        new = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if known >= 512 or new[-1] == n - 1:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = new + 1
        further = np.zeros(n, np.uint64)
        further[:max(0, n - known)] = rank[known:]
        rank = (rank << np.uint64(32)) | further
        known *= 2


def _match(text: np.ndarray, room: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Common length of the suffixes at ``p`` and ``q``, within their contexts."""
    most, length = np.minimum(room[p], room[q]), np.zeros(len(p), np.int64)
    open_ = np.arange(len(p))
    steps = np.arange(32)
    while len(open_):
        left, right = p[open_] + length[open_], q[open_] + length[open_]
        end = len(text) - 1
        differs = text[np.minimum(left[:, None] + steps, end)] != text[np.minimum(right[:, None] + steps, end)]
        length[open_] += np.where(differs.any(axis=1), differs.argmax(axis=1), 32)
        open_ = open_[~differs.any(axis=1) & (length[open_] < most[open_])]
    return np.minimum(length, most)


def longest_matches(texts: list[bytes]) -> np.ndarray:
    """For each byte of the concatenated ``texts`` (a separator behind each) the longest match elsewhere.

    A run-compressed transform: where a suffix and its neighbours in order are preceded by the same symbol, its match is
    one shorter than that of the suffix before it; lengths are compared at both ends of each run only.
    """
    sizes = np.array([len(t) for t in texts])
    text = np.zeros(sizes.sum() + len(texts), np.uint16)
    starts = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(len(text), bool)
    inside[starts + sizes] = False
    text[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16) + 1
    room = np.repeat(starts + sizes, sizes + 1) - np.arange(len(text))
    order = _suffix_order(text)
    before = np.where(order > 0, text[order - 1], 0)
    run_start = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
    at = np.flatnonzero(run_start[1:]) + 1  # each run's first row, next to the last row of the run before it
    lengths = _match(text, room, order[at], order[at - 1])
    sampled = np.zeros(len(text), np.int64)
    np.maximum.at(sampled, order[at], lengths)
    np.maximum.at(sampled, order[at - 1], lengths)
    # Streaming: match(p) = max(sample(p), match(p - 1) - 1), a running maximum of sample(p) + p.
    place = np.arange(len(text))
    return np.minimum(np.maximum(np.maximum.accumulate(sampled + place) - place, 0), room)


SPANS = "anchor long, context long, offset int, windows int"


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _indexed(key: tuple, contexts: pd.DataFrame) -> pd.DataFrame:
    contexts = contexts.drop_duplicates(["anchor", "context"])
    texts = [bytes(t) for t in contexts["piece"]]
    matches, rows, at = longest_matches(texts), [], 0
    for anchor, context, text in zip(contexts["anchor"], contexts["context"], texts):
        for b, e in zip(*_runs(matches[at:at + len(text)] >= LENGTH)):
            rows.append((anchor, context, b, e - b))
        at += len(text) + 1
    return pd.DataFrame(rows, columns=["anchor", "context", "offset", "windows"])


def _window_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for anchor, context, piece in zip(batch["anchor"], batch["context"], batch["piece"]):
            found = Hashes(np.frombuffer(bytes(piece), np.uint8)).windows(LENGTH).view(np.int64)
            yield pd.DataFrame({"anchor": anchor, "context": context, "offset": np.arange(len(found)), "window": found})


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text_crc, begin, end``: stretches of bytes that repeated windows cover."""
    rows = occurrences(docs)
    again = rows.groupBy("anchor").agg(F.sum("times").alias("n")).where("n > 1").select("anchor")
    rows = stored(rows.join(again, "anchor"), "repeated-anchors")
    kinds = stored(rows.groupBy("anchor", "context").agg(
        F.sum("times").alias("n"), F.min(F.struct("doc_id", "text_crc", "begin", "windows")).alias("one")
    ), "contexts")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    compared = kinds.join(several, "anchor").select("anchor", "context", "n", "kinds", "one.*")
    # Each document's contexts to look at travel to it in one row.
    wanted = compared.groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "context", "begin", "windows", "kinds")).alias("wanted"))
    pieces = stored(_with_key(docs, wanted, "inner").select(
        F.explode("wanted").alias("w"), F.encode("text", "utf-8").alias("data")
    ).select("w.*", F.substring("data", F.col("w.begin") + 1, F.col("w.windows") + LENGTH - 1).alias("piece")), "pieces")
    few = pieces.where(F.col("kinds") <= MOST_CONTEXTS)
    buckets = few.count() // BUCKET_CONTEXTS + 1
    by_index = few.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).select("bucket", "anchor", "context", "piece")
    by_index = by_index.groupBy("bucket").applyInPandas(_indexed, SPANS)
    many = pieces.where(F.col("kinds") > MOST_CONTEXTS).dropDuplicates(["anchor", "context"]).select("anchor", "context", "piece")
    windows = many.mapInPandas(_window_hashes, "anchor long, context long, offset int, window long")
    twice = windows.groupBy("anchor", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    by_count = windows.join(twice, ["anchor", "window"]).select("anchor", "context", "offset", F.lit(1).alias("windows"))
    single = kinds.where("n = 1").select("anchor", "context", "one.doc_id", "one.text_crc", "one.begin")
    partly = by_index.unionByName(by_count).join(single, ["anchor", "context"]).select(
        *KEY, (F.col("begin") + F.col("offset")).alias("begin"), "windows"
    )
    whole = rows.join(kinds.where("n > 1").select("anchor", "context"), ["anchor", "context"]).select(
        *KEY, "begin", (F.col("windows") + F.col("times") - 1).alias("windows")
    )
    return whole.unionByName(partly).select(*KEY, "begin", (F.col("begin") + F.col("windows") + LENGTH - 1).alias("end"))


def _with_key(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    other = other.withColumnsRenamed({c: f"_{c}" for c in KEY})
    texts = _keyed(docs)
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_crc") == F.col("_text_crc"))
    return texts.join(other, same, how).drop("_doc_id", "_text_crc")


def _kept(data: bytes, spans: np.ndarray) -> tuple[bytes, int]:
    """What stays, and how many maximal stretches go."""
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 1], -1)
    gone = np.cumsum(change[:-1]) > 0
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), len(_runs(gone)[0])


def _spans_of(value) -> np.ndarray:
    return np.array([(s["begin"], s["end"]) for s in value], np.int64).reshape(-1, 2)


def with_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and ``spans``: null, or the stretches to remove (they may overlap)."""
    spans = repeated_spans(docs).groupBy(*KEY).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    return _with_key(docs, spans, "left").select("doc_id", "text", "spans")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Every byte that a repeated 200-byte string covers is removed, first occurrences too; strings are judged on the input. A
    null text is empty; texts under 200 bytes stay. Repeated rows repeat each other. An empty table gives no rows.
    Columns besides ``doc_id`` and ``text`` are ignored.
    """

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, value in zip(batch["text"], batch["spans"]):
                data = as_bytes(text)
                kept, n = (data, 0) if value is None else _kept(data, _spans_of(value))
                rows.append((len(data), len(data) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return with_spans(docs).mapInPandas(digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
