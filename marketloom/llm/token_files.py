"""Token files: concatenated token ids with Elias-Fano encoded document boundaries.

Documents are range-partitioned by id; each task encodes its documents and writes segments. A segment is one binary
value: a header, Elias-Fano lists of the documents' ends and ids, and the token ids. Segments lie in a Parquet
table in the shared folder, so that any store that Spark writes can hold them and Spark's commit protocol covers lost
executors. Beside the payload stand the few numbers by which a reader finds its place.

Segment layout, little-endian: ``MLT1``, documents u32, documents without id u32, token ids u64, width u8 (bytes per
token id), least document id i64, two Elias-Fano lists (ends; ids less the least one), token ids.
Elias-Fano list: count u32, low bits u8, bytes of lows u32, bytes of highs u32, samples u32, lows, highs, samples.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marketloom.session import new_folder

END_ID = 0
"""The id appended to each document."""

SEGMENT_IDS = 1 << 20
"""A segment is closed once it holds so many token ids; a longer document has a segment of its own."""

PART_BYTES = 128 << 20
"""Text bytes per range partition, unless the session's shuffle partitions ask for more parts."""

CACHED_PARTS = 100_000
"""Encoded parts that a worker keeps, twice at most: about 40 MB. What one call needs comes on top."""

CACHED_BYTES = 64
"""Longer parts hardly recur and aren't kept."""

SAMPLE = 64
"""Every so many entries a select sample holds the position of its bit."""


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing list of integers: low bits packed, high parts in unary, with samples for select."""

    count: int
    low_bits: int
    lows: bytes
    highs: bytes
    samples: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values``: uint64, not decreasing."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        lows = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        highs = np.zeros(int(ones[-1]) + 1, np.uint8)
        highs[ones] = 1
        return cls(
            n, bits, lows.tobytes(), np.packbits(highs, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes()
        )

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        begin, end = first * self.low_bits, last * self.low_bits
        packed = np.frombuffer(self.lows, np.uint8)[begin // 8:-(-end // 8)]
        bits = np.unpackbits(packed, bitorder="little")[begin % 8:begin % 8 + end - begin].reshape(-1, self.low_bits)
        return (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.highs, np.uint8), bitorder="little"))[:self.count]
        return ((ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.count)

    def select(self, i: int) -> int:
        """Entry ``i``: from the sample before it, bits are read up to the next sample only."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        samples, highs = np.frombuffer(self.samples, "<u4"), np.frombuffer(self.highs, np.uint8)
        begin = int(samples[i // SAMPLE])
        end = int(samples[i // SAMPLE + 1]) + 1 if i // SAMPLE + 1 < len(samples) else len(highs) * 8
        bits = np.unpackbits(highs[begin // 8:-(-end // 8)], bitorder="little")[begin % 8:]
        one = begin + int(np.flatnonzero(bits)[i % SAMPLE])
        return ((one - i) << self.low_bits) | int(self._low(i, i + 1)[0])

    def to_bytes(self) -> bytes:
        head = struct.pack("<IBIII", self.count, self.low_bits, len(self.lows), len(self.highs), len(self.samples))
        return head + self.lows + self.highs + self.samples

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        count, bits, *sizes = struct.unpack_from("<IBIII", data, at)
        at, fields = at + 17, []
        for size in sizes:
            fields.append(bytes(data[at:at + size]))
            at += size
        return cls(count, bits, *fields), at


@dataclass(frozen=True)
class Segment:
    doc_ids: list
    """Ascending, None at the end."""

    ends: EliasFano
    ids: np.ndarray

    @classmethod
    def pack(cls, doc_ids: list, lengths: list[int], ids: bytes, width: int) -> bytes:
        """``ids``: token ids as little-endian unsigned 32-bit integers."""
        known = [d for d in doc_ids if d is not None]
        least = known[0] if known else 0
        ends = EliasFano.of(np.cumsum(lengths, dtype=np.uint64))
        numbers = EliasFano.of(np.array([d - least for d in known], np.uint64))
        stored = np.frombuffer(ids, "<u4").astype(f"<u{width}")
        head = b"MLT1" + struct.pack("<IIQBq", len(doc_ids), len(doc_ids) - len(known), len(stored), width, least)
        return head + ends.to_bytes() + numbers.to_bytes() + stored.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> Segment:
        if data[:4] != b"MLT1":
            raise ValueError("not a token segment")
        docs, missing, n_ids, width, least = struct.unpack_from("<IIQBq", data, 4)
        ends, at = EliasFano.read(data, 29)
        numbers, at = EliasFano.read(data, at)
        ids = np.frombuffer(data, f"<u{width}", n_ids, at).astype("<u4")
        return cls([int(d) + least for d in numbers.all()] + [None] * missing, ends, ids)

    def document(self, i: int) -> np.ndarray:
        """Token ids of the i-th document, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0:self.ends.select(i)]


class Encoder:
    """Encodes texts by parts that a byte-level tokenizer never joins: words with the blank before them, digits, punctuation.

    Parts are cut and compared as bytes, many texts at a time, and each different one is looked up once. Parts recur, so
    most come from a cache; new ones go to the tokenizer's model in one call. Where a text has other characters, or other
    white space than one blank or line break, all from the blank before to the next blank before a visible character,
    where tokens always begin, is encoded as it stands, as rules may reach further there. With a tokenizer of another kind
    that holds for whole texts.
    """

    LETTERS, DIGITS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9", r"!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"
    ODD, LETTER, DIGIT, MARK, BLANK, LINE, END = range(7)
    """Kinds of bytes. END stands behind each text, as a byte that UTF-8 hasn't."""

    STOP = b"\xff"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        settings = json.loads(self.tokenizer.to_str())
        kind = settings["pre_tokenizer"] or {}
        self.by_parts = (
            kind.get("type") == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"]
            and settings["normalizer"] is None and settings["post_processor"] is None and not settings["model"].get("dropout")
        )
        ascii_ = "".join(map(chr, range(128)))
        self.kinds = np.full(256, self.ODD, np.uint8)
        for number, which in ((self.LETTER, self.LETTERS), (self.DIGIT, self.DIGITS), (self.MARK, self.MARKS)):
            self.kinds[[ord(c) for c in re.findall(f"[{which}]", ascii_)]] = number
        self.kinds[[0x20, 0x0A, 0xFF]] = self.BLANK, self.LINE, self.END
        self.unseen = np.zeros(256, bool)
        self.unseen[[ord(c) for c in ascii_ if c.isspace()] + [0xFF]] = True
        self.blanks = np.isin(np.arange(7), (self.BLANK, self.LINE, self.END))
        # The model takes bytes spelled as visible characters; how, the tokenizer's own first step tells.
        spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelling = np.zeros(256, "<u4")
        for c in map(chr, range(32, 256)):
            self.spelling[list(c.encode())] = [ord(x) for x in spelled.pre_tokenize_str(c)[0][0]]
        self.spelling[0x0A] = 0x0A
        self.model.pre_tokenizer = None
        self.token_bytes = np.array([
            len(self.model.id_to_token(k) or "") for k in range(self.model.get_vocab_size())
        ] if self.by_parts else [], np.int64)
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _gaps(self, data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Places of the blanks before visible characters."""
        gaps = np.flatnonzero(kinds[:-1] == self.BLANK)
        gaps = gaps[~self.unseen[data[gaps + 1]]]
        # White space outside ASCII: U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
        rare = np.flatnonzero(np.isin(data[gaps + 1], (0xC2, 0xE1, 0xE2, 0xE3)))
        lead, second, third = (data[np.minimum(gaps[rare] + k, len(data) - 1)] for k in (1, 2, 3))
        space = (lead == 0xC2) & np.isin(second, (0x85, 0xA0)) | (lead == 0xE1) & (second == 0x9A) & (third == 0x80)
        space |= (lead == 0xE2) & (second == 0x80) & ((third <= 0x8A) | np.isin(third, (0xA8, 0xA9, 0xAF)))
        space |= (lead == 0xE2) & (second == 0x81) & (third == 0x9F) | (lead == 0xE3) & (second == 0x80) & (third == 0x80)
        return np.delete(gaps, rare[space])

    def _split(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the parts of texts begin, and which of them need the whole tokenizer; each text's END is a part."""
        kinds = self.kinds[data]
        leads = np.flatnonzero(data == 0xC3)  # À to ÿ, but not × and ÷
        kinds[leads] = kinds[leads + 1] = np.where(np.isin(data[leads + 1], (0x97, 0xB7)), self.ODD, self.LETTER)
        after, before = np.append(kinds[1:], self.END), np.insert(kinds[:-1], 0, self.END)
        blank, line, end = kinds == self.BLANK, kinds == self.LINE, kinds == self.END
        odd = (kinds == self.ODD) | blank & self.blanks[after] | line & (after == self.LINE)
        stretch = end | (before == self.END)
        stretch[self._gaps(data, kinds)] = True
        starts = np.flatnonzero(stretch | blank | line | (kinds != before) & (before != self.BLANK))
        first = stretch[starts]
        stretch_of = np.cumsum(first) - 1
        whole = np.zeros(int(first.sum()), bool)
        whole[np.searchsorted(starts[first], np.flatnonzero(odd), "right") - 1] = True
        whole = whole[stretch_of]
        kept = first | ~whole
        return starts[kept], whole[kept]

    def _modelled(self, parts: list[bytes]) -> list[bytes]:
        """Ids by the model alone. Tokens spell their parts, so the tokens' bytes tell where one part ends."""
        words = self.spelling[np.frombuffer(b"\n".join(parts), np.uint8)].tobytes().decode("utf-32-le").split("\n")
        ids = self.model.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids
        ids, sizes = np.array(ids, "<u4"), np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        reached = np.cumsum(self.token_bytes[ids])
        ends = np.searchsorted(reached, sizes) + 1
        if ends[-1] != len(ids) or (reached[ends - 1] != sizes).any():  # a vocabulary without some of the bytes
            found = self.model.encode(words, is_pretokenized=True, add_special_tokens=False)
            ends = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(parts)))
        flat, ends = ids.tobytes(), (ends * 4).tolist()
        return [flat[begin:end] for begin, end in zip([0, *ends], ends)]

    def _ids(self, parts: list[bytes], whole: np.ndarray) -> list[bytes]:
        """Ids of different parts. The cache keeps about the last ``CACHED_PARTS`` to twice as many short ones."""
        if len(self.cache) > CACHED_PARTS:
            self.cache, self.older = {}, self.cache
        self.cache[self.STOP] = b""
        ids = list(map(self.cache.get, parts))
        new = [k for k, known in enumerate(ids) if known is None]
        for k, known in zip(new, [self.older.get(parts[k]) for k in new]):
            if known is not None:
                ids[k] = self.cache[parts[k]] = known
        new = [k for k in new if ids[k] is None]
        odd = [k for k in new if whole[k] or parts[k] == b"\n"]
        for k, found in zip(odd, self._whole([parts[k].decode() for k in odd])):
            ids[k] = found
        plain = [k for k in new if ids[k] is None]
        for begin in range(0, len(plain), 50_000):
            some = plain[begin:begin + 50_000]
            for k, found in zip(some, self._modelled([parts[k] for k in some])):
                ids[k] = found
        self.cache.update((parts[k], ids[k]) for k in new if len(parts[k]) <= CACHED_BYTES)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its token ids as little-endian unsigned 32-bit integers."""
        if not self.by_parts:
            return self._whole(texts)
        if not texts:
            return []
        raw = self.STOP.join([*map(str.encode, texts), b""])
        data = np.frombuffer(raw, np.uint8)
        starts, whole = self._split(data)
        ends = np.append(starts, len(data))
        parts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw)]
        ).dictionary_encode()
        which = parts.indices.to_numpy()
        odd = np.zeros(len(parts.dictionary), bool)
        odd[which] = whole
        _, places, content = parts.dictionary.buffers()
        places, content = np.frombuffer(places, np.int64, len(odd) + 1).tolist(), content.to_pybytes()
        found = self._ids([content[begin:end] for begin, end in zip(places, places[1:])], odd)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        size = sizes[which]
        ends = np.cumsum(size)
        places = np.repeat(begins[which] - ends + size, size)
        places += np.arange(len(places))
        ids = np.frombuffer(b"".join(found), "<u4")[places].tobytes()
        ends = (ends[data[starts] == 0xFF] * 4).tolist()
        return [ids[begin:end] for begin, end in zip([0, *ends], ends)]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker, with its cache."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path)


def _texts(values: pd.Series, most: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of together some MB, with the place of the first."""
    begin, size, texts = 0, 0, []
    for k, value in enumerate(values):
        texts.append(value or "")
        size += len(texts[-1])
        if size >= most:
            yield begin, texts
            begin, size, texts = k + 1, 0, []
    if texts:
        yield begin, texts


def write_tokens(docs: DataFrame, folder: str, path: str) -> None:
    """Writes the token table of ``docs`` (``doc_id``, ``text``) to ``folder``, in ascending ``doc_id`` order, nulls last."""
    session = docs.sparkSession
    end = np.array([END_ID], "<u4").tobytes()

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seq, before, encoding = TaskContext.get().partitionId(), 0, 0, encoder(path)
        doc_ids, lengths, ids = [], [], bytearray()

        def closed() -> pd.DataFrame:
            data = Segment.pack(doc_ids, lengths, ids, encoding.width)
            return pd.DataFrame({
                "part": [part], "seq": [seq], "before": [before], "n_docs": [len(doc_ids)], "n_ids": [len(ids) // 4], "segment": [data],
            })

        for batch in batches:
            numbers = [None if pd.isna(d) else int(d) for d in batch["doc_id"].astype("object")]
            for begin, texts in _texts(batch["text"]):
                for doc_id, encoded in zip(numbers[begin:], encoding.encode(texts)):
                    doc_ids.append(doc_id)
                    lengths.append(len(encoded) // 4 + 1)
                    ids += encoded + end
                    if len(ids) >= 4 * SEGMENT_IDS:
                        yield closed()
                        before += len(ids) // 4
                        doc_ids, lengths, ids, seq = [], [], bytearray(), seq + 1
        if doc_ids:
            yield closed()

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInPandas(
        segments, "part int, seq int, before long, n_docs long, n_ids long, segment binary"
    ).write.parquet(folder)


def read_tokens(session: SparkSession, folder: str) -> DataFrame:
    """Segments with ``first``: the ids of all documents before them.

    A segment knows the ids before it in its part, so only the parts, one row for each writing task, are added up and
    broadcast; segments aren't shuffled.
    """
    segments = session.read.parquet(folder)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part")
    )
    return segments.join(F.broadcast(parts), "part").withColumn("first", F.col("before_part") + F.col("before"))


def document_digests(segments: DataFrame) -> DataFrame:
    """Per document of the read segments ``doc_id, start, n_tokens, ids_crc32``."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, data in zip(batch["first"], batch["segment"]):
                segment = Segment.unpack(data)
                ends = segment.ends.all().astype(np.int64)
                starts, ids = np.concatenate([[0], ends[:-1]]), segment.ids
                yield pd.DataFrame({
                    "doc_id": pd.array(segment.doc_ids, "Int64"), "start": starts + first, "n_tokens": ends - starts,
                    "ids_crc32": [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)],
                })

    return segments.select("first", "segment").mapInPandas(digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encodes whole texts, writes them to the shared folder, and returns per document what the files hold.

    ``doc_id, start`` (ids of all documents before), ``n_tokens`` (with the end id), ``ids_crc32``. A null or empty text
    has the end id only; null ids come last, equal ids in the order of their texts' hashes; repeated rows are separate
    documents; an empty table gives no rows. Other columns are ignored.
    """
    session = docs.sparkSession
    folder = new_folder(session, "tokens")
    write_tokens(docs, folder, path or vocabulary())
    return document_digests(read_tokens(session, folder))
