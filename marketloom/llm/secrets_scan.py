"""Secret scans: candidates by pattern, false positives removed by a random forest.

Tasks cut candidates from whole texts and measure them; the forest is Spark's own, trained on a bounded sample of labelled
findings. A table of reviewed findings can be passed; without one, findings whose format or assignment settles the matter
are the labels, and the forest carries that over to the rest.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from marketloom.llm.common import sampled, stored

# Words that stand before a secret, and formats that name their issuer.
KEYWORDS = ("password", "passwd", "pwd", "token", "secret", "apikey", "api_key", "api-key", "access_key", "auth", "bearer", "credential")
FORMATS = (r"AKIA[0-9A-Z]{16}", r"ghp_[0-9A-Za-z]{36}", r"xox[abp]-[0-9A-Za-z-]{10,}", r"sk_live_[0-9A-Za-z]{16,}")

# A keyword begins a name or a part of it: after anything but a letter, or by a capital after a small letter.
_begin = r"(?:(?<![^\W\d_])|(?<=[a-z])(?=[A-Z]))"
_assigned = re.compile(_begin + "(?i:" + "|".join(KEYWORDS) + r")\b[\"']?\s{0,3}(?:=|:|(?i:is))\s{0,3}[\"']?([^\s\"',;<>]{6,})")
_bare = re.compile(r"[A-Za-z0-9+/_\-]{16,}={0,2}")
_format = re.compile("|".join(f"(?:{f})" for f in FORMATS))
_word = re.compile(r"[^\W\d_]+")

FEATURES = (
    "length", "transitions", "digits", "uppers", "entropy", "coverage", "longest_word", "path_parts", "hex", "known_format",
    "keyword_before", "assigned", "quoted", "words_around",
)
TRAIN_FINDINGS = 20_000
DICTIONARY_SHARE = 0.005
"""Words in at least this share of the documents: at most 200 times as many as a document has distinct words on average."""

TREES, DEPTH = 30, 8
SCHEMA = "doc_id long, begin long, length int, kind string, value string, features array<double>, seed double"


def entropy(value: str) -> float:
    """Bits per character."""
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts) if value else 0.0


def _class(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def covered(value: str, dictionary: frozenset[str]) -> float:
    """Share of the characters that dictionary words of 3 to 12 letters cover."""
    low, marks = value.lower(), bytearray(len(value))
    for size in range(3, 13):
        for k in range(len(low) - size + 1):
            if low[k:k + size] in dictionary:
                marks[k:k + size] = b"\1" * size
    return sum(marks) / max(1, len(value))


def measure(text: str, begin: int, value: str, assigned: bool, dictionary: frozenset[str]) -> list[float]:
    before, after = text[max(0, begin - 60):begin], text[begin + len(value):begin + len(value) + 60]
    near = [w.lower() for w in _word.findall(before)[-2:]]
    classes = [_class(c) for c in value]
    n = len(value)
    return [
        float(n), sum(a != b for a, b in zip(classes, classes[1:])) / max(1, n - 1), classes.count(2) / n, classes.count(1) / n,
        entropy(value), covered(value, dictionary), max(map(len, _word.findall(value)), default=0) / n,
        float(value.count("/") + value.count(".")), float(all(c in "0123456789abcdefABCDEF" for c in value)),
        float(bool(_format.fullmatch(value))), float(any(w in KEYWORDS for w in near)), float(assigned),
        float(before[-1:] in ("'", '"')), float(sum(w in dictionary for w in near + [w.lower() for w in _word.findall(after)[:2]])),
    ]


def seed_label(value: str, assigned: bool) -> float | None:
    """1.0 or 0.0 where format or assignment settles it, else None."""
    if _format.fullmatch(value):
        return 1.0
    digits = any(c.isdigit() for c in value)
    if assigned and digits and entropy(value) >= 2.5:
        return 1.0
    return 0.0 if not digits else None


def found(text: str) -> list[tuple[int, str, bool]]:
    """``begin, value, assigned`` of all candidates; an assigned one hides a bare one at the same place."""
    by_place = {m.start(1): (m.start(1), m.group(1), True) for m in _assigned.finditer(text)}
    taken = {k for b, v, _ in by_place.values() for k in range(b, b + len(v))}
    for m in _bare.finditer(text):
        if m.start() not in taken:
            by_place[m.start()] = (m.start(), m.group(), False)
    return sorted(by_place.values())


def dictionary_of(docs: DataFrame) -> frozenset[str]:
    """The words of three to twelve letters in at least ``DICTIONARY_SHARE`` of all documents, counted on the map side."""
    texts = docs.where("text is not null")
    words = texts.select(
        F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\b(\p{L}{3,12})\b")))).alias("word")
    )
    common = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= DICTIONARY_SHARE * texts.count())
    return frozenset(r[0] for r in common.select("word").collect())


def candidates(docs: DataFrame) -> DataFrame:
    """All candidates of whole texts with ``FEATURES`` and the seed label."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary_of(docs))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"]):
                for begin, value, assigned in found(text or ""):
                    rows.append((
                        doc_id, begin, len(value), "assigned" if assigned else "bare", value,
                        measure(text, begin, value, assigned, shared.value), seed_label(value, assigned),
                    ))
            out = pd.DataFrame(rows, columns=["doc_id", "begin", "length", "kind", "value", "features", "seed"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(scan, SCHEMA)


def train(labelled: DataFrame):
    """A forest on ``features`` (array) and ``label``."""
    rows = labelled.select(array_to_vector("features").alias("features"), "label")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11, minInstancesPerNode=2).fit(rows)


def secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Findings that remain: ``doc_id, begin`` (character), ``length, kind, value_sha256, probability``.

    ``findings``: reviewed findings ``doc_id, begin, is_secret``. Without both kinds of labels nothing can be learned and the
    seed labels decide, 0 where there is none. Null and empty texts have no findings, repeated rows the same ones each;
    a null ``doc_id`` is kept. Candidates are whole values of any length. Columns besides ``doc_id`` and ``text`` are ignored.
    """
    rows = stored(candidates(docs), "secret-candidates")
    if findings is None:
        labelled = rows.where("seed is not null").withColumn("label", F.col("seed"))
    else:
        known = findings.select("doc_id", "begin", F.col("is_secret").cast("double").alias("label"))
        labelled = rows.join(known, ["doc_id", "begin"])
    labelled = sampled(labelled, F.struct("doc_id", "begin"), TRAIN_FINDINGS)
    kinds = labelled.agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        scored = rows.withColumn("probability", F.coalesce("seed", F.lit(0.0)))
    else:
        model = train(labelled.persist())
        scored = model.transform(rows.withColumn("features", array_to_vector("features"))).withColumn(
            "probability", vector_to_array("probability")[1]
        )
    return scored.where(F.col("probability") >= threshold).select(
        "doc_id", "begin", "length", "kind", F.sha2("value", 256).alias("value_sha256"), "probability"
    )
