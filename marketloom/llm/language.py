"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are added up per task with numpy; the matrix of log probabilities (languages x buckets) is broadcast and texts
are scored in batches by gathering its rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marketloom.llm.common import sampled

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
TRAIN_DOCUMENTS = 20_000
MOST_LANGUAGES = 256
"""The matrix has at most this many rows of ``BUCKETS`` doubles: 64 MB."""

UNDETERMINED = "und"
STEP = 1 << 16
"""Characters of a text handled at once, so that a very long text needs no more memory than a short one."""

_other = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column | str) -> Column:
    """Documents that no model learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def letters(text: str | None) -> str:
    """Lower-cased, runs of anything but letters as one blank; empty without a letter."""
    cleaned = _other.sub(" ", (text or "").lower())
    return f" {cleaned} " if any(c.isalpha() for c in set(cleaned)) else ""


def gram_buckets(cleaned: str) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams, in pieces; neighbouring pieces overlap so that no n-gram is lost."""
    for begin in range(0, len(cleaned), STEP):
        points = np.frombuffer(cleaned[begin:begin + STEP + GRAMS[-1] - 1].encode("utf-32-le", "replace"), np.uint32)
        points = points.astype(np.uint64)
        for n in GRAMS:
            size = min(STEP, len(points) - n + 1)
            if size <= 0:
                continue
            mixed = np.full(size, n, np.uint64)
            for k in range(n):
                mixed = mixed * np.uint64(0x100000001B3) + points[k:k + size]
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            yield (mixed >> np.uint64(64 - 15)).astype(np.int64)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            total = sums.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            total[BUCKETS] += 1
            for buckets in gram_buckets(letters(text)):
                total[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
    for lang, total in sums.items():
        used = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": used, "n": total[used]})


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    priors: np.ndarray
    weights: np.ndarray
    """Log probability per bucket and language, a row per bucket."""

    def scores(self, text: str | None) -> np.ndarray | None:
        """Posterior probability per language; None if the text has no letter or nothing was learned."""
        cleaned = letters(text)
        if not cleaned or not self.languages:
            return None
        total = self.priors.copy()
        for buckets in gram_buckets(cleaned):
            total += self.weights[buckets].sum(axis=0)
        total = np.exp(total - total.max())
        return total / total.sum()


def train(docs: DataFrame, rows: int = TRAIN_DOCUMENTS) -> Model:
    """Learns from ``text`` and ``lang`` of at most about ``rows`` documents with a language that aren't held out."""
    known = docs.where(F.col("lang").isNotNull() & ~held_out("doc_id"))
    chosen = sampled(known.select("doc_id", "text", "lang"), F.col("doc_id"), rows)
    counts = (
        chosen.select("text", "lang").mapInPandas(_counts, "lang string, bucket long, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )
    languages = tuple(sorted(r[0] for r in chosen.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()))
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: raise MOST_LANGUAGES, the size of the broadcast matrix")
    table = np.zeros((BUCKETS + 1, len(languages)))
    place = {lang: k for k, lang in enumerate(languages)}
    found = counts.toPandas()  # at most languages x buckets rows
    table[found["bucket"].to_numpy(np.int64), [place[x] for x in found["lang"]]] = found["n"].to_numpy(np.float64)
    documents, smoothed = table[BUCKETS], table[:BUCKETS] + 0.5
    priors = np.log((documents + 1) / (documents.sum() + max(1, len(languages))))
    return Model(languages, priors, np.log(smoothed / smoothed.sum(axis=0)) if languages else smoothed)


def predicted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the posterior probability (0 for ``und``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model, rows = shared.value, []
        for value in texts:
            scores = model.scores(value)
            best = None if scores is None else int(scores.argmax())
            rows.append((UNDETERMINED, 0.0) if best is None else (model.languages[best], float(scores[best])))
        return pd.DataFrame(rows, columns=["lang_pred", "score"])

    return docs.withColumn("_language", predict(text)).select(
        *docs.columns, F.col("_language.lang_pred").alias("lang_pred"), F.col("_language.score").alias("score")
    )


def identified(docs: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """Per document ``doc_id, held_out, lang_pred, score``; only the text decides.

    A null text or one without a letter, and any text when there is nothing to learn from, is ``und`` with score 0. Ties go
    to the first language by name. Repeated rows are judged alike; other columns are ignored.
    """
    model = train(docs, train_documents)
    return predicted(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model).drop("text")


def accepted(docs: DataFrame, least_score: float = 0.5, train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """The documents, with their own columns, whose language is determined with at least this probability.

    Null texts and texts without a letter go, and all documents if none has a language to learn from. Repeated rows are
    judged alike, texts of any length whole; an empty table stays empty.
    """
    model = train(docs, train_documents)
    judged = predicted(docs.select(F.struct("*").alias("row"), "text"), model)
    return judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)).select("row.*")
