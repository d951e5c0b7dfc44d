"""A small corpus with nulls, empty and long texts, ties, repeated rows and columns with clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("size", T.LongType()),
    T.StructField("hits", T.StringType()), T.StructField("score", T.DoubleType()),
])

WORDS = {
    "en": "the house and river of stone with many small windows by that old garden under tall green trees".split(),
    "de": "das haus und der fluss mit vielen kleinen fenstern über dem alten garten zwischen großen bäumen".split(),
}


def prose(seed: int, lang: str, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", str(rng.randrange(99))]) for _ in range(n))


def rows() -> list[tuple]:
    out = []
    for k in range(60):
        lang = "de" if k % 3 == 0 else "en"
        out.append((k, prose(k, lang, 20 + 7 * k), lang, f"s{k % 4}" if k % 7 else None))
    base = prose(5, "en", 120).split()
    for k in range(60, 70):  # near copies: one word differs
        edited = list(base)
        edited[k - 40] = f"other{k}"
        out.append((k, " ".join(edited), "en", "s0"))
    out += [(70 + k, prose(3, "de", 41), "de", "s1") for k in range(5)]  # exact copies
    out.append(out[-1])  # a repeated row
    out += [(80, None, None, None), (81, "", "en", "s2"), (82, " \n\t ", "en", "s2"), (83, "Word", None, "s3"), (84, "1234 5678", "de", "s3")]
    out += [(85, "ab" * 400, "en", "s1"), (86, "line\n" * 90, "en", "s1"), (87, prose(99, "en", 9000), "en", "s0")]
    out += [(88, "Shared  spaces \n and <|endoftext|> it's 12,5  é", "en", "s1"), (None, prose(77, "en", 60), "en", "s2")]
    return [(*r, len(r[1] or ""), 7, "x", 0.5) for r in out]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)
