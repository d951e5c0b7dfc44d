"""From raw documents to token files: language, near copies, benchmark leaks, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)``; its result is written to the shared folder and read again as the next one's
documents, so a lost executor costs no earlier stage. Stages keep all columns of the documents under any names, take texts of
any length whole, treat repeated rows as documents of their own, and turn an empty table into an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import decontamination, language, mixing, near_copies, token_files
from marketloom.llm.common import stored, table


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and those without letters go."""
    return language.accepted(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; null texts and those without words all stay."""
    return near_copies.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null texts hold none."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those without words are never taken."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the written token files hold: per document start, tokens and checksum; null texts are the end id alone."""
    return token_files.tokenized(docs)


STAGES = [
    ("language", in_known_language),
    ("near_copies", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mix", mixed),
    ("tokens", token_ids),
]

ORACLE_SQL = None
"""Naive Bayes and the tokenizer have no SQL form: tests/llm compares the stages with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
