"""What several corpus operators share: distributed running totals, bounded samples, word patterns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketloom.operators.ranking import written

WORD = r"[^\x20\x09-\x0D]+"
"""A word: a run of bytes other than ASCII white space."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ROWS_PER_PART = 20_000
"""Rows that one window of ``running_starts`` ranks; the number of windows grows with the rows."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as Parquet in the folder that all executors share; a lost executor reads it again from there."""
    return written(df, purpose)


def utf8_bytes(text: Column | str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def unsigned_crc32(text: Column | str) -> Column:
    """crc32 of the UTF-8 bytes, of no bytes if null."""
    return F.crc32(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))).cast("long")


def sampled(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``: the same ones in every run, all if there are no more."""
    total = df.count()
    if total <= rows:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) < F.lit(int(rows / total * (1 << 40))))


def running_starts(df: DataFrame, group: list[str], order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` plus, per name in ``sums``, the exclusive running total within ``group``, gapless over all its rows.

    ``order[0]`` must be a 64-bit hash: its leading bits deal the rows of a group into windows of about
    ``ROWS_PER_PART`` rows, in order, so that no group needs one task. ``df`` is read three times: store it first.
    Columns of ``group`` must not be null.
    """
    bits = max(0, math.ceil(math.log2(max(1, df.count()) / ROWS_PER_PART)))
    part = F.shiftright(F.col(order[0]), 64 - bits) if bits else F.lit(0).cast("long")
    parted = df.withColumn("_part", part)
    keys = [*group, "_part"]
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parted.groupBy(*keys).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()]).select(
        *keys, *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums]
    )
    local = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parted.join(offsets, keys).select(
        *df.columns,
        *[(F.col(f"_before_{n}") + F.coalesce(F.sum(c).over(local), F.lit(0))).alias(n) for n, c in sums.items()],
    )
