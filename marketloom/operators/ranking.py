"""Ranks, tiles and exact percentiles over data of any size.

``selected`` finds the rows at a few places without sorting the table: samples bracket a place, a pass counts what
lies before and inside, and only the last, small bracket is sorted. Ranks of all rows need more:

a window without PARTITION BY moves every row to one task, so ``running_totals`` range-partitions the rows by the sort key
and writes them to the shared folder; each part then ranks its own rows and adds what the parts before it hold. The
written table fixes which row is in which part, so a lost executor cannot change the offsets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from marketloom.session import new_folder

BRACKET_ROWS = 100_000
"""A bracket of no more rows is sorted by one task."""

SAMPLE_ROWS = 10_000
"""Rows, about, that the driver gets of a larger bracket."""


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_totals(df: DataFrame, group: list[str], order: list, totals: dict[str, Column]) -> DataFrame:
    """``df`` plus, per name in ``totals``, the running total in ``order`` within ``group`` and ``<name>_all``.

    ``order`` should be unique within a group, or equal keys be added up before, so that a frequent key does
    not make one part large.
    """
    # A struct of the group columns is never null, so it joins by plain equality on the window's own keys.
    ranged = written(
        df.withColumn("_group", F.struct(*group) if group else F.lit(0))
        .withColumns({f"_add_{name}": value for name, value in totals.items()})
        # Without a number adaptive execution merges neighbouring small ranges, so parts follow the data's size.
        .repartitionByRange(*group, *order)
        .withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    # One row per part and group: a part holds neighbouring groups, so at most parts + groups rows.
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_group")
    sizes = ranged.groupBy("_part", "_group").agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in totals])
    offsets = sizes.select(
        "_part", "_group",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"{n}_all") for n in totals],
    )
    # Join and window need the same clustering: one shuffle serves both.
    local = Window.partitionBy("_part", "_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(offsets, ["_part", "_group"]).select(
        *df.columns,
        *[(F.col(f"_before_{n}") + F.sum(f"_add_{n}").over(local)).alias(n) for n in totals],
        *[f"{n}_all" for n in totals],
    )


def place(df: DataFrame, order: list[str], values: tuple) -> Column:
    """``values`` as a literal that compares with ``struct(*order)`` of ``df``."""
    return F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, values)])


@dataclass(frozen=True)
class _Bracket:
    """Rows after ``low`` and up to ``high``, in the order of ``name``; None is no limit."""

    name: str
    low: tuple | None = None
    high: tuple | None = None

    def holds(self, df: DataFrame, order: list[str]) -> Column:
        here = F.struct(*order)
        after = F.lit(True) if self.low is None else here > place(df, order, self.low)
        return after if self.high is None else after & (here <= place(df, order, self.high))

    def cut(self, low: tuple, high: tuple) -> list[_Bracket]:
        return [_Bracket(self.name, self.low, low), _Bracket(self.name, low, high), _Bracket(self.name, high, self.high)]


def _around(sample: list[tuple[tuple, int]], share: float) -> tuple[tuple, tuple]:
    """Two rows of a sample with weights that the row at ``share`` of the weight most likely lies between."""
    # Spark's order: nulls first; texts by code point either way.
    sample = sorted(sample, key=lambda row: [(v is not None, 0 if v is None else v) for v in row[0]])
    total, n = sum(w for _, w in sample), len(sample)
    slack = 4 * math.sqrt(max(share * (1 - share), 1 / n) / n)
    low, high, upto = 0, n - 1, 0
    for k, (_, w) in enumerate(sample):
        upto += w
        if upto <= (share - slack) * total:
            low = k
        if upto >= (share + slack) * total:
            high = k
            break
    return sample[low][0], sample[max(high, low)][0]


def selected(
    df: DataFrame, orders: dict[str, list[str]], ranks: dict[str, list[int]], weight: str | None = None,
) -> dict[str, dict[int, Row]]:
    """Per name and 1-based rank the row at that place in the name's order; ``weight`` says how often a row counts.

    An order must tell all rows apart. ``df`` is read once per pass: store it first. A pass cuts every
    bracket at rows of a sample and counts the parts; with brackets of a billion rows there are three passes. The driver
    holds a sample per bracket and the rows that were asked for.
    """
    times = F.lit(1).cast("long") if weight is None else F.col(weight)
    counts = lambda condition: [F.count_if(condition), F.coalesce(F.sum(F.when(condition, times)), F.lit(0))]
    size, total = df.agg(*[c.alias(n) for c, n in zip(counts(F.lit(True)), ("rows", "weight"))]).first()
    # Of each place: its bracket, the weight before and inside, the rows inside.
    places = {(name, r): (_Bracket(name), 0, total, size) for name in orders for r in ranks[name] if 1 <= r <= total}
    round_ = 0
    while wide := {bracket for bracket, _, _, rows in places.values() if rows > BRACKET_ROWS}:
        round_ += 1
        rows_of = {bracket: rows for bracket, _, _, rows in places.values()}
        samples = {}
        for bracket in wide:
            order = orders[bracket.name]
            draw = F.pmod(F.xxhash64(*order, F.lit(round_)), F.lit(1 << 40)) < F.lit(int(SAMPLE_ROWS / rows_of[bracket] * (1 << 40)))
            drawn = df.where(bracket.holds(df, order) & draw).select(F.struct(*order).alias("at"), times.alias("w")).collect()
            samples[bracket] = [(tuple(r["at"]), r["w"]) for r in drawn]
        cuts = {}
        for target, (bracket, before, inside, _) in places.items():
            if bracket in wide and samples[bracket]:
                cuts[target] = bracket.cut(*_around(samples[bracket], (target[1] - before) / inside))
        parts = list(dict.fromkeys(part for found in cuts.values() for part in found))
        columns = [c for part in parts for c in counts(part.holds(df, orders[part.name]))]
        counted = df.agg(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first() if columns else ()
        sizes = {part: (counted[2 * k], counted[2 * k + 1]) for k, part in enumerate(parts)}
        for target, found in cuts.items():
            before = places[target][1]
            for part in found:
                rows, inside = sizes[part]
                if target[1] <= before + inside:
                    places[target] = (part, before, inside, rows)
                    break
                before += inside
    branches, known = [], set()
    for bracket, before, _, _ in places.values():
        if bracket in known:
            continue
        known.add(bracket)
        order = orders[bracket.name]
        upto = F.sum("_w").over(Window.orderBy(*order)) + F.lit(before)
        covers = [(F.col("_upto") >= r) & (F.col("_upto") - F.col("_w") < r) for (_, r), (b, *_) in places.items() if b == bracket]
        rows = df.where(bracket.holds(df, order)).withColumn("_w", times).withColumn("_upto", upto).where(reduce(Column.__or__, covers))
        branches.append(rows.select(F.lit(bracket.name).alias("_name"), "*"))
    result: dict[str, dict[int, Row]] = {name: {} for name in orders}
    for row in reduce(DataFrame.unionByName, branches).collect() if branches else ():
        for r in ranks[row["_name"]]:
            if row["_upto"] - row["_w"] < r <= row["_upto"]:
                result[row["_name"]][r] = row
    return result


def places_of(total: int, points: list[float]) -> list[int]:
    """The ranks between which percentiles of ``total`` rows are interpolated."""
    places = [(total - 1) * p for p in points]
    return sorted({rank for x in places for rank in (math.floor(x) + 1, min(math.floor(x) + 2, total))}) if total else []


def between(rows: dict[int, Row], column: str, total: int, p: float) -> float | None:
    """The linearly interpolated percentile, from the rows at ``places_of``; none without rows."""
    if not total:
        return None
    place = (total - 1) * p
    low = math.floor(place)
    least, most = (float(rows[rank][column]) for rank in (low + 1, min(low + 2, total)))
    return least + (most - least) * (place - low)


def percentiles(df: DataFrame, points: dict[str, dict[str, float]], weight: str | None = None) -> dict[str, dict[str, float | None]]:
    """Per column the linearly interpolated percentiles of its non-null values, as double; ``df`` is read several times.

    Equal values are counted first, so each value is one row of the selection. No values give None.
    """
    result = {}
    times = F.count("*") if weight is None else F.sum(weight)
    for column, wanted in points.items():
        counts = written(df.where(F.col(column).isNotNull()).groupBy(column).agg(times.alias("_n")), "value-counts")
        total = counts.agg(F.sum("_n")).first()[0] or 0
        rows = selected(counts, {column: [column]}, {column: places_of(total, list(wanted.values()))}, "_n")[column]
        result[column] = {name: between(rows, column, total, p) for name, p in wanted.items()}
    return result


def tile_starts(rows: int, tiles: int) -> list[int]:
    """The ranks at which NTILE's second and further tiles begin: the first ``rows % tiles`` tiles are one longer."""
    short, longer = divmod(rows, tiles)
    return [t * short + min(t, longer) + 1 for t in range(1, tiles)]


def interpolated(
    ranked: DataFrame, group: list[str], value: str, upto: Column, rows: Column, total: Column, points: dict[str, float]
) -> DataFrame:
    """Per group the interpolated percentiles, from rows that cover the places ``upto - rows`` to ``upto - 1``."""
    columns, picks = [], []
    for name, p in points.items():
        place = (total - 1) * F.lit(float(p))
        low = F.floor(place)
        for tag, index in (("lo", low), ("hi", F.least(low + 1, total - 1))):
            inside = (index >= upto - rows) & (index < upto)
            picks.append(F.max(F.when(inside, F.col(value).cast("double"))).alias(f"_{tag}_{name}"))
        picks.append(F.max(place - low).alias(f"_part_{name}"))
        columns.append(
            (F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_part_{name}"))
            .alias(name)
        )
    return ranked.groupBy(*group).agg(*picks).select(*group, *columns)


def exact_percentiles(
    df: DataFrame, group: list[str], value: str, points: dict[str, float], weight: Column | None = None
) -> DataFrame:
    """Per group the linearly interpolated percentiles of the non-null values, as double.

    Equal values are counted on the map side first; a value that a third of all rows share is one row here.
    ``weight`` says how often a row counts, 1 if not given.
    """
    times = F.sum(F.lit(1) if weight is None else weight)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(times.alias("_n"))
    ranked = running_totals(counts, group, [value], {"_upto": F.col("_n")})
    return interpolated(ranked, group, value, F.col("_upto"), F.col("_n"), F.col("_upto_all"), points)
