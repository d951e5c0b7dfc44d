"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner products become smallest Euclidean distances by one more component that gives all vectors the length of the
longest. Each table cuts Gaussian projections, shifted at random, into intervals of one width; a tuple of
intervals is a bucket, and there are more projections the more vectors there are. How a near neighbour's projections lie
about those of its query is measured on a bounded sample, and so is the sum of chances up to which buckets must be
visited to meet ``RECALL`` of such neighbours. A query visits buckets in the order of the estimated chance that they hold a
near neighbour. Buckets are scored apart, each with the queries that probe it; a large bucket is dealt into parts. The
tables' best candidates are merged and ranked by exact products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from marketloom.llm.common import sampled, stored

NEIGHBOURS = 20
EVERY = 20
"""Queries are the rows whose id this divides."""

TABLES = (1, 2, 3)
"""Numbers of tables to choose from: the cheapest for the sample, at the same recall."""

INTERVALS = 5
"""Intervals per projection; the two outermost have no outer end."""

BUCKET_VECTORS = 400
"""Vectors that a bucket should hold, about: one projection more for every ``INTERVALS`` times as many vectors."""

MOST_PROJECTIONS = 7
"""From some 30 million vectors on buckets grow instead of their number. This costs time, not recall."""

VISIT_COST = 300
"""Sending a query to a bucket costs about as much as so many inner products."""

RECALL = 0.97
"""Share of the sampled near neighbours that the visited buckets must hold."""

FIT_VECTORS = 5_000
PROBES = 400
"""Sampled vectors that stand for queries when the tables are fitted."""

PART_VECTORS = 16_384
PROBED_AT_ONCE = 1 << 20
"""Chances of buckets that a task computes at a time."""

ENOUGH = 4
"""Probed buckets hold at least so many vectors per neighbour asked for, or all."""


class Tables:
    """Projections, intervals, chances and bucket sizes; fitted on a bounded sample, then used for every vector."""

    def __init__(self, sample: np.ndarray, longest: float, neighbours: int, vectors: int, tables: int, projections: int):
        rng = np.random.default_rng(5)
        self.longest, self.tables, self.projections = longest, tables, projections
        numbers = np.arange(INTERVALS ** self.projections)
        self.cells = numbers[:, None] // INTERVALS ** np.arange(self.projections) % INTERVALS
        self.held = np.zeros((tables, len(numbers)), dtype=np.int64)
        self.axes = rng.standard_normal((tables, projections, sample.shape[1] + 1))
        points = self.lifted(sample)
        projected = np.einsum("tpd,nd->tpn", self.axes, points)
        low, high = np.quantile(projected, [0.05, 0.95], axis=2)
        width = max(float((high - low).mean()), 1e-9) / (INTERVALS - 1)
        # The middle of the sample's range, shifted by up to half an interval either way.
        middle = (low + high) / 2 + (rng.random(low.shape) - 0.5) * width
        self.bounds = middle[..., None] + width * (np.arange(1, INTERVALS) - INTERVALS / 2)
        self.shift, self.spread = np.zeros(low.shape), np.full(low.shape, width)
        self.nearness, self.success = 0.0, 1.0
        self._fit(sample, points, max(2, round(neighbours * len(sample) / max(vectors, 1))))

    @classmethod
    def cheapest(cls, sample: np.ndarray, longest: float, neighbours: int, vectors: int) -> "Tables":
        """Of some numbers of tables and projections those whose queries cost least, going by the sample.

        Where hashing leaves little out, few large buckets cost less than many that nearly every query visits.
        """
        wanted = round(np.log(max(vectors, 1) / BUCKET_VECTORS) / np.log(INTERVALS))
        few = range(1, int(np.clip(wanted + 1, 1, MOST_PROJECTIONS)) + 1)
        choices = [cls(sample, longest, neighbours, vectors, t, p) for t in TABLES for p in few]
        costs = [c.cost(sample, vectors, neighbours) for c in choices]
        return choices[int(np.argmin(costs))]

    def cost(self, sample: np.ndarray, vectors: int, neighbours: int) -> float:
        """Inner products that a query costs, on average over some sampled ones."""
        own, kept = self.buckets(sample), self.held
        self.held = np.stack([np.bincount(own[:, t], minlength=len(self.cells)) for t in range(self.tables)])
        total, queries = 0.0, sample[:PROBES // 4]
        for _, table, chosen in self.probes(queries, ENOUGH * neighbours * len(sample) // max(vectors, 1)):
            total += self.held[table][chosen].sum() * vectors / len(sample) + VISIT_COST * len(chosen)
        self.held = kept
        return total / len(queries)

    def _fit(self, sample: np.ndarray, points: np.ndarray, rank: int) -> None:
        """Measures near neighbours of sampled queries; ``rank`` is the asked rank's counterpart within the sample."""
        asked = np.arange(min(PROBES, len(sample)))
        rank = min(rank, len(sample) - 1)
        if rank < 1:
            return
        queries = self.asked(sample[asked])
        products = queries @ points.T
        products[asked, asked] = -np.inf
        near = np.argpartition(-products, rank - 1, axis=1)[:, :rank]
        self.nearness = float(np.median(np.take_along_axis(products, near, axis=1)))
        there = np.einsum("tpd,nkd->nktp", self.axes, points[near])
        off = there - (np.einsum("tpd,nd->ntp", self.axes, queries) * self.nearness)[:, None]
        self.shift, self.spread = off.mean(axis=(0, 1)), off.std(axis=(0, 1)) + 1e-9
        # Per neighbour the least sum of chances, over the tables, of the buckets that come before its own.
        own, needed = self.buckets(sample[near.ravel()]).reshape(*near.shape, self.tables), np.inf
        for k in range(self.tables):
            chance = self.chances(queries, k)
            order = np.argsort(-chance, axis=1, kind="stable")
            before = np.empty_like(chance)
            sums = np.cumsum(np.take_along_axis(chance, order, axis=1), axis=1)
            np.put_along_axis(before, order, np.hstack([np.zeros((len(sums), 1)), sums[:, :-1]]), axis=1)
            needed = np.minimum(needed, np.take_along_axis(before, own[:, :, k], axis=1))
        self.success = float(np.quantile(needed, RECALL)) + 1e-12

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.longest
        rest = np.sqrt(np.clip(1 - (scaled * scaled).sum(axis=1), 0, None))
        return np.hstack([scaled, rest[:, None]])

    @staticmethod
    def asked(queries: np.ndarray) -> np.ndarray:
        return np.hstack([queries / np.linalg.norm(queries, axis=1)[:, None], np.zeros((len(queries), 1))])

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket number per vector and table."""
        projected = np.einsum("tpd,nd->ntp", self.axes, self.lifted(vectors))
        cells = (projected[..., None] >= self.bounds[None]).sum(axis=3)
        return cells @ (INTERVALS ** np.arange(self.projections))

    def chances(self, queries: np.ndarray, table: int) -> np.ndarray:
        """Per lifted query and bucket the estimated chance that the bucket holds a near neighbour."""
        centre = np.einsum("pd,nd->np", self.axes[table], queries) * self.nearness + self.shift[table]
        upto = _normal((self.bounds[table][None] - centre[..., None]) / self.spread[table][None, :, None])
        edge = np.zeros_like(upto[..., :1])
        chance = np.diff(np.concatenate([edge, upto, edge + 1], axis=2), axis=2)
        success = np.ones((len(queries), len(self.cells)))
        for p in range(self.projections):
            success *= chance[:, p][:, self.cells[:, p]]
        return success

    def probes(self, queries: np.ndarray, enough: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(query, table, buckets)``: buckets in order of estimated success, as many as are needed."""
        lifted = self.asked(queries)
        for table in range(self.tables):
            held, success = self.held[table], self.chances(lifted, table)
            order = np.argsort(-success, axis=1, kind="stable")
            for q in range(len(queries)):
                ranked = order[q]
                until = np.searchsorted(np.cumsum(success[q, ranked]), self.success) + 1
                until = max(until, int(np.searchsorted(np.cumsum(held[ranked]), enough)) + 1)
                chosen = ranked[:until]
                yield q, table, chosen[held[chosen] > 0]


def _normal(x: np.ndarray) -> np.ndarray:
    """Normal distribution function, to about 1e-4: enough to order buckets."""
    x = np.clip(x, -8, 8)
    return 1 / (1 + np.exp(-1.5976 * x - 0.07056 * x ** 3))


def usable(vectors: DataFrame, key: str = "vec_id", values: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of doubles; without null, zero, empty or non-finite vectors."""
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(values).cast("array<double>").alias("vector")).where("vec_id is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("vector", lambda x: x != 0))


def exact_product(left: str, right: str):
    """Inner product in double precision, components in order."""
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def nearest(vectors: DataFrame, neighbours: int = NEIGHBOURS, every: int = EVERY) -> DataFrame:
    """Per query (id divisible by ``every``) its nearest found: ``query_id, rank, vec_id, score``.

    Scores are exact inner products of the original vectors, ties go to smaller ids. Null, zero and non-finite vectors and
    null ids take no part; vectors of another length than the most frequent one don't either. With fewer candidates
    than ``neighbours`` all are returned; a table without queries or candidates gives no rows. Rows that repeat an id are
    separate candidates; a query never meets rows of its own id. Other columns are ignored.
    """
    session, types = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    width = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if width is None:
        return session.createDataFrame([], types)
    rows = rows.where(F.size("vector") == width["width"])
    longest = rows.agg(F.max(F.sqrt(exact_product("vector", "vector")))).first()[0]
    sample = np.array([r[0] for r in sampled(rows, F.col("vec_id"), FIT_VECTORS).select("vector").limit(2 * FIT_VECTORS).collect()] or [rows.first()["vector"]])
    tables = Tables.cheapest(sample, longest, neighbours, rows.count())
    first = session.sparkContext.broadcast(tables)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = first.value.buckets(np.stack(batch["vector"]))
                for table in range(first.value.tables):
                    yield pd.DataFrame({"table": table, "bucket": found[:, table], "vec_id": batch["vec_id"], "vector": batch["vector"]})

    schema = "table int, bucket long, vec_id long, vector array<double>"
    indexed = stored(rows.mapInPandas(hashed, schema), "vectors")
    # One row per table and bucket: at most three times INTERVALS^MOST_PROJECTIONS.
    counts = stored(indexed.groupBy("table", "bucket").agg(F.count("*").alias("n")), "buckets")
    for table, bucket, held in counts.collect():
        tables.held[table, bucket] = held
    ready = session.sparkContext.broadcast(tables)

    def probing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            step = max(1, PROBED_AT_ONCE // len(ready.value.cells))
            for k in range(0, len(batch), step):
                part = batch.iloc[k:k + step]
                ids, values = part["vec_id"].to_numpy(), part["vector"].to_numpy()
                found = list(ready.value.probes(np.stack(values), ENOUGH * neighbours))
                sizes = [len(b) for _, _, b in found]
                which = np.repeat([q for q, _, _ in found], sizes)
                table = np.repeat([t for _, t, _ in found], sizes)
                bucket = np.concatenate([b for _, _, b in found])
                yield pd.DataFrame({"table": table, "bucket": bucket, "query_id": ids[which], "query": values[which]})

    asked = rows.where(F.col("vec_id") % every == 0).mapInPandas(probing, "table int, bucket long, query_id long, query array<double>")
    keys, parts = ["table", "bucket", "part"], lambda n: F.ceil(F.col(n) / PART_VECTORS).cast("int")
    asked = asked.join(counts.withColumnRenamed("n", "held"), ["table", "bucket"]).select(
        "table", "bucket", F.explode(F.sequence(F.lit(0), parts("held") - 1)).alias("part"), "query_id", "query"
    )
    dealt = indexed.join(counts, ["table", "bucket"]).select(
        "table", "bucket", F.pmod(F.xxhash64("vec_id"), parts("n")).cast("int").alias("part"), "vec_id", "vector"
    )

    def best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found, vectors = [], right.sort_values("vec_id", kind="stable")
        ids, matrix = vectors["vec_id"].to_numpy(), np.stack(vectors["vector"]) if len(vectors) else None
        longest_here = np.linalg.norm(matrix, axis=1).max() if len(vectors) else 0.0
        for k in range(0, len(left) if len(ids) else 0, 128):
            part = left.iloc[k:k + 128]
            queries = part["query_id"].to_numpy()
            scores = np.stack(part["query"]) @ matrix.T
            own = queries[:, None] == ids[None, :]
            scores[own] = np.finfo(np.float64).min
            # The last place with all that equal it, up to rounding: exact products decide later.
            take = min(neighbours, len(ids))
            least = -np.partition(-scores, take - 1, axis=1)[:, take - 1]
            slack = 1e-12 * np.linalg.norm(np.stack(part["query"]), axis=1) * longest_here
            clear = (scores > (least + slack)[:, None]) & ~own
            tied = (scores >= (least - slack)[:, None]) & ~clear & ~own
            # Ties beyond the places left can't be among the nearest of this part: smaller ids come first.
            tied &= np.cumsum(tied, axis=1) <= neighbours
            row, column = np.nonzero(clear | tied)
            found.append(pd.DataFrame({"query_id": queries[row], "vec_id": ids[column], "score": scores[row, column]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    near = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Somewhat more than asked for, so that rounding can't leave out a true neighbour before exact products rank them.
    merged = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("near", F.row_number().over(order))
    merged = merged.where(F.col("near") <= 2 * neighbours).select("query_id", "vec_id")
    pairs = merged.join(rows.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")), "query_id").join(rows, "vec_id")
    scored = pairs.select("query_id", "vec_id", exact_product("query", "vector").alias("score"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
