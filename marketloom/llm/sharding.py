"""Shards of near equal bytes by a k-d tree over document metadata.

Points are groups of equal texts, weighed by their bytes, so copies stay together. The tree splits each node along its
widest dimension at the weighted median until a leaf reaches the target bytes. Medians are found by counting: bytes per
bin of a node's range, then again within the bin that holds the median; only such bounded histograms reach the
driver. A point's coordinate ends in bits of its text's hash, so a value that a third of all rows share can be cut too.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.llm.common import running_starts, stored, unsigned_crc32, utf8_bytes

BINS = 1024
"""Bins per node and pass."""

PASSES = 5
"""At most so many passes per level; five cut a range of 2^50."""

PRECISION = 1 / 2000
"""A median's bin may hold this share of a shard's target before it is cut no further."""

HEAVY = 1 / 64
"""Groups above this share of a shard's target are given to leaves before the tree is cut: at most 64 per shard."""

SPAN = 1 << 24
"""A dimension is a number from 0 to SPAN - 1, followed by 24 bits of the text's hash."""

KEY = ["size", "text_crc32", "text_hash"]
"""What equal texts share."""


@dataclass
class Node:
    """Leaves ``first`` to ``first + leaves - 1``. Points with ``dimension`` below ``cut`` go to the lower half of them."""

    first: int
    leaves: int
    dimension: str = ""
    cut: int = 0
    halves: list["Node"] = field(default_factory=list)

    def leaf(self) -> Column:
        if not self.halves:
            return F.lit(self.first)
        low, high = self.halves
        return F.when(F.col(self.dimension) < self.cut, low.leaf()).otherwise(high.leaf())


def _dimension(value: Column) -> Column:
    spread = F.least(F.greatest(F.floor(value), F.lit(0)), F.lit(SPAN - 1)).cast("long")
    return spread * SPAN + F.pmod(F.xxhash64("text_hash", "piece"), F.lit(SPAN))


DIMENSIONS = {
    "by_size": lambda: F.log2(F.col("size").cast("double")) * (SPAN / 40),
    "by_source": lambda: F.pmod(F.xxhash64(F.coalesce("source", F.lit(""))), F.lit(SPAN)),
    "by_lang": lambda: F.pmod(F.xxhash64(F.coalesce("lang", F.lit(""))), F.lit(SPAN)),
}
"""Metadata of a group of equal texts: size, and the least source and language among its copies."""


def measured(docs: DataFrame) -> DataFrame:
    names = docs.columns
    keep = [c if c in names else F.lit(None).cast("string").alias(c) for c in ("source", "lang")]
    return docs.select(
        "doc_id", *keep, (utf8_bytes("text") + 1).alias("size"), unsigned_crc32("text").alias("text_crc32"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )


def grouped(sizes: DataFrame) -> DataFrame:
    """Groups of equal texts with bytes and coordinates; copies are added up on the map side."""
    groups = sizes.withColumn("piece", F.lit(0).cast("long")).groupBy(*KEY, "piece").agg(
        F.sum("size").alias("bytes"), F.min("source").alias("source"), F.min("lang").alias("lang")
    )
    return groups.withColumns({n: _dimension(of()) for n, of in DIMENSIONS.items()})


class Tree:
    """The splits of ``points``; ``taken`` are bytes that heavy groups already use per leaf."""

    def __init__(self, points: DataFrame, taken: list[int], target: float):
        self.points, self.taken, self.target = points, taken, target
        self.root = Node(0, len(taken))
        level = [self.root]
        # Halves differ by one leaf unless the number is a power of two, so some nodes are done a level earlier.
        while level := [node for node in level if node.leaves > 1]:
            self._split(level)
            level = [half for node in level for half in node.halves]

    def _room(self, first: int, leaves: int) -> float:
        return max(leaves * self.target - sum(self.taken[first:first + leaves]), 0.0)

    def _split(self, level: list[Node]) -> None:
        """Splits all nodes of a level together: one job for the widths, then one per pass."""
        placed = self.points.withColumn("node", self.root.leaf())
        names = list(DIMENSIONS)
        ranges = {r["node"]: r for r in placed.groupBy("node").agg(
            F.sum("bytes").alias("bytes"), *[f(n).alias(f"{t}_{n}") for n in names for t, f in (("lo", F.min), ("hi", F.max))]
        ).collect()}
        search = {}
        for node in level:
            r, half = ranges.get(node.first), node.leaves // 2
            node.halves = [Node(node.first, half), Node(node.first + half, node.leaves - half)]
            node.dimension = max(names, key=lambda n: r[f"hi_{n}"] // SPAN - r[f"lo_{n}"] // SPAN) if r else names[0]
            if r:
                low, rest = (self._room(n.first, n.leaves) for n in node.halves)
                wanted = r["bytes"] * (low / (low + rest) if low + rest else 0.5)
                search[node.first] = [node, r[f"lo_{node.dimension}"], r[f"hi_{node.dimension}"] + 1, wanted]
        for _ in range(PASSES):
            open_ = {k: s for k, s in search.items() if s[2] - s[1] > 1 and len(s) == 4}
            if not open_:
                break
            self._refine(placed, open_)
        for node, low, high, wanted, *_ in search.values():
            node.cut = low if wanted <= 0 else high

    def _refine(self, placed: DataFrame, search: dict) -> None:
        """Narrows each median's range [low, high) to one bin; ``wanted`` counts from the range's begin."""
        in_range, bin_of = F.lit(False), F.lit(None).cast("long")
        for k, (node, low, high, _) in search.items():
            here = (F.col("node") == k) & (F.col(node.dimension) >= low) & (F.col(node.dimension) < high)
            width = -(-(high - low) // BINS)
            in_range = in_range | here
            bin_of = F.when(here, F.floor((F.col(node.dimension) - low) / width)).otherwise(bin_of)
        value = F.coalesce(*[F.when(F.col("node") == k, F.col(s[0].dimension)) for k, s in search.items()])
        bins = placed.where(in_range).groupBy("node", bin_of.alias("bin")).agg(
            F.sum("bytes").alias("bytes"), F.min(value).alias("lo"), F.max(value).alias("hi")
        ).collect()
        for k, entry in search.items():
            wanted = entry[3]
            for b in sorted((b for b in bins if b["node"] == k), key=lambda b: b["bin"]):
                if wanted <= b["bytes"]:
                    entry[1:4] = [b["lo"], b["hi"] + 1, wanted]
                    if b["bytes"] <= self.target * PRECISION or b["lo"] == b["hi"]:
                        entry[3] = 0 if wanted * 2 < b["bytes"] else wanted
                        entry.append("done")
                    break
                wanted -= b["bytes"]


def assigned(sizes: DataFrame, shards: int) -> DataFrame:
    """``sizes`` (stored rows of ``measured``) with ``shard``."""
    groups = stored(grouped(sizes), "shard-groups")
    target = (groups.agg(F.sum("bytes")).first()[0] or 0) / shards
    # A group above a whole shard's bytes can't stay together: it is dealt into pieces by document id.
    giants = [tuple(r) for r in groups.where(F.col("bytes") > target).select(*KEY, "bytes").collect()]
    spread = F.lit(0).cast("long")
    for size, crc, text, total in giants:
        same = (F.col("size") == size) & (F.col("text_crc32") == crc) & (F.col("text_hash") == text)
        spread = F.when(same, F.pmod(F.xxhash64("doc_id"), F.lit(int(2 * total / (target * HEAVY)) + 1))).otherwise(spread)
    cut = sizes.withColumn("piece", spread)
    if giants:
        whole = groups.where(F.col("bytes") <= target)
        split = cut.join(groups.where(F.col("bytes") > target).select(*KEY), KEY, "left_semi").groupBy(*KEY, "piece").agg(
            F.sum("size").alias("bytes"), F.min("source").alias("source"), F.min("lang").alias("lang")
        ).withColumns({n: _dimension(of()) for n, of in DIMENSIONS.items()})
        groups = stored(whole.unionByName(split), "shard-points")
    # Heavy points, at most shards / HEAVY of them, go to the emptiest leaf, heaviest first.
    heavy, taken, rows = groups.where(F.col("bytes") > target * HEAVY), [0] * shards, []
    for r in sorted(heavy.select(*KEY, "piece", "bytes").collect(), key=lambda r: (-r["bytes"], *r)):
        leaf = min(range(shards), key=lambda i: (taken[i], i))
        taken[leaf] += r["bytes"]
        rows.append((*r[:4], leaf))
    tree = Tree(groups.where(F.col("bytes") <= target * HEAVY), taken, target)
    by_tree = groups.select(*KEY, "piece", tree.root.leaf().alias("leaf"))
    given = sizes.sparkSession.createDataFrame(rows, "size long, text_crc32 long, text_hash long, piece long, given int")
    leaves = by_tree.join(F.broadcast(given), [*KEY, "piece"], "left").select(
        *KEY, "piece", F.coalesce("given", "leaf").alias("shard")
    )
    return cut.join(leaves, [*KEY, "piece"]).select(*sizes.columns, "shard")


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per document ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the law is ``bytes``.

    Equal texts share a shard unless together they exceed a shard's bytes; the shards' bytes are near equal unless a
    single document is larger than that. ``slot`` counts 0, 1, … within a shard. Null and empty texts are equal texts of
    size 1 and crc32 0. Null sources and languages count as empty ones. Repeated rows are separate documents with
    slots of their own. An empty table gives no rows. Columns besides ``doc_id, text, source, lang`` are ignored.
    """
    sizes = stored(measured(docs), "shard-sizes")
    placed = stored(
        assigned(sizes, shards).select(
            "doc_id", "size", "text_crc32", "shard", F.xxhash64("doc_id", "text_hash").alias("order")
        ), "shard-rows",
    )
    return running_starts(placed, ["shard"], ["order", "doc_id", "text_crc32"], {"slot": F.lit(1).cast("long")}).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
