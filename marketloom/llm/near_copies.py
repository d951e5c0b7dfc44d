"""Near-duplicate documents: MinHash signatures in an LSH forest, links confirmed on full shingle sets.

Documents with equal shingle sets form one class. Each tree of the forest orders the classes by its own ``DEPTH`` minimum
hashes. Classes that share a prefix form a region; a region with more than ``REGION`` classes is entered deeper, so depth
adapts to how crowded a place is. Within its region a class meets its neighbours in sorted order, which share the longest
prefixes. Two sets of similarity 0.8 share four hashes in a tree with probability 0.41, so all ``TREES`` trees miss them
with 3e-6. A region that stays large at full depth is dealt into parts, and its classes also meet its first one.

Neighbours alone can miss a link in a crowded region, so these are gone through again once the links are known. There a
class outside its region's largest component is compared, in blocks and by equal minimum hashes, with all classes of
other components. Classes that could have a link bring their whole sets to a second comparison of the same blocks, which
returns links between components and no other pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from marketloom.llm.common import stored
from marketloom.llm.graph import both_ways, components

TREES, DEPTH = 24, 8
LEVELS = (4, 6, 8)
REGION = 64
NEIGHBOURS = 8
PART_ROWS = 4096
GROUP_LINKS = 5_000
"""Candidate pairs that one task confirms at a time."""

BLOCK = 4096
"""Classes on either side of one comparison of a crowded region."""

COMPARED = 8192
"""Rows of small comparisons that are done together, about."""

SET_BYTES = 32 << 20
"""Shingle sets on either side of one comparison by whole sets."""

LEAST_EQUAL = 127
"""Two sets of similarity 0.8 have fewer equal hashes of 192 with a probability of about 3e-6."""

PERCENT = 80
LEAST_SET = PERCENT // (100 - PERCENT)
"""Smaller sets can only be linked to equal ones."""

WORDS = 2

_rng = np.random.default_rng(8)
_FACTORS = _rng.integers(1, 1 << 32, TREES * DEPTH, np.uint64).astype(np.uint32) | np.uint32(1)
_TERMS = _rng.integers(0, 1 << 32, TREES * DEPTH, np.uint64).astype(np.uint32)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; empty without words."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + (hashes[1:] ^ (hashes[1:] >> np.uint64(31)))
    pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(pairs ^ (pairs >> np.uint64(32)))


def signature(shingles: np.ndarray) -> bytes:
    """Minimum hashes, big-endian, so that bytes sort as the numbers do."""
    least = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for k in range(0, len(values), 1024):
        np.minimum(least, (values[k:k + 1024, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    return least.astype(">u4").tobytes()


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text in batch["text"]:  # one set at a time
            shingles = shingle_set(text)
            n = len(shingles)
            rows.append((n, xxhash.xxh3_128_digest(shingles.tobytes()) if n else None, signature(shingles) if n >= LEAST_SET else None))
        sketches = pd.DataFrame(rows, columns=["n_shingles", "node", "signature"])
        yield pd.concat([batch[["doc_id", "text_hash"]].reset_index(drop=True), sketches], axis=1)


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node`` (digest of the set, null if empty), ``signature`` (null for small sets)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInPandas(_sketches, "doc_id long, text_hash long, n_shingles long, node binary, signature binary")


def first_document():
    """The smallest document id, null ids last, as a struct."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")


def _pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each class with its next ``NEIGHBOURS`` in the order of its tree."""
    order = Window.partitionBy(*keys).orderBy("path", "node")
    near = F.array(*[F.lead("node", k).over(order) for k in range(1, NEIGHBOURS + 1)])
    return rows.select("node", near.alias("near")).select(
        F.col("node").alias("a"), F.explode(F.filter("near", lambda x: x.isNotNull())).alias("b")
    )


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a < b`` of classes (``node``, ``signature``) that are neighbours in some tree, with ``votes``.

    Also ``node, region`` of the regions, at the least depth, in which not all classes have met.
    """
    size = 4 * DEPTH
    rows = classes.where("signature is not null").select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    path = F.substring(F.col("signature"), F.col("tree") * size + 1, F.lit(size))
    rows, found = rows.select("node", "tree", path.alias("path")), []
    for level in LEVELS:
        keyed = rows.withColumn("region", F.xxhash64("tree", F.substring("path", 1, 4 * level)))
        counts = keyed.groupBy("region").agg(F.count("*").alias("n"), F.min("node").alias("head")).where("n > 1")
        met = stored(keyed.join(counts, "region"), "forest")
        if level == LEVELS[0]:
            crowded = met.where(F.col("n") > NEIGHBOURS + 1).select("node", "region")
        if level < LEVELS[-1]:
            found.append(_pairs(met.where(F.col("n") <= REGION), ["region"]))
            rows = met.where(F.col("n") > REGION).select("node", "tree", "path")
        else:
            part = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / PART_ROWS))
            found.append(_pairs(met.withColumn("part", part), ["region", "part"]))
            found.append(met.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("votes"))
    return pairs, crowded


def _possible(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one comparison, the askers and members whose sketches agree enough for a link between two components."""
    asks, n = rows["asks"].to_numpy(), rows["n"].to_numpy()
    component = pd.factorize(rows["component"])[0]
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
    members, needed = np.flatnonzero(~asks), np.zeros(len(rows), bool)
    by_hash = np.ascontiguousarray(sketch[members].T)
    for k in np.flatnonzero(asks):
        equal = (by_hash == sketch[k][:, None]).sum(axis=0, dtype=np.uint8)
        fits = (equal >= LEAST_EQUAL) & (component[members] != component[k])
        fits &= 100 * np.minimum(n[members], n[k]) >= PERCENT * np.maximum(n[members], n[k])
        needed[members[fits]] = True
        needed[k] = fits.any()
    return rows[needed].drop(columns="sketch")


def _joining(rows: pd.DataFrame) -> Iterator[tuple]:
    """Of one comparison, links of an asker and a member that join two components, as pairs of these."""
    names = rows["component"].to_numpy()
    component, asks = pd.factorize(rows["component"])[0], rows["asks"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
    members = np.flatnonzero(~asks)
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    if not len(members):
        return
    sizes = np.array([len(sets[m]) for m in members])
    shingles, owner = np.concatenate([sets[m] for m in members]), np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(shingles, kind="stable")
    owner = owner[order]
    values, starts, times = np.unique(shingles[order], return_index=True, return_counts=True)
    for k in np.flatnonzero(asks):
        at = np.searchsorted(values, sets[k])
        at = at[values[np.minimum(at, len(values) - 1)] == sets[k]]
        # Places of the members that hold these shingles, each shingle's places one after another.
        shift = np.repeat(starts[at] - (np.cumsum(times[at]) - times[at]), times[at])
        common = np.bincount(owner[shift + np.arange(len(shift))], minlength=len(members))
        for m in members[100 * common >= PERCENT * (sizes + len(sets[k]) - common)]:
            one, other = find(component[k]), find(component[m])
            if one != other:
                root[one] = other
                yield names[k], names[m]


def joining(crowded: DataFrame, classes: DataFrame, joined: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of components that a link within a crowded region joins: enough of them to connect all such."""
    of = crowded.join(joined, "node", "left").select("node", "region", F.coalesce("component", "node").alias("component"))
    sizes = of.groupBy("region", "component").agg(F.count("*").alias("n"))
    mixed = stored(sizes.groupBy("region").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("main")
    ).where("all > main.n").select(
        "region", F.col("main.component").alias("main"),
        F.ceil(F.col("all") / BLOCK).alias("blocks"), F.ceil((F.col("all") - F.col("main.n")) / BLOCK).alias("askers"),
        F.col("all"), (F.col("all") - F.col("main.n")).alias("others"),
    ), "mixed-regions")
    total = mixed.agg(F.sum(F.col("all") * F.col("askers") + F.col("others") * F.col("blocks"))).first()[0] or 0

    @F.pandas_udf("binary")
    def least_bytes(signatures: pd.Series) -> pd.Series:
        """A byte of each hash tells nearly as much as the whole one."""
        return signatures.map(lambda s: bytes(s)[3::4])

    sketches = classes.select("node", "signature", F.col("n_shingles").alias("n"))
    rows = of.join(mixed, "region").join(sketches, "node").withColumn("sketch", least_bytes("signature"))
    own = lambda parts: F.pmod(F.xxhash64("node"), F.col(parts))
    each = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
    columns = ["region", "node", "component", "n", "sketch"]
    members = rows.select(*columns, F.lit(False).alias("asks"), own("blocks").alias("block"), each("askers").alias("asker"))
    askers = rows.where("component <> main").select(
        *columns, F.lit(True).alias("asks"), own("askers").alias("asker"), each("blocks").alias("block")
    )
    comparison = ["region", "block", "asker"]

    def possible(compared: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([_possible(rows) for _, rows in compared.groupby(comparison)])

    # Many regions are small: about COMPARED rows make one group.
    group = F.pmod(F.xxhash64(*comparison), F.lit(total // COMPARED + 1))
    found = stored(members.unionByName(askers).select(*comparison, "node", "component", "n", "asks", "sketch").groupBy(group).applyInPandas(
        possible, "region long, block long, asker long, node binary, component binary, n long, asks boolean"
    ), "unmet")

    # The same comparisons by whole sets, dealt anew where these are large.
    space = lambda asks: F.ceil(F.sum(F.when(F.col("asks") == asks, 8 * F.col("n"))) / SET_BYTES)
    parts = found.groupBy(*comparison).agg(space(False).alias("blocks"), space(True).alias("askers"))
    dealt = found.join(parts, comparison)
    columns = ["node", "component", "n", "asks", *comparison]
    dealt = dealt.where("not asks").select(*columns, own("blocks").alias("part"), each("askers").alias("other")).unionByName(
        dealt.where("asks").select(*columns, own("askers").alias("other"), each("blocks").alias("part"))
    )
    dealt = stored(dealt, "compared")
    groups = 4 * ((dealt.agg(F.sum("n")).first()[0] or 0) * 8 // SET_BYTES) + 8
    needed = stored(dealt.select("node").distinct().join(classes.select("node", "first.doc_id", "first.text_hash"), "node"), "needed")

    @F.pandas_udf("binary")
    def shingle_bytes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: shingle_set(t).tobytes())

    sets = texts_of(needed, docs).select("node", shingle_bytes("text").alias("shingles"))
    comparison += ["part", "other"]

    def links(compared: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([p for _, rows in compared.groupby(comparison) for p in _joining(rows)], columns=["a", "b"])

    group = F.pmod(F.xxhash64(*comparison), F.lit(groups))
    return dealt.join(sets, "node").groupBy(group).applyInPandas(links, "a binary, b binary")


def texts_of(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """``needed`` (with ``doc_id, text_hash``) with the ``text`` of these documents, once for each row that has both."""
    return docs.select(F.col("doc_id").cast("long").alias("_doc_id"), F.xxhash64("text").alias("_text_hash"), "text").join(
        needed, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")),
    ).drop("_doc_id", "_text_hash")


def _confirm(key: tuple, pairs: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """Links among the pairs of one group; pairs that links join already are left out, they can't change components."""
    text_of = dict(zip(texts["node"], texts["text"]))
    sets: dict[bytes, np.ndarray] = {}
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    def of(x: bytes) -> np.ndarray:
        if x not in sets:
            sets[x] = shingle_set(text_of[x])
        return sets[x]

    links = []
    for a, b in pairs.sort_values(["votes", "a", "b"], ascending=[False, True, True])[["a", "b"]].itertuples(index=False):
        if find(a) == find(b):
            continue
        common = len(np.intersect1d(of(a), of(b), assume_unique=True))
        if 100 * common >= PERCENT * (len(of(a)) + len(of(b)) - common):
            root[find(a)] = find(b)
            links.append((a, b))
    return pd.DataFrame(links, columns=["a", "b"])


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``a, b``: enough of the candidate pairs to connect all classes that similarity 0.8 connects.

    Pairs that belong together go to one group, so that a text travels about once: a pair's place is the least node
    that its first one meets. A place with many pairs is dealt by its first node.
    """
    near = both_ways(pairs).groupBy("a").agg(F.least("a", F.min("b")).alias("place"))
    placed = stored(pairs.join(near, "a"), "pairs")
    per_place = placed.groupBy("place").agg(F.count("*").alias("n"))
    groups = -(-placed.count() // GROUP_LINKS) * 4 + 8
    deal = F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / GROUP_LINKS))
    dealt = stored(
        placed.join(per_place, "place").select("a", "b", "votes", F.pmod(F.xxhash64("place", deal), F.lit(groups)).alias("group")), "dealt"
    )
    needed = dealt.select("group", F.col("a").alias("node")).unionByName(dealt.select("group", F.col("b").alias("node"))).distinct()
    # Stored, so that Spark knows its size and need not shuffle all texts for few.
    needed = stored(needed.join(classes.select("node", "first.doc_id", "first.text_hash"), "node"), "needed")
    texts = texts_of(needed, docs).select(F.col("group").alias("at"), "node", "text")
    return dealt.groupBy("group").cogroup(texts.groupBy("at")).applyInPandas(_confirm, "a binary, b binary")


def grouped(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, text_hash, n_shingles, first``: struct of its component's smallest document."""
    rows = stored(sketched(docs), "sketches")
    classes = stored(
        rows.where("node is not null").groupBy("node").agg(
            F.min(first_document()).alias("first"), F.first("signature", ignorenulls=True).alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        ), "classes",
    )
    pairs, crowded = candidates(classes)
    joined = components(confirmed(stored(pairs, "candidates"), classes, docs))
    more = components(joining(crowded, classes, joined, docs)).toDF("component", "_component")
    of_class = classes.select("node", "first").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    of_class = stored(of_class.join(more, "component", "left").select(
        "node", "first", F.coalesce("_component", "component").alias("component")
    ), "components")
    smallest = of_class.groupBy("component").agg(F.min("first").alias("smallest"))
    of_class = of_class.join(smallest, "component").select("node", F.col("smallest").alias("first"))
    return rows.join(of_class, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("first", first_document()).alias("first")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links reach, itself included. Null and empty texts and texts without words have
    no shingles and no links. Null ids count as largest. Repeated rows are separate documents of one component, each
    kept if its id is the smallest. An empty table gives no rows. Columns besides ``doc_id`` and ``text`` are ignored.
    """
    smallest = F.col("first.doc_id")
    return grouped(docs).select(
        "doc_id", "n_shingles", smallest.alias("component_id"), F.col("doc_id").eqNullSafe(smallest).alias("kept")
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.

    Null and empty texts and texts without words have no copies: all of them stay. Null ids count as largest. Of rows that
    repeat id and text one stays. Texts of any length are compared whole; an empty table stays empty. Columns of any
    name are kept as they are.
    """
    keep = grouped(docs).where("n_shingles > 0").select(
        F.col("first.doc_id").alias("keep_id"), F.col("first.text_hash").alias("keep_hash")
    ).distinct()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"),
        F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False)).alias("has_words"),
    )
    once = Window.partitionBy("keep_id", "keep_hash").orderBy(F.lit(0))
    kept = rows.join(keep, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("hash") == F.col("keep_hash"))).withColumn(
        "nth", F.row_number().over(once)
    ).where("nth = 1")
    return kept.select("row.*").unionByName(rows.where("not has_words").select("row.*"))
