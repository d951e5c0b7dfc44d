"""A prefix trie of conversations: what sharing equal beginnings would save.

Conversations are sorted by their turns, so that all that share a beginning are neighbours, and cut into shards of about
equal size. A task holds the trie of its shard as balanced parentheses: a node opens, then its subtree stands, then it
closes. With range min-max blocks over the excess of opened over closed nodes, ``find_close`` finds where subtrees end; ranks of
``()`` pairs count their leaves, and cumulative arrays give members and savings as differences.

Only nodes on the first and the last path of a shard can go on in other shards: these are its spines. Their counts are
partial and leave out spine nodes; spines of all shards are merged by node, and what spine nodes add to the nodes above
them is summed along the paths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from marketloom.llm.common import stored

BRANCH = 5
"""Conversations whose ids agree after division by this are rebuilt upon the first turns of the same one."""

MOST_SHARED = 8
DIGEST = 16
"""Bytes that stand for a turn: its MD5."""

SHARD_BYTES = 32 << 20
"""Turns' digests and sizes of a shard, about, unless the session's shuffle partitions ask for more shards."""


class Parentheses:
    """A sequence of opening and closing parentheses with range min-max blocks over its excess."""

    BLOCK = 64

    def __init__(self, opens: np.ndarray):
        """``opens``: true for an opening parenthesis; balanced."""
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = 1
        while blocks * self.BLOCK < len(opens):
            blocks *= 2
        padded = np.zeros(blocks * self.BLOCK, np.int64)
        padded[:len(opens)] = self.excess
        least, most = padded.reshape(blocks, -1).min(axis=1), padded.reshape(blocks, -1).max(axis=1)
        self.padded, self.least, self.most = padded, [least], [most]
        while len(least) > 1:
            least, most = least.reshape(-1, 2).min(axis=1), most.reshape(-1, 2).max(axis=1)
            self.least.append(least)
            self.most.append(most)
        leaf = opens.copy()
        leaf[:-1] &= ~opens[1:]
        self._leaves = np.concatenate([[0], np.cumsum(leaf)])

    def _within(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place from ``at`` to the end of its block with the excess ``target``, -1 if there is none."""
        found = np.full(len(at), -1)
        ends = (at // self.BLOCK + 1) * self.BLOCK
        left = np.arange(len(at))
        for step in range(self.BLOCK):
            left = left[at[left] + step < ends[left]]
            if not len(left):
                break
            hit = self.padded[at[left] + step] == target[left]
            found[left[hit]] = at[left[hit]] + step
            left = left[~hit]
        return found

    def _holds(self, level: int, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        return (self.least[level][node] <= target) & (target <= self.most[level][node])

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``at`` are closed; all are looked up together."""
        target = self.excess[at] - 1
        start = at + 1
        found = self._within(start, target)
        open_ = np.flatnonzero(found < 0)
        node, level = start[open_] // self.BLOCK, np.zeros(len(open_), np.int64)
        block = np.full(len(open_), -1)
        climbing = np.arange(len(open_))
        for height in range(len(self.least) - 1):  # up, until the right neighbour of a node holds the excess
            left_child = climbing[node[climbing] % 2 == 0]
            hit = left_child[self._holds(height, node[left_child] + 1, target[open_[left_child]])]
            block[hit], level[hit] = node[hit] + 1, height
            climbing = climbing[block[climbing] < 0]
            node[climbing] //= 2
        for height in range(len(self.least) - 1, 0, -1):  # and down again to the first block that does
            down = np.flatnonzero(level == height)
            left = block[down] * 2
            block[down] = np.where(self._holds(height - 1, left, target[open_[down]]), left, left + 1)
            level[down] = height - 1
        found[open_] = self._within(block * self.BLOCK, target[open_])
        return found

    def leaves(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """``()`` pairs that open from ``first`` to ``last``."""
        return self._leaves[last + 1] - self._leaves[first]


def common_turns(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return (int(differ.argmax()) if differ.any() else n) // DIGEST


LOCAL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
    "size long, shard int, node binary, parent binary, first_path boolean, last_path boolean"
)


def shard_nodes(shard: int, ids: np.ndarray, paths: list[bytes], sizes: list[np.ndarray]) -> pd.DataFrame:
    """The nodes of a shard, from its conversations sorted by path and id.

    Nodes inside the shard are final, ``ends`` being the digest of their ids. Nodes of its spines have ``node``, partial counts
    that leave out spine nodes, and ``ends`` as text. ``parent`` names a parent on the spine.
    """
    lengths = np.array([len(p) // DIGEST for p in paths])
    common = np.array([0] + [common_turns(a, b) for a, b in zip(paths, paths[1:])])
    # Brackets: before a conversation the nodes close that it doesn't share, then its own open. The root opens first.
    runs = np.zeros(2 * len(ids) + 1, np.int64)
    runs[0:-1:2][1:] = lengths[:-1] - common[1:]
    runs[1::2] = lengths - common
    runs[1] += 1
    runs[-1] = lengths[-1] + 1
    tree = Parentheses(np.repeat(np.arange(len(runs)) % 2 == 1, runs))
    opened = np.flatnonzero(tree.opens)
    closed = tree.find_close(opened)
    depth = tree.excess[opened] - 1
    below = (closed - opened + 1) // 2  # nodes of the subtree, which follow one another
    last = np.arange(len(opened)) + below
    creator = np.repeat(np.arange(len(ids)), runs[1::2])
    end_of = np.cumsum(runs[1::2]) - 1  # the node that a conversation ends at
    size = np.zeros(len(opened), np.int64)
    size[1:] = np.concatenate([s[c:] for s, c in zip(sizes, common)])
    ends_here = np.bincount(end_of, minlength=len(opened))
    upto = np.concatenate([[0], np.cumsum(ends_here)])
    members = upto[last] - upto[:-1]
    # Members are neighbours, beginning with the conversation that opened the node.
    bounds = np.stack([creator, creator + members], axis=1).ravel()
    least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
    parent = np.full(len(opened), -1)
    newest = np.zeros(depth.max() + 1, np.int64)
    for k, d in enumerate(depth.tolist()):
        newest[d] = k
        if d:
            parent[k] = newest[d - 1]
    first_path, last_path = np.zeros(len(opened), bool), np.zeros(len(opened), bool)
    first_path[:lengths[0] + 1] = True
    last_path[newest[:lengths[-1] + 1]] = True
    spine = first_path | last_path
    inner = ~spine
    children = np.bincount(parent[inner], minlength=len(opened))
    inner_leaf = np.concatenate([[0], np.cumsum(inner & (below == 1))])
    leaves = np.where(inner, tree.leaves(opened, closed), inner_leaf[last] - inner_leaf[:-1])
    saving = np.concatenate([[0], np.cumsum(np.where(inner, (members - 1) * size, 0))])
    texts = [str(i) for i in ids]
    ends, begin = [], np.searchsorted(end_of, np.arange(len(opened)))
    for k, (b, n) in enumerate(zip(begin.tolist(), ends_here.tolist())):
        joined = ",".join(texts[b:b + n])
        ends.append(joined if spine[k] else hashlib.sha256(joined.encode()).hexdigest())
    names: list[bytes | None] = [None] * len(opened)
    for path, on in ((paths[0], np.arange(lengths[0] + 1)), (paths[-1], newest[:lengths[-1] + 1])):
        name = hashlib.md5()
        for d, k in enumerate(on.tolist()):
            if d:
                name.update(path[(d - 1) * DIGEST:d * DIGEST])
            names[k] = name.digest()
    above = [names[p] if p >= 0 else None for p in parent.tolist()]
    return pd.DataFrame({
        "conv_id": least, "depth": depth, "parent_conv_id": pd.array(np.where(parent >= 0, least[parent], 0), "Int64").copy(),
        "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saving[last] - saving[:-1], "ends": ends,
        "size": size, "shard": shard, "node": names, "parent": above, "first_path": first_path, "last_path": last_path,
    })


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [b for b in batches if len(b)]
    if rows:
        all_ = pd.concat(rows)
        yield shard_nodes(
            TaskContext.get().partitionId(), all_["conv_id"].to_numpy(np.int64), [bytes(p) for p in all_["path"]],
            [np.asarray(s, np.int64) for s in all_["sizes"]],
        )


def rebuilt(conversations: DataFrame, branch: int = BRANCH, most: int = MOST_SHARED) -> DataFrame:
    """``conv_id, path`` (digests of its turns, one after the other), ``sizes`` (bytes of their texts) of every conversation.

    Conversation c begins with the first h turns of conversation c - c % branch, h = crc32(decimal c) % (most + 1), and goes on
    with its own turns after its first h.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn"), F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    turns = stored(
        conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")), "conversations",
    )
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most + 1)).cast("int")
    base = turns.where(F.col("conv_id") % branch == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first"))
    joined = turns.withColumn("base", F.col("conv_id") - F.col("conv_id") % branch).join(base, "base", "left").select(
        "conv_id", F.concat(
            F.coalesce(F.slice("first", F.lit(1), shared), F.slice("turns", 1, 0)),
            F.slice("turns", shared + 1, F.size("turns")),
        ).alias("turns"),
    )
    return joined.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns.digest", F.hex), "")).alias("path"), F.col("turns.size").alias("sizes")
    )


def nodes(sequences: DataFrame) -> DataFrame:
    """The trie's nodes, from ``conv_id, path, sizes``; see ``trie`` for the columns."""
    session = sequences.sparkSession
    rows = stored(sequences, "rebuilt")
    bytes_ = rows.agg(F.coalesce(F.sum(F.octet_length("path") * 2 + 16), F.lit(0))).first()[0]
    shards = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-bytes_ // SHARD_BYTES))
    order = ["path", "conv_id"]
    local = stored(
        rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInPandas(_shards, LOCAL), "trie-shards"
    )
    spine = local.where("node is not null")
    merged = spine.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("size").alias("size"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    on_spine = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    merged = stored(merged.join(on_spine, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))), "trie-spine")
    # A spine node counts on one of the paths that hold it, for itself and all nodes above it there.
    side = F.explode(F.array_compact(F.array(F.when(F.col("first_path"), 0), F.when(F.col("last_path"), 1)))).alias("side")
    paths = stored(spine.select("node", "shard", side), "trie-paths")
    owner = paths.groupBy("node").agg(F.min(F.struct("shard", "side")).alias("owner"))
    own = owner.join(merged, "node").select(
        "node", "owner.shard", "owner.side", F.col("n_children") == 0, (F.col("n_convs") - 1) * F.col("size")
    ).toDF("node", "shard", "side", "leaf", "saving")
    depths = merged.select("node", "depth")
    upward = Window.partitionBy("shard", "side").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    sums = paths.join(own, ["node", "shard", "side"], "left").join(depths, "node").select(
        "node", F.sum(F.when(F.col("leaf"), 1).otherwise(0)).over(upward).alias("leaves"),
        F.sum(F.coalesce("saving", F.lit(0))).over(upward).alias("savings"),
    ).groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("savings").alias("savings"))
    ends = spine.select("node", "shard", "ends").repartition("node").sortWithinPartitions("node", "shard").mapInPandas(
        _end_digests, "node binary, ends_sha256 string"
    )
    above = stored(merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above")), "trie-above")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    spines = merged.join(sums, "node").join(ends, "node").join(above, "parent", "left").withColumns({
        "parent_conv_id": F.col("above"), "n_leaves": F.col("n_leaves") + F.col("leaves"), "saved_tokens": F.col("saved_tokens") + F.col("savings"),
    })
    inner = local.where("node is null").withColumnRenamed("ends", "ends_sha256")
    below = inner.where("parent is not null").join(above, "parent").withColumn("parent_conv_id", F.col("above"))
    return spines.select(*columns).unionByName(below.select(*columns)).unionByName(inner.where("parent is null").select(*columns))


def _end_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's ids, whose shards follow one another in order; one state is held at a time."""
    node, state, empty = None, None, True
    for batch in batches:
        done = []
        for name, ends in zip(batch["node"], batch["ends"]):
            if name != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state, empty = name, hashlib.sha256(), True
            if ends:
                state.update(("" if empty else ",").encode() + ends.encode())
                empty = False
        if done:
            yield pd.DataFrame(done, columns=["node", "ends_sha256"])
    if state is not None:
        yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])


def trie(conversations: DataFrame, branch: int = BRANCH, most: int = MOST_SHARED) -> DataFrame:
    """The prefix trie of the rebuilt conversations: a row per distinct sequence of first turns, the root's being empty.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of texts that sharing saves in the subtree), ``ends_sha256`` (of the ids that end here, joined).
    Turns are ordered by ``turn``, nulls first, equal ones by a digest of role and text; repeated rows are repeated
    turns; null roles and texts are empty. Rows without ``conv_id`` belong to no conversation and are left out. A
    conversation that keeps no turn is a member of the root. Without conversations there are no rows. Other columns are
    ignored. A task holds 16 bytes per turn of a conversation, and never its texts.
    """
    return nodes(rebuilt(conversations, branch, most))
