"""The conversation trie against brute force over all prefixes."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string"


def all_nodes(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members, children = collections.defaultdict(list), collections.defaultdict(set)
    for c, turns_ in rebuilt.items():
        for d in range(len(turns_) + 1):
            members[tuple(turns_[:d])].append(c)
            if d:
                children[tuple(turns_[:d - 1])].add(tuple(turns_[:d]))
    leaves, saved = collections.Counter(), collections.Counter()
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    result = []
    for node, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(rebuilt[c]) == len(node))))
        result.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(result, key=repr)


def found(df):
    return sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(3), []
    for c in range(-7, 90):
        for t in range(rng.randrange(14)):
            out.append((c, None if t == 0 and rng.random() < 0.3 else t, rng.choice(["u", "a", None]), rng.choice(["x", "é", "zz", None])))
    out += [(c, t, "u", "same") for c in range(200, 300) for t in range(10)]  # copies
    out += [(501, t, "u", str(t % 2)) for t in range(300)] + [(500, 0, "u", "long" * 50_000)]
    out += [(600, 0, "ab", "c"), (601, 0, "a", "bc"), (None, 0, "u", "of no conversation"), (602, 1, "u", "twice"), (602, 1, "u", "twice")]
    return out


@pytest.mark.parametrize("shards", ["1", "8", "40"])
def test_trie(spark, rows, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        df = spark.createDataFrame(rows, COLUMNS).withColumns({"node": F.lit("x"), "depth": F.lit(1), "turns": F.lit(2)})
        assert found(df) == all_nodes(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_no_and_few_conversations(spark):
    assert found(spark.createDataFrame([], COLUMNS)) == []
    for few in ([(None, 0, "u", "x")], [(5, None, None, None)], [(1, 0, "u", "x")]):
        assert found(spark.createDataFrame(few, COLUMNS)) == all_nodes(few)


def test_shards_agree_wherever_they_are_cut(rows):
    """Inner nodes of any cut are nodes of the whole."""
    paths = sorted((bytes(random.Random(k).choices(b"ab", k=k % 7)), k) for k in range(60))
    data = [(p.replace(b"a", b"a" * 16).replace(b"b", b"b" * 16), k) for p, k in paths]
    sizes = [np.full(len(p) // 16, 3) for p, _ in data]
    whole = prefix_trie.shard_nodes(0, np.array([k for _, k in data]), [p for p, _ in data], sizes)
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    wanted = set(whole[whole["node"].isna()][columns].itertuples(index=False, name=None))
    for cut in range(1, 60):
        for part in (slice(0, cut), slice(cut, 60)):
            some = data[part]
            nodes = prefix_trie.shard_nodes(0, np.array([k for _, k in some]), [p for p, _ in some], sizes[part])
            assert set(nodes[nodes["node"].isna()][columns].itertuples(index=False, name=None)) <= wanted


def test_parentheses():
    rng = np.random.default_rng(0)
    for size in (1, 2, 63, 64, 65, 4000):
        opens, depth = [True], 1
        for _ in range(size):
            opens.append(bool(depth <= 1 or rng.random() < 0.5))
            depth += 1 if opens[-1] else -1
        opens = np.array(opens + [False] * depth)
        tree, stack, close = prefix_trie.Parentheses(opens), [], {}
        for i, is_open in enumerate(opens):
            if is_open:
                stack.append(i)
            else:
                close[stack.pop()] = i
        at = np.flatnonzero(opens)
        assert tree.find_close(at).tolist() == [close[i] for i in at]
        leaves = [sum(opens[k] and not opens[k + 1] for k in range(i, close[i])) for i in at]
        assert tree.leaves(at, tree.find_close(at)).tolist() == leaves
