"""The conversation trie against brute force, with shards and chunks small enough that most nodes are shared."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tamis.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def naive(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    paths = {c: [(r, t) for *_, r, _, t in sorted(x)] for c, x in convs.items()}
    whole = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)  # the remainder has the sign of c
        whole[c] = tuple(paths.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved, ends = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    for c, path in whole.items():
        ends[path].append(c)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), children[node], leaves[node], saved[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items())


def got(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(tuple(-1 if n == "parent_conv_id" and r[n] is None else r[n] for n in names) for r in df.collect())


def conversations(seed=4):
    rng = random.Random(seed)
    said = lambda: (rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b\n", "", None, "é x", "w " * rng.randint(1, 5)]))
    rows = [(c, t, *said()) for c in range(0, 300) if c % 7 for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", f"same {t}") for c in range(1_000, 1_200) for t in range(5)]  # copies of one conversation
    rows += [(c, t, "user", "hello there" if t < 2 else f"{c} {t}") for c in range(2_000, 2_100) for t in range(4)]  # one first turn
    rows += [(-5, 1, "user", "x"), (-5, None, "user", "first"), (-20, 3, "user", "of -20"), (5_001, 0, "user", "alone"), (6_000, 0, "user", "tie b"), (6_000, 0, "user", "tie a"), (6_000, 0, "assistant", "tie")]
    rows += [(7_000, t, "user", f"long {t}") for t in range(700)] + [(7_001, t, "user", f"long {t}") for t in range(650)]
    rows += [(None, 1, "user", "x"), (8_001, 0, None, None), (8_001, 0, None, None), (8_021, 5, "user", "word " * 20_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard", "chunk"), [(1 << 16, 1 << 16), (9, 4)])
def test_equals_brute_force(spark, monkeypatch, shard, chunk):
    monkeypatch.setattr(prefix_trie, "SHARD_NODES", shard)
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    df = spark.createDataFrame(conversations(), SCHEMA)
    for c in ("path", "key", "shard", "base", "digest", "words"):
        df = df.withColumn(c, F.lit("clash"))
    assert got(prefix_trie.nodes(prefix_trie.rebuilt(df))) == naive(conversations())


def test_tables_without_conversations(spark):
    assert prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame([], SCHEMA))).count() == 0
    assert prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA))).count() == 0
    alone = [(3, 0, "user", "one two")]  # its first turns are those of conversation 0, which isn't there
    assert got(prefix_trie.nodes(prefix_trie.rebuilt(spark.createDataFrame(alone, SCHEMA)))) == naive(alone)


def test_a_stored_trie_is_searched(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    paths = {r["conv_id"]: r["path"] for r in prefix_trie.own_paths(df).collect()}
    assert set(paths) == {r[0] for r in rows if r[0] is not None} and len(paths[7_000]) == 700 * prefix_trie.LABEL
    every = sorted(set(paths.values()))
    t = prefix_trie.Louds(*prefix_trie.louds_of([(p, 1, k, bytes(32)) for k, p in enumerate(every)]))
    assert t.nodes == len({p[:d] for p in every for d in range(0, len(p) + 1, prefix_trie.LABEL)})
    for k, p in enumerate(every):
        walked = t.walk(p)
        assert len(walked) == len(p) // prefix_trie.LABEL + 1 and t.first[walked[-1]] == k
        assert [int(t.parent[i]) for i in walked[1:]] == walked[:-1]
    assert len(t.walk(every[-1] + bytes(prefix_trie.LABEL))) == len(every[-1]) // prefix_trie.LABEL + 1
