"""A trie of conversations' shared beginnings, as succinct level-order tries (LOUDS) of prefix shards.

A conversation is a path of labels, one a turn: ``LABEL`` bytes of a 128-bit hash of role and text and the text's number of words. Equal
conversations become one path first: they are sorted by path and conv_id over all tasks, packed by up to ``CHUNK`` ids, and a path's chunks give
its count, its smallest id and the hash of its ids, so that a path that a third of all conversations share is a few rows. Distinct
paths are dealt by ranges of the sorted paths: a shard is a stretch of neighbours of about ``SHARD_NODES`` nodes, whatever first turns are
common. numpy builds each shard's LOUDS bit vector (a node's children as ones, closed by a zero, in level order) and label array; parents are ranks in that bit vector,
and sums over subtrees are ``add.at`` along the levels from the deepest up.

Only what stands above a shard's first or last path can go on in other shards: these *open* nodes, at most twice the depth a shard, are
the heavy upper levels. They are merged apart, by key: a shard gives what hangs below each of them, sums by key make the whole
counts, each merged node then adds its own value to those above it in the shard that owns it, and sums by key again close the
rollup. Shards get their open nodes' smallest members back, for the children's parent_conv_id.

Turns are ordered by turn (null first), then by role, then by the SHA-256 of the text; repeated rows are turns each. Null role or text: empty. Rows
without conv_id belong to no conversation and are left out. A conversation is one value of a task, ``LABEL`` bytes a turn; texts of any length. Two sequences are taken as
equal by 128 bits. Empty table: no rows, not even the root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import WORD, small_batches, table, written

LABEL = 24
CHUNK = 1 << 16
SHARD_NODES = 1 << 16
SENT_ROWS = 10_000
NONE = np.iinfo(np.int64).max
ROOT = bytes(16)


def label(role: str, digest: bytes, words: int) -> bytes:
    said = role.encode()
    return xxhash.xxh3_128_digest(len(said).to_bytes(8, "big") + said + digest) + words.to_bytes(8, "big")


def _sent(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    now, size = [], 0
    for r in rows:
        now.append(r)
        size += sum(len(x) for x in r if isinstance(x, bytes))
        if len(now) >= SENT_ROWS or size >= 8 << 20:
            yield _sent(now, schema)
            now, size = [], 0
    yield _sent(now, schema)


def _rows(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, words: what a turn is told by. Texts go no further than their row."""
    text = F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.unhex(F.sha2(text, 256)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def own_paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path of each conversation as it stands."""
    return rebuilt(conversations, group=1, most=1)


def rebuilt(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """conv_id, path: the first h turns of conversation c - c % group (all if fewer, none if absent), then c's own after its first h; h = crc32(c) % most."""
    schema = pa.schema([("conv_id", pa.int64()), ("path", pa.binary())])

    def run(batches):
        def each():
            now = head_of = None
            own, head = [], []

            def closed():
                h = zlib.crc32(str(now).encode()) % most
                if now == head_of:
                    head[:] = own[: most - 1]
                return now, b"".join(head[:h] + own[h:])

            for base, conv, role, digest, words in _rows(batches):
                if conv != now:
                    if now is not None:
                        yield closed()
                    now, own = conv, []
                    if base != head_of:
                        head_of, head = base, []
                own.append(label(role, digest, words))
            if now is not None:
                yield closed()

        yield from _batched(each(), schema)

    base = F.col("conv_id") - F.col("conv_id") % group
    d = turns(conversations).select(base.alias("base"), "conv_id", "turn", "role", "digest", "words").repartition("base")
    d = d.sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "digest")
    return d.select("base", "conv_id", "role", "digest", "words").mapInArrow(run, "conv_id long, path binary")


def distinct_paths(paths: DataFrame) -> DataFrame:
    """paths: conv_id, path. path, n, least, ends (SHA-256 of the ids, ascending, comma-joined)."""

    def chunks(batches):
        def each():
            now, ids = None, []
            for path, conv in _rows(batches):
                if path != now or len(ids) >= CHUNK:
                    if ids:
                        yield xxhash.xxh3_128_digest(now), ids[0], now, np.array(ids, "<i8").tobytes()
                    now, ids = path, []
                ids.append(conv)
            if ids:
                yield xxhash.xxh3_128_digest(now), ids[0], now, np.array(ids, "<i8").tobytes()

        yield from _batched(each(), pa.schema([("key", pa.binary()), ("low", pa.int64()), ("path", pa.binary()), ("ids", pa.binary())]))

    def joined(batches):
        def each():
            now, path, n, least, sha = None, b"", 0, 0, None
            for key, low, own, ids in _rows(batches):
                if key != now:
                    if now is not None:
                        yield path, n, least, sha.digest()
                    now, path, n, least, sha = key, own, 0, low, hashlib.sha256()
                numbers = np.frombuffer(ids, "<i8")
                sha.update(("," * (n > 0) + ",".join(map(str, numbers.tolist()))).encode())
                n += len(numbers)
            if now is not None:
                yield path, n, least, sha.digest()

        yield from _batched(each(), pa.schema([("path", pa.binary()), ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.binary())]))

    sorted_ids = paths.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    packed = sorted_ids.mapInArrow(chunks, "key binary, low long, path binary, ids binary")
    return packed.repartition("key").sortWithinPartitions("key", "low").mapInArrow(joined, "path binary, n long, least long, ends binary")


class Louds:
    """A level-order trie: bits, labels; n and least of the paths that end at a node, their digests, and which nodes are open."""

    def __init__(self, nodes: int, bits: bytes, labels: bytes, n: bytes, least: bytes, ends: bytes, is_open: bytes):
        self.nodes = nodes
        self.bits = np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * nodes - 1)
        self.labels = labels
        self.ended, self.first = np.frombuffer(n, "<i8"), np.frombuffer(least, "<i8")
        self.open = np.unpackbits(np.frombuffer(is_open, np.uint8), count=nodes).astype(bool)
        self.ends = np.full(nodes, -1)
        self.ends[self.ended > 0] = np.arange((self.ended > 0).sum())
        self.digests = ends
        ones, zeros = np.flatnonzero(self.bits == 1), np.flatnonzero(self.bits == 0)
        self.parent = np.append(-1, ones - np.arange(len(ones)))  # the zeros before a node's one
        self.degree = np.diff(np.append(-1, zeros)) - 1
        self.first_child = zeros - np.arange(nodes) - self.degree + 1
        self.levels = [(0, 1)]
        while (low := self.levels[-1][1]) < nodes:
            self.levels.append((low, low + int(self.degree[slice(*self.levels[-1])].sum())))

    def label(self, i: int) -> bytes:
        return self.labels[LABEL * i : LABEL * (i + 1)]

    def child(self, i: int, sought: bytes) -> int:
        """The child with this label, by halving; -1 if there is none."""
        low, high = int(self.first_child[i]), int(self.first_child[i] + self.degree[i])
        while low < high:
            middle = (low + high) // 2
            if self.label(middle) < sought:
                low = middle + 1
            else:
                high = middle
        return low if low < self.first_child[i] + self.degree[i] and self.label(low) == sought else -1

    def walk(self, path: bytes) -> list[int]:
        """Nodes of a path from the root as far as it goes."""
        found = [0]
        for at in range(0, len(path), LABEL):
            nxt = self.child(found[-1], path[at : at + LABEL])
            if nxt < 0:
                break
            found.append(nxt)
        return found

    def digest(self, i: int) -> bytes | None:
        return self.digests[32 * self.ends[i] : 32 * (self.ends[i] + 1)] if self.ends[i] >= 0 else None

    def rolled(self) -> dict[str, np.ndarray]:
        """By node: words, depth, n, least; children, leaves and saved of whole subtrees, but for open nodes only what hangs below in closed ones."""
        m, parent = self.nodes, self.parent
        words = np.frombuffer(self.labels, ">i8")[LABEL // 8 - 1 :: LABEL // 8].astype(np.int64)
        n, least, depth = self.ended.copy(), self.first.copy(), np.zeros(m, np.int64)
        children, leaves, saved = np.zeros(m, np.int64), np.where(self.open, 0, self.degree == 0).astype(np.int64), np.zeros(m, np.int64)
        for level, (low, high) in reversed(list(enumerate(self.levels))):
            depth[low:high] = level
            own = slice(low, high)
            saved[own] += np.where(self.open[own], 0, (n[own] - 1) * words[own])
            if low:
                np.add.at(n, parent[own], n[own])
                np.minimum.at(least, parent[own], least[own])
                closed = low + np.flatnonzero(~self.open[own])
                for total, add in ((children, np.ones(len(closed), np.int64)), (leaves, leaves[closed]), (saved, saved[closed])):
                    np.add.at(total, parent[closed], add)
        return {"words": words, "depth": depth, "n": n, "least": least, "children": children, "leaves": leaves, "saved": saved}

    def keys(self) -> dict[int, bytes]:
        """Hashes of the open nodes' whole prefixes."""
        out = {0: ROOT}
        for i in np.flatnonzero(self.open)[1:].tolist():
            out[i] = xxhash.xxh3_128_digest(out[int(self.parent[i])] + self.label(i))
        return out


SHARD = "shard long, nodes int, bits binary, labels binary, n binary, least binary, ends binary, open binary"


def louds_of(paths: list[tuple[bytes, int, int, bytes]]) -> tuple:
    """Columns of SHARD after the first, of sorted distinct paths with n, least, ends."""
    depth, parent, labels, ended, first, digests = [0], [-1], [bytes(LABEL)], [0], [NONE], [b""]
    chain, before, on_first = [0], b"", []
    for path, n, least, ends in paths:
        size = min(len(path), len(before))
        differ = np.flatnonzero(np.frombuffer(path, np.uint8, size) != np.frombuffer(before, np.uint8, size))
        del chain[(int(differ[0]) if len(differ) else size) // LABEL + 1 :]
        for at in range(LABEL * (len(chain) - 1), len(path), LABEL):
            depth.append(len(chain))
            parent.append(chain[-1])
            labels.append(path[at : at + LABEL])
            ended.append(0)
            first.append(NONE)
            digests.append(b"")
            chain.append(len(depth) - 1)
        ended[chain[-1]], first[chain[-1]], digests[chain[-1]] = n, least, ends
        before = path
        on_first = on_first or list(chain)
    order = np.argsort(np.array(depth), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    degree = np.bincount(rank[np.array(parent)[order[1:]]], minlength=len(order))
    bits = np.ones(2 * len(order) - 1, np.uint8)
    bits[np.cumsum(degree + 1) - 1] = 0
    is_open = np.zeros(len(order), np.uint8)
    is_open[rank[on_first + chain]] = 1
    at = order.tolist()
    return (
        len(at), np.packbits(bits).tobytes(), b"".join([labels[i] for i in at]), np.array([ended[i] for i in at], "<i8").tobytes(), np.array([first[i] for i in at], "<i8").tobytes(),
        b"".join([digests[i] for i in at]), np.packbits(is_open).tobytes(),
    )


def shards(distinct: DataFrame) -> DataFrame:
    """Tries of stretches of the sorted paths; a table of them can be kept and searched (``Louds``)."""
    most = SHARD_NODES

    def run(batches):
        from pyspark import TaskContext

        def each():
            task, number, now, size = TaskContext.get().partitionId(), 0, [], 0
            for row in _rows(batches):
                now.append(row)
                size += len(row[0]) // LABEL + 1
                if size >= most:
                    yield (task << 32) + number, *louds_of(now)
                    number, now, size = number + 1, [], 0
            if now:
                yield (task << 32) + number, *louds_of(now)

        yield from _batched(each(), pa.schema([("shard", pa.int64()), ("nodes", pa.int32()), *[(c, pa.binary()) for c in ("bits", "labels", "n", "least", "ends", "open")]]))

    return distinct.repartitionByRange("path").sortWithinPartitions("path").select("path", "n", "least", "ends").mapInArrow(run, SHARD)


def opened(tries: DataFrame) -> DataFrame:
    """The open nodes of each shard with what hangs below them there."""

    def run(batches):
        def each():
            for shard, *trie in _rows(batches):
                t = Louds(*trie)
                r, keys = t.rolled(), t.keys()
                for i, key in keys.items():
                    yield shard, key, keys[int(t.parent[i])] if i else None, *(int(r[c][i]) for c in ("depth", "words", "n", "least", "children", "leaves", "saved")), t.digest(i)

        yield from _batched(each(), pa.schema([("shard", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()), *[(c, pa.int64()) for c in ("depth", "words", "n", "least", "children", "leaves", "saved")], ("ends", pa.binary())]))

    return tries.mapInArrow(run, "shard long, key binary, parent binary, depth long, words long, n long, least long, children long, leaves long, saved long, ends binary")


def merged(open_nodes: DataFrame) -> DataFrame:
    """Open nodes of all shards by key, whole but for what the open ones below them add: leaves and saved are their own and what hangs."""
    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    one = open_nodes.groupBy("key").agg(*sums, F.min("least").alias("least"), F.min("shard").alias("owner"), *[F.max(c).alias(c) for c in ("parent", "depth", "words", "ends")])
    one = written(one, "trie-open")
    below = one.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("open_children"))
    d = one.join(below, "key", "left").withColumn("children", F.col("children") + F.coalesce("open_children", F.lit(0))).drop("open_children")
    return d.withColumns({"leaves": F.col("leaves") + (F.col("children") == 0).cast("long"), "saved": F.col("saved") + (F.col("n") - 1) * F.col("words")})


def nodes(paths: DataFrame) -> DataFrame:
    """paths: conv_id, path. One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    tries = written(shards(written(distinct_paths(written(paths, "trie-paths")), "trie-distinct")), "trie-shards")
    open_nodes = written(opened(tries), "trie-above")
    whole = written(merged(open_nodes), "trie-merged")
    known = whole.select("key", "owner", F.col("leaves").alias("l"), F.col("saved").alias("s"), F.col("least").alias("m"))
    # Of each shard its open nodes, the deepest first: at most twice the depth.
    mine = F.struct((-F.col("depth")).alias("up"), "key", "parent", F.when(F.col("owner") == F.col("shard"), F.col("l")).otherwise(0).alias("leaves"), F.when(F.col("owner") == F.col("shard"), F.col("s")).otherwise(0).alias("saved"), F.col("m").alias("least"))
    lists = written(open_nodes.select("shard", "key", "parent", "depth").join(known, "key").groupBy("shard").agg(F.sort_array(F.collect_list(mine)).alias("above")), "trie-lists")

    def carried(batches):
        def each():
            for (above,) in _rows(batches):
                leaves, saved = {x["key"]: x["leaves"] for x in above}, {x["key"]: x["saved"] for x in above}
                for x in above:
                    if x["parent"] is not None:
                        leaves[x["parent"]] += leaves[x["key"]]
                        saved[x["parent"]] += saved[x["key"]]
                    yield x["key"], leaves[x["key"]], saved[x["key"]]

        yield from _batched(each(), pa.schema([("key", pa.binary()), ("leaves", pa.int64()), ("saved", pa.int64())]))

    sums = lists.select("above").mapInArrow(carried, "key binary, leaves long, saved long").groupBy("key").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = whole.select(F.col("key").alias("parent"), F.col("least").alias("parent_conv_id"))
    upper = whole.join(sums, "key").join(parents, "parent", "left")
    upper = upper.select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"), "n_leaves", "saved_tokens", "ends")

    def closed(batches):
        names = ("depth", "n", "children", "leaves", "saved")

        for b in batches:
            for shard_row, above in zip(zip(*(c.to_pylist() for c in b.columns[:-1]), strict=True), b.columns[-1].to_pylist(), strict=True):
                t = Louds(*shard_row)
                r, least = t.rolled(), {x["key"]: x["least"] for x in above}
                members = r["least"].copy()
                for i, key in t.keys().items():
                    members[i] = least[key]
                at = np.flatnonzero(~t.open)
                columns = [members[at], r["depth"][at], members[t.parent[at]], *[r[c][at] for c in names[1:]]]
                ends = pa.array([t.digest(i) for i in at.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], ends], names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"])

    lower = tries.join(lists, "shard").select("nodes", "bits", "labels", "n", "least", "ends", "open", "above")
    lower = lower.mapInArrow(closed, "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends binary")
    every = upper.select(*lower.columns).unionByName(lower)
    return every.withColumn("ends_sha256", F.coalesce(F.lower(F.hex("ends")), F.sha2(F.lit(""), 256))).drop("ends")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of all conversations, rebuilt with the first turns of each twentieth."""
    small_batches(spark)
    return nodes(rebuilt(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))
