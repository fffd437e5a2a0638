"""Near duplicates: a multi-index Hamming join over b-bit MinHash signatures, confirmed on full shingle sets.

1. Every text becomes the set of its 5-word shingles. Texts with equal sets are one class, so exact
   copies, however many, are one row from here on.
2. A class has ``SYMBOLS`` MinHash symbols. The first ``CHUNKS * WIDTH`` of them, of 16 bits, are
   split into chunks of ``WIDTH``. By pigeonhole two signatures that differ in fewer than
   ``2 * CHUNKS`` of them have a chunk with at most one error; enumerating the place of
   the error gives ``WIDTH`` keys a chunk, and every such pair shares a key. (At similarity 0.75 a pair is
   missed with a probability of about 1e-5, and much less above.)
3. Classes that share a key are compared with the key's first class; pairs whose symbols agree often enough are
   confirmed on the texts' full sets. That joins groups of copies by stars, not by all pairs.
4. Where a key still holds classes of several components, its classes are compared block by block: first by symbols,
   which leaves the classes that have a possible partner in another component, then by their full sets, counted over an
   inverted index inside the task. A group puts out at most as many rows as it has classes, never its pairs.

Components come from label propagation with pointer jumping over the confirmed links, all on tables.

Bounds, all on work in one task and none on results: a pair with fewer than ``LEAST_AGREE`` of 64 equal symbols isn't confirmed
(at similarity 0.75 48 are expected and fewer than 30 come with a probability of about 3e-7); a class is named by 64
bits of its set's hash in joins (the last join uses 128), so two sets of 1e9 share a name with a probability of 0.03.

Texts of any length are compared by all their shingles; ties need nothing special. Null or empty texts: no shingles, linked with nothing, component is the own id. Repeated rows and equal texts share
a component. A null id counts as the largest: it is a component's id only where all ids are null. Empty table: no rows. Columns
beyond doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import Members, WordHashes, membership, mixed, ngram_hashes, released, small_batches, table, written

SHINGLE = 5
SIMILAR = 75  # per cent
SYMBOLS, CHUNKS, WIDTH = 64, 6, 3
INDEXED = CHUNKS * WIDTH
# Of 64 symbols 48 agree at similarity 0.75, with a deviation of 3.5; pairs with fewer than this are not looked at further.
LEAST_AGREE = 30
MEMBERS = 2_000  # texts that one task compares with a leader, about
BLOCK, BLOCK_SHINGLES = 4_096, 2_000_000  # classes, and shingles of them, in a block of a large key, about
LAST_ID = (1 << 63) - 1
FILTER_BITS = 26

_rng = np.random.default_rng(5)
FACTORS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def shingles(text: bytes, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    return np.unique(ngram_hashes(hashes.of(text.lower().split()), SHINGLE))


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    a, b = mixed(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return int(np.array(a).view(np.int64)), int(np.array(b, dtype=np.uint64).view(np.int64))


def signature(s: np.ndarray) -> bytes:
    """INDEXED symbols of 16 bits, then the others of 8."""
    low = np.full(SYMBOLS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for k in range(0, len(s), 2048):
        np.minimum(low, (s[k : k + 2048, None] * FACTORS + TERMS).min(axis=0), out=low)
    low = mixed(low)
    return low[:INDEXED].astype("<u2").tobytes() + low[INDEXED:].astype(np.uint8).tobytes()


SIGNATURE_BYTES = 2 * INDEXED + SYMBOLS - INDEXED


def symbols(column) -> tuple[np.ndarray, np.ndarray]:
    """(indexed symbols, low bytes of all symbols) of a binary column."""
    raw = np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SIGNATURE_BYTES)
    wide = np.ascontiguousarray(raw[:, : 2 * INDEXED]).view("<u2")
    return wide, np.concatenate((raw[:, : 2 * INDEXED : 2], raw[:, 2 * INDEXED :]), axis=1)


def described(docs: DataFrame) -> DataFrame:
    """id, h (row key: the id, and a hash of text and id), doc_id, n_shingles, cid and check (hash of the set), sig of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        hashes = WordHashes()
        for b in released(batches):
            rows = []
            for text in b.column(3).cast(pa.large_binary()).to_pylist():
                s = shingles(text or b"", hashes)
                rows.append((len(s), *set_hash(s), signature(s)) if len(s) else (0, None, None, None))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *(pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))], names=["id", "h", "doc_id", "n_shingles", "cid", "check", "sig"])

    return docs.select(*row_key(), "doc_id", "text").mapInArrow(run, "id long, h long, doc_id long, n_shingles long, cid long, check long, sig binary")


def row_key():
    """Two columns that tell rows apart by id and text. A null id counts as the largest."""
    return F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), F.xxhash64(F.col("doc_id").isNull(), F.col("text")).alias("h")


def keyed(classes: DataFrame) -> DataFrame:
    """Each class under its CHUNKS * WIDTH keys: key, cid. The last bits of a key tell its place: chunk * WIDTH + error."""

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            wide, _ = symbols(b.column(1))
            keys = []
            for chunk in range(CHUNKS):
                part = wide[:, chunk * WIDTH : (chunk + 1) * WIDTH].astype(np.uint64)
                for error in range(WIDTH):
                    place = np.uint64(chunk * WIDTH + error)
                    key = np.full(len(part), place + np.uint64(1))
                    for k in range(WIDTH):
                        if k != error:
                            key = mixed(key * np.uint64(65_599) + part[:, k])
                    keys.append((key & ~np.uint64(31) | place).view(np.int64))
            again = pa.array(np.tile(np.arange(b.num_rows), CHUNKS * WIDTH))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), b.column(0).take(again)], names=["key", "cid"])

    return classes.select("cid", "sig").mapInArrow(run, "key long, cid long")


def near_size(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n, m) >= SIMILAR * np.maximum(n, m)


def starred(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """shared: key, cid, leader. Pairs (a: leader, b) whose symbols agree often enough to be confirmed.

    Nothing is grouped by key here, so a key that many classes share is no task of its own.
    """
    side = lambda x: classes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    pairs = shared.where("cid <> leader").select(F.col("leader").alias("a"), F.col("cid").alias("b")).distinct()

    def run(batches):
        for b in batches:
            if b.num_rows:
                low_a, low_b = symbols(b.column(4))[1], symbols(b.column(5))[1]
                close = near_size(b.column(2).to_numpy(), b.column(3).to_numpy()) & ((low_a == low_b).sum(axis=1) >= LEAST_AGREE)
                yield b.select([0, 1]).filter(pa.array(close))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def with_texts(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """wanted: id, h and other columns; gets the text of that row."""
    # Only texts that are wanted go through the shuffle: a bit table of fixed size tells most others.
    bits = docs.sparkSession.sparkContext.broadcast(membership(wanted.select("h").distinct(), "h", FILTER_BITS))

    def wanted_only(batches):
        have = Members(bits.value)
        for b in released(batches):
            yield b.filter(pa.array(have.has(b.column(1).to_numpy().view(np.uint64))))

    texts = docs.select(*row_key(), "text").where("text is not null").mapInArrow(wanted_only, "id long, h long, text string")
    return wanted.join(texts.dropDuplicates(["id", "h"]), ["id", "h"])


def groups_of(batches, keys: int):
    """Rows that stream by in the order of their first ``keys`` columns, as one Arrow table a group."""
    held = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in range(keys)]
        new = np.zeros(b.num_rows - 1, dtype=bool)
        for c in cols:
            new |= c[1:] != c[:-1]
        at = [0, *(np.flatnonzero(new) + 1), b.num_rows]
        for x, y in zip(at[:-1], at[1:], strict=True):
            if held and any(held[-1].column(k)[0] != b.column(k)[int(x)] for k in range(keys)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs (a, b) of classes those whose full sets are similar enough.

    Members travel to their leader's text; a leader with many members is sent to several tasks.
    """
    per = written(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m")).withColumn("salts", F.ceil(F.col("m") / MEMBERS).cast("int")), "leaders")
    members = pairs.join(per, "a").select("a", F.lit(1).alias("kind"), F.col("b").alias("cid"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    leaders = per.select("a", F.lit(0).alias("kind"), F.col("a").alias("cid"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    wanted = written(leaders.unionByName(members).join(classes.select("cid", "id", "h"), "cid"), "pairs-wanted")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = with_texts(wanted, docs).select("a", "salt", "kind", "cid", "text").repartition(partitions, "a", "salt").sortWithinPartitions("a", "salt", "kind", "cid")

    def run(batches):
        hashes, own = WordHashes(), None
        for b in released(batches):
            left, right = [], []
            for a, kind, cid, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).cast(pa.large_binary()).to_pylist(), strict=True):
                s = shingles(text, hashes)
                if kind == 0:
                    own = s
                    continue
                shared = len(np.intersect1d(own, s, assume_unique=True))
                if 100 * shared >= SIMILAR * (len(own) + len(s) - shared):
                    left.append(a)
                    right.append(cid)
            yield pa.RecordBatch.from_arrays([pa.array(left, type=pa.int64()), pa.array(right, type=pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def blocked(shared: DataFrame, found: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes under each key that holds several components: key, i, j, own, cid, comp, n, sig.

    The classes of a large key are dealt into blocks by hash, and each pair of blocks i <= j is a group of its own,
    so that no group holds more than about two blocks, whatever the key's size.
    """
    placed = written(shared.select("key", "cid").join(found, F.col("cid") == F.col("node"), "left").select("key", "cid", F.coalesce("comp", "cid").alias("comp")).join(classes.select("cid", "n"), "cid"), "placed")
    per = placed.groupBy("key").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("all_n")).where("least < most")
    split = written(per.select("key", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("all_n") / BLOCK_SHINGLES)).alias("blocks")), "split-keys")
    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "own").alias("i"), F.greatest(x, "own").alias("j"))))
    rows = placed.join(split, "key").withColumn("own", own).join(classes.select("cid", "sig"), "cid")
    return rows.withColumn("pair", pair).select("key", "pair.i", "pair.j", "own", "cid", "comp", "n", "sig")


def suspects(blocks: DataFrame) -> DataFrame:
    """Of each group those classes that have, across components, a partner whose symbols agree often enough: key, i, j, own, cid, comp.

    A pair counts only in the first of the keys that it shares.
    """

    def marked(key, i, j, own, comp, n, wide, low):
        chunk, error = divmod(int(key) & 31, WIDTH)
        m = len(own)
        across = np.ascontiguousarray(low.T)
        out = np.zeros(m, dtype=bool)
        split = int((own == i).sum())
        for x in range(m - 1 if i == j else split):
            y0 = x + 1 if i == j else split
            y = y0 + np.flatnonzero((comp[y0:] != comp[x]) & near_size(n[y0:], n[x]))
            if not len(y):
                continue
            agree = (across[:, y] == low[x][:, None]).sum(axis=0, dtype=np.uint8) if len(y) < m // 4 else (across == low[x][:, None]).sum(axis=0, dtype=np.uint8)[y]
            y = y[agree >= LEAST_AGREE]
            if not len(y):
                continue
            same = (wide[y] == wide[x]).reshape(-1, CHUNKS, WIDTH).sum(axis=2)
            y = y[~((same[:, :chunk] >= WIDTH - 1).any(axis=1) | ((error > 0) & (same[:, chunk] == WIDTH)))]
            if len(y):
                out[x] = True
                out[y] = True
        return out

    def run(batches):
        for t in groups_of(batches, 3):
            key, i, j, own, cid, comp, n = (t.column(k).to_numpy() for k in range(7))
            if comp.min() == comp.max():
                continue
            out = marked(key[0], i[0], j[0], own, comp, n, *symbols(t.column(7)))
            if out.any():
                yield from t.select(range(6)).filter(pa.array(out)).combine_chunks().to_batches()

    partitions = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(partitions, "key", "i", "j").sortWithinPartitions("key", "i", "j", "own", "cid")
    return dealt.mapInArrow(run, "key long, i long, j long, own long, cid long, comp long")


def linked(sets: list[np.ndarray], first: int) -> list[tuple[int, np.ndarray]]:
    """(x, partners) of the pairs x < y of sets that are similar enough, by counting over an inverted index.

    With ``first`` > 0 only pairs of one of the first sets with one of the others.
    """
    n = np.array([len(s) for s in sets])
    who = np.repeat(np.arange(len(sets), dtype=np.int32), n)
    _, term, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    holders = who[np.argsort(term, kind="stable")]  # of each shingle in turn, by number
    ends = np.cumsum(df)
    starts = ends - df
    ends_of = np.cumsum(n)
    out = []
    for x in range(first or len(sets) - 1):
        t = term[ends_of[x] - n[x] : ends_of[x]]
        t = t[df[t] > 1]
        if not len(t):
            continue
        k = df[t]
        at = np.repeat(starts[t] - (np.cumsum(k) - k), k) + np.arange(k.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        y = np.flatnonzero(100 * shared >= SIMILAR * (n + n[x] - shared))
        y = y[y >= (first or x + 1)]
        if len(y):
            out.append((x, y))
    return out


def joined(marked: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) that join the components of a group of suspects, on full sets. A group gives fewer links than it has rows."""
    wanted = written(marked.join(classes.select("cid", "id", "h"), "cid"), "suspects")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "i", "j", "own", "cid"]
    rows = with_texts(wanted, docs).select(*order, "comp", "text").repartition(partitions, "key", "i", "j").sortWithinPartitions(*order)

    def run(batches):
        hashes = WordHashes()

        def reduced():  # sets instead of texts, so that a group in hand is small
            for b in released(batches):
                sets = [shingles(x, hashes).tobytes() for x in b.column(6).cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(sets, type=pa.large_binary())], names=[*order, "comp", "set"])

        for t in groups_of(reduced(), 3):
            _, i, j, own, cid, comp = (t.column(k).to_numpy() for k in range(6))
            sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column(6).to_pylist()]
            root: dict[int, int] = {}

            def top(c, root=root):
                while root.get(c, c) != c:
                    c = root[c]
                return c

            left, right = [], []
            for x, partners in linked(sets, 0 if i[0] == j[0] else int((own == i[0]).sum())):
                for y in partners:
                    p, q = top(comp[x]), top(comp[y])
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        left.append(cid[x])
                        right.append(cid[y])
            yield pa.RecordBatch.from_arrays([pa.array(left, type=pa.int64()), pa.array(right, type=pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """links: a, b. Of every linked node: node, comp (the least node that can be reached)."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:  # a label only falls, and the least one of a component stays, so this ends
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("heard"))
        low = labels.join(heard, F.col("node") == F.col("a")).select("node", F.col("comp").alias("old"), F.least("comp", "heard").alias("comp"))
        up = low.select(F.col("node").alias("up"), F.col("comp").alias("above"))
        new = written(low.join(up, F.col("comp") == F.col("up"), "left").select("node", "old", F.least("comp", F.coalesce("above", "comp")).alias("comp")), "labels")
        labels = new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            return labels


def labelled(docs: DataFrame) -> DataFrame:
    """One row a document: id, h (row key), doc_id, n_shingles, comp (of its class; null without words), component (least id)."""
    docs = docs.select("doc_id", "text")
    all_docs = written(described(docs), "shingle-sets")
    rep = F.min(F.struct("id", "h")).alias("rep")
    classes = all_docs.where("n_shingles > 0").groupBy("cid", "check").agg(rep, F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = written(classes.select("cid", "check", "rep.id", "rep.h", "n", "sig"), "classes")
    leaders = written(keyed(classes).groupBy("key").agg(F.min("cid").alias("leader"), F.count(F.lit(1)).alias("m")).where("m > 1").select("key", "leader"), "keys")
    shared = written(keyed(classes).join(leaders, "key"), "shared-keys")
    stars = written(starred(shared, classes), "stars")
    links = written(confirmed(stars, classes, docs), "star-links")
    found = components(links)

    marked = written(suspects(blocked(shared, found, classes)), "marked")
    if not marked.isEmpty():
        more = written(joined(marked, classes, docs), "across-links")
        if not more.isEmpty():
            found = components(links.unionByName(more))

    of_class = written(classes.join(found, F.col("cid") == F.col("node"), "left").select("cid", "check", "id", F.coalesce("comp", "cid").alias("comp")), "class-components")
    least = written(of_class.groupBy("comp").agg(F.min("id").alias("component")), "component-ids")
    of_class = written(of_class.join(least, "comp").select(F.col("cid").alias("c"), F.col("check").alias("d"), "comp", "component"), "class-ids")
    return all_docs.join(of_class, (F.col("cid") == F.col("c")) & (F.col("check") == F.col("d")), "left").select("id", "h", "doc_id", "n_shingles", "comp", "component")


def clustered(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. One row a document: doc_id, n_shingles, component_id, kept."""
    own = F.when(F.col("component").isNull(), F.col("doc_id")).when(F.col("component") < LAST_ID, F.col("component"))
    out = labelled(docs).select("doc_id", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, n_shingles, component_id, kept."""
    return clustered(table(spark, sf_dir, "documents"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of each component; same columns.

    The row with the least id stays; null ids come last, and of rows with one id that with the least hash of its text.
    Of rows equal in id and text any one stays. Rows without words are linked with nothing, so all of them stay.
    """
    per_row = written(labelled(docs).where("n_shingles > 0").groupBy("comp", "id", "h").agg(F.count(F.lit(1)).alias("rows")), "component-rows")
    first = written(per_row.groupBy("comp").agg(F.min(F.struct("id", "h")).alias("first")), "component-firsts")
    placed = per_row.join(first, "comp").withColumn("stays", F.struct("id", "h") == F.col("first"))
    marks = written(placed.where("not stays or rows > 1").select("id", "h", "stays"), "not-kept")
    row_id, row_hash = row_key()
    rows = docs.select(F.struct("*").alias("row"), row_id.alias("id"), row_hash.alias("h"))  # whatever the columns' names
    key = ["id", "h"]
    out = rows.join(marks, key, "left_anti").select("row.*")
    again = marks.where("stays")
    if again.isEmpty():
        return out
    return out.unionByName(rows.join(again, key, "left_semi").dropDuplicates(key).select("row.*"))
