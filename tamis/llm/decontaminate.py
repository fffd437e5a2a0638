"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items and documents become sequences of folded words: lower case, without marks at the
ends. Every item's n-grams are looked for in the corpus and counted. An n-gram that occurs
far more often than the item's other n-grams is a common turn of phrase, not a trace of
the item, and is no seed; the remaining, relatively rare ones are. A document that
shares a seed with an item is aligned with it, word by word, in a window around the
seed; its score is the matched share of the item. Documents with a score of ``LEAST`` or more count as
contaminated, so exact copies, edited ones and ones with words put in or left out are found.

The items' n-grams go to the workers in blocks of at most ``BLOCK`` seeds, whatever the benchmark's size; each
block is one pass over the documents, which writes those that hold any of its n-grams, whole. The counts and the
alignment read that table, which goes with the block. Whether an n-gram is rare is a ratio within its item, so an item
that stands in a third of all documents keeps its seeds.

Null or empty texts and items match nothing; empty tables: no rows. Texts of any length are searched whole; windows of equal score count once, by the score. Repeated rows are each answered. Items of fewer than
``N`` words are one seed as a whole. Null ids pass through. Columns beyond those named are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import CACHE_ENTRIES, ngram_hashes, passing, released, small_batches, table, written

N = 4
LEAST = 0.6
# An n-gram this many times as frequent as the item's median n-gram (and more than FEW) is no seed.
COMMON, FEW = 16, 64
BLOCK = 2_000_000
# Smith-Waterman: word equal, word exchanged, word put in or left out.
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
TRIM = b".,;:!?\"'`()[]{}<>%&$#*|_~^+=/\\-"


class Folded(dict):
    """word -> hash of the folded word; 0 for a word of marks only."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 2 * CACHE_ENTRIES:
            self.clear()
        core = word.strip(TRIM)
        core = core.lower() if core.isascii() else core.decode().strip("«»“”„‘’‚…—–¿¡").lower().encode()
        value = self[word] = (xxhash.xxh3_64_intdigest(core) | 1) if core else 0
        return value

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        out = np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))
        return out if out.all() else out[out != 0]


def align(item: np.ndarray, window: np.ndarray) -> float:
    """Share of the item's words that the best local alignment matches (Smith-Waterman, rows at once)."""
    if not len(item) or not len(window):
        return 0.0
    steps = np.arange(len(window) + 1, dtype=np.float32)
    equal = item[:, None] == window[None]
    h = np.zeros(len(window) + 1, dtype=np.float32)
    m = np.zeros(len(window) + 1, dtype=np.float32)  # matched words on the path to each cell
    best, matched = 0.0, 0.0
    for i in range(len(item)):
        diagonal = h[:-1] + np.where(equal[i], MATCH, MISMATCH).astype(np.float32)
        up = h + np.float32(GAP)
        new = np.maximum(up, 0)
        took = np.where(up > 0, m, 0)
        better = diagonal > new[1:]
        new[1:] = np.where(better, diagonal, new[1:])
        took[1:] = np.where(better, m[:-1] + equal[i], took[1:])
        # Gaps along the row: the best of all cells to the left, less a gap a step.
        lifted = new - np.float32(GAP) * steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted >= top, np.arange(len(top)), 0))
        new = top + np.float32(GAP) * steps
        took = took[source]
        h, m = np.maximum(new, 0), np.where(new > 0, took, 0)
        k = int(h.argmax())
        if h[k] > best:
            best, matched = float(h[k]), float(m[k])
    return matched / len(item)


class Lookup:
    """Membership of 64-bit hashes in a sorted set, by a bit table first."""

    bits = 22

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.table = np.zeros(1 << self.bits, dtype=bool)
        self.table[(keys >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in hashes, places in keys) of the members."""
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[k] == hashes[at]
        return at[same], k[same]


def windows(hashes: np.ndarray, n: int, shorts: list[int]):
    """n-gram hashes of a document; and those of shorter items' lengths, for items below n words."""
    yield ngram_hashes(hashes, n) if len(hashes) >= n else hashes[:0]
    for size in shorts:
        if len(hashes) >= size:
            yield ngram_hashes(hashes, size)


def holding(docs: DataFrame, keys: np.ndarray, n: int, shorts: list[int]) -> DataFrame:
    """The documents that hold any n-gram of keys: doc_id, text, grams (places in keys, each once)."""
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        look, folded = Lookup(sent.value), Folded()
        for b in released(batches):
            held = []
            for text in b.column(1).cast(pa.large_binary()).to_pylist():
                hashes = folded.of(text or b"")
                held.append(np.unique(np.concatenate([look.places(grams)[1] for grams in windows(hashes, n, shorts)])))
            sizes = np.array([len(x) for x in held], dtype=np.int64)
            some = np.flatnonzero(sizes)
            if len(some):
                rows = b.take(pa.array(some))
                grams = pa.ListArray.from_arrays(pa.array(np.append(0, sizes[some].cumsum()), type=pa.int32()), pa.array(np.concatenate(held), type=pa.int32()))
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), rows.column(1), grams], names=["doc_id", "text", "grams"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, text string, grams array<int>")


def aligned(held: DataFrame, block: dict, n: int, shorts: list[int], least: float) -> DataFrame:
    """Alignment of the documents of holding() that hold a seed."""
    sent = held.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        x, folded = sent.value, Folded()
        look = Lookup(x["keys"])
        for b in released(batches):
            if not b.num_rows:
                continue
            sizes = b.column(2).value_lengths().to_numpy()  # none is 0
            b = b.filter(pa.array(np.logical_or.reduceat(x["seed"][b.column(2).flatten().to_numpy()], np.cumsum(sizes) - sizes)))
            out = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                hashes = folded.of(text or b"")
                hits: dict[int, list[int]] = {}
                for grams in windows(hashes, n, shorts):
                    for at, k in zip(*look.places(grams), strict=True):
                        for e in range(x["first"][k], x["first"][k + 1]):
                            hits.setdefault(int(x["item"][e]), []).append(int(at) - int(x["at"][e]))
                for item, starts in sorted(hits.items()):
                    words = x["words"][item]
                    slack = len(words) // 2 + 2
                    best, done = 0.0, None
                    for start in sorted(set(starts)):
                        if done is not None and start - slack < done:  # the last window covers it
                            continue
                        done = start + slack
                        window = hashes[max(0, start - slack) : start + len(words) + 2 * slack]
                        best = max(best, align(words, window))
                    if best >= least:
                        out.append((doc, x["ids"][item], len(starts), best))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["doc_id", "item_id", "n_seeds", "score"])

    return held.mapInArrow(run, "doc_id long, item_id long, n_seeds long, score double")


def grams_of(words: list[np.ndarray], n: int):
    """One row for each item (by row) and distinct n-gram, with its first place."""
    rows, grams, places = [], [], []
    for k, w in enumerate(words):
        g, at = np.unique(ngram_hashes(w, n), return_index=True)
        rows.append(np.full(len(g), k))
        grams.append(g.view(np.int64))
        places.append(at)
    join = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
    return pd.DataFrame({"row": join(rows, np.int64), "gram": join(grams, np.int64), "at": join(places, np.int32)})


def blocks(items: DataFrame, size: int):
    """Items in blocks of about size words, by hash of the id: what is collected at once has that bound."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    k = max(1, -(-total // (5 * size)))
    for i in range(k):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(k)) == i) if k > 1 else items


def contaminated(docs: DataFrame, items: DataFrame, n: int = N, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """docs: doc_id, text; items: item_id, text. One row for each contaminated document and item: doc_id, item_id, n_seeds, score."""
    spark = docs.sparkSession
    small_batches(spark)
    found = []
    items = items.select("item_id", "text").where("text is not null")
    for part in blocks(items, block):
        rows = part.toPandas()  # a block
        if rows.empty:
            continue
        folded = Folded()
        words = [folded.of(x.encode()) for x in rows["text"]]
        grams = grams_of(words, n)
        shorts = sorted({len(w) for w in words if 0 < len(w) < n})
        keys = np.unique(grams["gram"].to_numpy().view(np.uint64))
        with passing(holding(docs, keys, n, shorts), "holding") as held:
            df = held.select(F.explode("grams").alias("k")).groupBy("k").count().toPandas()  # at most one row a key of the block
            seen = np.zeros(len(keys), dtype=np.int64)
            seen[df["k"].to_numpy(dtype=np.int64)] = df["count"]
            grams["k"] = np.searchsorted(keys, grams["gram"].to_numpy().view(np.uint64))
            grams["df"] = seen[grams["k"]]
            middle = grams.groupby("row")["df"].transform("median")
            seeds = grams[(grams["df"] <= np.maximum(FEW, COMMON * middle)) & (grams["df"] > 0)].sort_values(["k", "row"])
            if seeds.empty:
                continue
            used, first = np.unique(seeds["k"].to_numpy(), return_index=True)
            seed = np.zeros(len(keys), dtype=bool)
            seed[used] = True
            sent = {"seed": seed, "keys": keys[used], "first": np.append(first, len(seeds)), "item": seeds["row"].to_numpy(), "at": seeds["at"].to_numpy(), "words": words, "ids": rows["item_id"].tolist()}
            found.append(written(aligned(held, sent, n, shorts, least), "aligned"))
    if not found:
        return spark.createDataFrame([], "doc_id long, item_id long, n_seeds long, score double")
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with its test items: doc_id, item_id, n_seeds, score."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the rows whose text is contaminated; same columns. Rows with null ids are judged by their text too.

    Rows are told by 64 bits of the text's hash: of n clean and m contaminated texts, n * m / 2^64 clean ones go wrongly.
    """
    key = F.xxhash64("text")
    bad = contaminated(docs.select(key.alias("doc_id"), "text"), items).select(F.col("doc_id").alias("key")).distinct()
    rows = docs.select(F.struct("*").alias("row"), key.alias("key"))  # whatever the columns' names
    return rows.join(written(bad, "contaminated"), "key", "left_anti").select("row.*")
