"""Language-model scores from a log-frequency Bloom filter.

Counting. Tasks count words and word pairs of the training texts and send sorted, packed stretches of
hashes to their owners (``part``, the hash's top bits), who add them up: unigrams exactly, pairs that come at
least ``LEAST_PAIR`` times. All documents count.

Filter (log-frequency Bloom filter): a count c has level ``1 + floor(2 log2 c)``; a pair is put in once for
each level up to its own, ``PROBES`` bits each. A reader probes level after level until one is missing, which gives the
quantised count. Each part has a filter of its own, with ``BITS_EACH`` bits for each insertion counted: the filters
grow with the corpus, whatever its size an absent pair reads as one with the same chance, and no level is left out. They
stay with the owners: a batch sends its distinct pairs there and their levels travel back. Pairs travel as the
``KEY_BYTES`` bytes of their hashes after the part's bits, words as whole hashes.

Score: log10 of ``p(w | v) = (min(c(vw), c(v)) + MU * p(w)) / (c(v) + MU)`` over the words and the end, with
``p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))``; counts of words are exact, those of pairs as the filter has them.

Base score: the unigram formula alone. Words that make up at least ``1 / FREQUENT`` of all tokens (so at most
FREQUENT words) are looked up in the tasks; the others travel with the pairs to the owners of their counts.

Null or empty text: one token, the end; an empty table: no rows; long texts are counted and scored whole; equal scores stand as they are. Repeated rows count as often as they stand there. Null ids count as
the empty string in the split. An empty training fold gives N = V = 0 and uniform scores. Columns
beyond doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import MIX_1, MIX_2, WordHashes, fold, mixed, small_batches, table, written

LEAST_PAIR = 1
BITS_EACH, PROBES = 10, 3
KEY_BYTES = 5  # two of a part's pairs meet once in 10^12
LEVELS = 127  # counts up to 2^63
MU = 2_000.0
FREQUENT = 1 << 19
BUFFER = 1_500_000  # tokens counted at once
PART_TOKENS = 4_000_000  # tokens that a part is meant for, about
END, START = np.uint64(0x454E44), np.uint64(0x5354415254)


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of (previous word, word) for the words of one text, the first after START."""
    return mixed(np.append(START, h[:-1]) * MIX_1 + h * MIX_2)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(2 * np.log2(np.maximum(counts, 1)) + 1e-9).astype(np.int64)


def level_counts() -> np.ndarray:
    """The count that a level stands for: the middle of its whole numbers; 0 for level 0."""
    k = np.arange(LEVELS + 1)
    low, high = np.ceil(2 ** ((k - 1) / 2) - 1e-9), np.ceil(2 ** (k / 2) - 1e-9) - 1
    return np.where(k == 0, 0, (low + np.maximum(low, high)) / 2)


def bit_places(h: np.ndarray, step: int, probe: int, bits: int) -> np.ndarray:
    """Place of one probe of n-grams at a level in a filter of so many bits."""
    salt = np.uint64((step * PROBES + probe) * int(MIX_1) % (1 << 64))
    return (mixed(h + salt) % np.uint64(bits)).astype(np.int64)


def packed(h: np.ndarray, log2_parts: int) -> bytes:
    """Sorted hashes of one part by their KEY_BYTES bytes after the part's bits; all lowest bytes first, so that the highest compress."""
    return (h << np.uint64(log2_parts)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - KEY_BYTES :].T.tobytes()


def unpacked(keys: bytes, part: int, log2_parts: int) -> np.ndarray:
    """The hashes of packed(), up to the bits it keeps."""
    out = np.zeros((len(keys) // KEY_BYTES, 8), dtype=np.uint8)
    out[:, 8 - KEY_BYTES :] = np.frombuffer(keys, np.uint8).reshape(KEY_BYTES, -1).T
    return out.view("<u8")[:, 0] >> np.uint64(log2_parts) | np.uint64(part << 64 - log2_parts)


def filter_of(h: np.ndarray, levels: np.ndarray, bits_each: int) -> bytes:
    """The filter of n-grams with these levels, sized by their insertions."""
    bits = max(8, int(levels.sum()) * bits_each) + 7 & ~7
    own = np.zeros(bits, dtype=bool)
    for step in range(1, int(levels.max(initial=0)) + 1):
        h, levels = h[levels >= step], levels[levels >= step]
        for probe in range(PROBES):
            own[bit_places(h, step, probe, bits)] = True
    return np.packbits(own).tobytes()


def levels_in(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Levels of n-grams by repeated membership probes; table: the bytes of filter_of."""
    found = np.zeros(len(h), dtype=np.uint8)
    open_ = np.arange(len(h)) if len(table) else np.empty(0, np.int64)
    for step in range(1, LEVELS + 1):
        for probe in range(PROBES):
            at = bit_places(h[open_], step, probe, 8 * len(table))
            open_ = open_[(table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1]
        if not len(open_):
            break
        found[open_] = step
    return found


def _parts(spark: SparkSession, docs: DataFrame) -> int:
    """log2 of the number of parts: grows with the input, so that a part's counts fit a task."""
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(6, int(np.ceil(np.log2(max(1, letters / 6 / PART_TOKENS)))))


def counted(docs: DataFrame, log2_parts: int) -> DataFrame:
    """docs: text, held_out. Rows by part and kind: 1 words with packed hashes, trained, held (sorted by hash); 2 the filter of the pairs."""
    bits_each = BITS_EACH

    def run(batches):
        words = WordHashes()
        buffers: dict[tuple[int, bool], list[np.ndarray]] = {}
        size = 0

        def out():
            rows = []
            for (kind, held), arrays in buffers.items():
                uniq, n = np.unique(np.concatenate(arrays), return_counts=True)
                edges = np.searchsorted(uniq, np.arange(1, 1 << log2_parts, dtype=np.uint64) << np.uint64(64 - log2_parts))
                for part, (h, c) in enumerate(zip(np.split(uniq, edges), np.split(n, edges), strict=True)):
                    if not len(h):
                        continue
                    ones = c == 1  # most: sent without their counts
                    once, more = (packed(x, log2_parts) if kind == 2 else x.tobytes() for x in (h[ones], h[~ones]))
                    rows.append((part, kind, held, once, more, c[~ones].astype("<u4").tobytes()))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)], names=["part", "kind", "held", "once", "more", "counts"])

        for b in batches:
            for text, held in zip(b.column(0).cast(pa.large_binary()).to_pylist(), b.column(1).to_pylist(), strict=True):
                h = np.append(words.of((text or b"").lower().split()), END)
                buffers.setdefault((1, held), []).append(h)
                if not held:
                    buffers.setdefault((2, held), []).append(pair_hashes(h))
                size += len(h)
                if size >= BUFFER:
                    yield out()
                    buffers, size = {}, 0
        yield out()

    sent = docs.select("text", "held_out").mapInArrow(run, "part long, kind int, held boolean, once binary, more binary, counts binary")

    def add(batches):
        """Adds up the counts of one part and kind after the other."""
        now, pieces = None, []
        for b in batches:
            for part, kind, held, once, more, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (part, kind) != now:
                    if pieces:
                        yield total(now, pieces)
                    now, pieces = (part, kind), []
                h1, h2 = (unpacked(x, part, log2_parts) if kind == 2 else np.frombuffer(x, "<u8") for x in (once, more))
                c = np.concatenate((np.ones(len(h1), np.int64), np.frombuffer(counts, "<u4").astype(np.int64)))
                pieces.append((np.concatenate((h1, h2)), c, held))
        if pieces:
            yield total(now, pieces)

    def total(key, pieces):
        h = np.concatenate([p[0] for p in pieces])
        order = np.argsort(h)
        h = h[order]
        c = np.concatenate([p[1] for p in pieces])[order]
        held = np.repeat([p[2] for p in pieces], [len(p[0]) for p in pieces])[order]
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
        trained = np.add.reduceat(np.where(held, 0, c), starts) if len(h) else c
        rest = np.add.reduceat(np.where(held, c, 0), starts) if len(h) else c
        h = h[starts]
        if key[1] == 2:
            keep = trained >= LEAST_PAIR
            row = (*key, b"", b"", b"", filter_of(h[keep], level(trained[keep]), bits_each), 0, 0, 0)
        else:
            row = (*key, h.tobytes(), trained.astype("<i8").tobytes(), rest.astype("<i8").tobytes(), b"", int(trained.sum()), int((trained > 0).sum()), int((trained + rest).sum()))
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in zip(row, kinds, strict=True)], names=["part", "kind", "hashes", "trained", "held", "filter", "n", "v", "n_all"])

    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        sent.repartition(partitions, "part").sortWithinPartitions("part", "kind")
        .mapInArrow(add, "part long, kind int, hashes binary, trained binary, held binary, filter binary, n long, v long, n_all long")
    )


def frequent(counts: DataFrame, n_all: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and training counts of the words with at least n_all / FREQUENT of all occurrences: at most FREQUENT words."""
    least = n_all / FREQUENT

    def run(batches):
        for b in batches:
            for hashes, trained, held in zip(*(c.to_pylist() for c in b.columns), strict=True):
                t, r = np.frombuffer(trained, "<i8"), np.frombuffer(held, "<i8")
                keep = t + r >= least
                yield pa.RecordBatch.from_arrays([pa.array([np.frombuffer(hashes, "<u8")[keep].tobytes()], type=pa.binary()), pa.array([t[keep].tobytes()], type=pa.binary())], names=["hashes", "trained"])

    rows = counts.where("kind = 1").select("hashes", "trained", "held").mapInArrow(run, "hashes binary, trained binary").collect()
    h = np.concatenate([np.frombuffer(r["hashes"], "<u8") for r in rows] or [np.empty(0, np.uint64)])
    c = np.concatenate([np.frombuffer(r["trained"], "<i8") for r in rows] or [np.empty(0, np.int64)])
    order = np.argsort(h)
    return h[order], c[order]


def looked_up(keys: np.ndarray, values: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of h, whether h is among keys); keys sorted."""
    if not len(keys):
        return np.zeros(len(h), np.int64), np.zeros(len(h), dtype=bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    have = keys[at] == h
    return np.where(have, values[at], 0), have


class Tokens:
    """The words of a batch of texts, distinct words and pairs sorted by hash; the same whenever it is made."""

    def __init__(self, words: WordHashes, texts: pa.Array, keys: np.ndarray, values: np.ndarray):
        h = [np.append(words.of((x or b"").lower().split()), END) for x in texts.cast(pa.large_binary()).to_pylist()]
        self.size = np.array([len(x) for x in h])
        self.first = np.append(0, np.cumsum(self.size)[:-1])
        self.words, self.back = np.unique(np.concatenate(h), return_inverse=True)
        self.pairs, self.pair_back = np.unique(np.concatenate([pair_hashes(x) for x in h]), return_inverse=True)
        self.counts, have = looked_up(keys, values, self.words)
        self.rare = np.flatnonzero(~have)


def score(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, held_out. One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    small_batches(spark)
    log2_parts = _parts(spark, docs)
    counts = written(counted(docs, log2_parts), "ngram-counts")
    sums = counts.where("kind = 1").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("n_all").alias("n_all")).first()
    n, v, n_all = (sums[k] or 0 for k in ("n", "v", "n_all"))
    norm = float(np.log10(n + 0.5 * (v + 1)))
    # As many starts as ends.
    n_end = counts.where("kind = 1").select("hashes", "trained").where(F.col("part") == int(END >> np.uint64(64 - log2_parts))).first()
    starts = int(looked_up(np.frombuffer(n_end["hashes"], "<u8"), np.frombuffer(n_end["trained"], "<i8"), np.array([END]))[0][0]) if n_end else 0
    common = spark.sparkContext.broadcast(frequent(counts, n_all))

    def dealt(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for ordinal, b in enumerate(batches):
            if b.num_rows:
                sheet = pa.BufferOutputStream()
                with pa.ipc.new_stream(sheet, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                    to.write_batch(b)
                yield pa.RecordBatch.from_arrays([pa.array([(task << 32) + ordinal]), pa.array([sheet.getvalue().to_pybytes()], type=pa.binary())], names=["batch", "x"])

    # Written, so that questions and answers are of the same batches.
    sheets = written(docs.select("doc_id", "text", "held_out").mapInArrow(dealt, "batch long, x binary"), "batches")

    def ask(batches):
        words, (keys, values) = WordHashes(), common.value
        edges = np.arange(1, 1 << log2_parts, dtype=np.uint64) << np.uint64(64 - log2_parts)
        for b in batches:
            for batch, sheet in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                t = Tokens(words, pa.ipc.open_stream(sheet.as_buffer()).read_next_batch().column(1), keys, values)
                asked = [np.split(h, np.searchsorted(h, edges)) for h in (t.words[t.rare], t.pairs)]
                rows = [(part, batch, x.tobytes(), packed(y, log2_parts)) for part, (x, y) in enumerate(zip(*asked, strict=True)) if len(x) or len(y)]
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["part", "batch", "x", "y"])

    def answer(batches):
        """A part's counts and filter come first, then the batches' questions: hashes of words, of pairs. Back go counts, levels."""
        own, none = None, (np.empty(0, np.uint64), np.empty(0, np.int64))
        for b in batches:
            out = []
            for part, batch, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part != own:
                    own, (keys, values), table_ = part, none, np.empty(0, np.uint8)
                if batch == -2:
                    keys, values = np.frombuffer(x, "<u8"), np.frombuffer(y, "<i8")
                elif batch == -1:
                    table_ = np.frombuffer(x, np.uint8)
                else:
                    c, _ = looked_up(keys, values, np.frombuffer(x, "<u8"))
                    out.append((batch, part, c.astype("<u4").tobytes(), levels_in(table_, unpacked(y, part, log2_parts)).tobytes()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["batch", "part", "x", "y"])

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    questions = sheets.mapInArrow(ask, "part long, batch long, x binary, y binary")
    is_words = F.col("kind") == 1
    owners = counts.select("part", F.when(is_words, -2).otherwise(-1).cast("long").alias("batch"), F.when(is_words, F.col("hashes")).otherwise(F.col("filter")).alias("x"), F.col("trained").alias("y"))
    answers = owners.unionByName(questions).repartition(partitions, "part").sortWithinPartitions("part", "batch").mapInArrow(answer, "batch long, part long, x binary, y binary")

    def finish(batches):
        words, (keys, values), stands = WordHashes(), common.value, level_counts()
        sheet, known, levels = None, [], []

        def done():
            b = pa.ipc.open_stream(sheet).read_next_batch()
            t, m = Tokens(words, b.column(1), keys, values), b.num_rows
            t.counts[t.rare] = np.frombuffer(b"".join(known), "<u4")  # parts come in the order of the hashes; rare words' counts are small
            doc, c_w = np.repeat(np.arange(m), t.size), t.counts[t.back].astype(float)
            c_v = np.append(0.0, c_w[:-1])
            c_v[t.first] = starts
            c_vw = np.minimum(stands[np.frombuffer(b"".join(levels), np.uint8)][t.pair_back], c_v)
            logs = np.log10(c_w + 0.5) - norm
            total = np.bincount(doc, weights=np.log10((c_vw + MU * 10**logs) / (c_v + MU)), minlength=m)
            n_known = np.bincount(doc, weights=c_w > 0, minlength=m).astype(np.int64)
            arrays = [b.column(0), b.column(2), pa.array(t.size), pa.array(n_known), pa.array(np.full(m, n)), pa.array(np.bincount(doc, weights=logs, minlength=m)), pa.array(total)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for b in batches:
            for _, part, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part == -1:
                    if sheet is not None:
                        yield done()
                    sheet, known, levels = x, [], []
                else:
                    known.append(x)
                    levels.append(y)
        if sheet is not None:
            yield done()

    return (
        sheets.select("batch", F.lit(-1).cast("long").alias("part"), "x", F.lit(b"").alias("y")).unionByName(answers).repartition(partitions, "batch").sortWithinPartitions("batch", "part")
        .mapInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    )


def op2_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out"))
    return score(docs)
