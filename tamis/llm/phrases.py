"""Collocations by Apriori passes: frequent phrases level by level, scored by their weakest cut.

Level k counts phrases of k words. A pass gets a table of the frequent phrases of k - 1 words and sends a phrase of k words only where
both that overlap in it, its first and its last k - 1 words, are frequent. The table is a broadcast bit table of their hashes with ``BITS_EACH``
bits a phrase and at most ``2^MOST_BITS`` bits (32 MB) whatever the corpus; a phrase it lets through wrongly is counted and found
rare, so counts and results are exact. Passes 1 and 2 read the texts; then the runs of words in which every pair is frequent are
written once, and the longer levels read those alone. Tasks count buffers of ``BUFFER`` words by exact local numbers, so a hot language, line or passage
sends one row a buffer for each of its phrases, and Spark adds them up with partial sums.

The level tables (lang, phrase, f) then give each candidate its cuts: f of both sides by joins, salted on the table's side, since one
word may begin a large share of the candidates. Scores are whole numbers from 38-digit decimals. A candidate goes where a longer one keeps enough of it;
that longer one then has it as its first or last words, or holds a candidate that has, so the cuts tell that too.

Null text: empty. Null lang: ``und``. doc_id and further columns are ignored. Repeated rows count as often as they stand there. Long texts are read whole.
Equal scores and counts: by phrase, in UTF-8 byte order. Empty table, or nothing frequent: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import Members, membership, ngram_hashes, small_batches, table, written

LEAST = 100
LONGEST = 5
TOP = 2_000
SHARE = 100  # per cent of a phrase's occurrences that a longer one must hold to drop it
BUFFER = 1_500_000  # words counted at once
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 20, 28
SALTS = 8
ROWS = 200_000  # rows of a batch sent

# The characters between pieces, all made newlines.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
CUT = bytes.maketrans(SEPARATORS, b"\n" * len(SEPARATORS))


class Numbers(dict):
    """word (bytes) of one language -> local number."""

    def __init__(self, lang: int, words: list[bytes], langs: list[int]):
        self.lang, self.words, self.langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        self.langs.append(self.lang)
        return n


class Buffer:
    """Words of some texts as local numbers, equal only for equal words of one language, with the pieces they stand in."""

    def __init__(self):
        self.langs: dict[str, int] = {}
        self.words: list[bytes] = []
        self.lang_of: list[int] = []
        self.numbers: list[Numbers] = []
        self.ids: list[int] = []
        self.pieces: list[int] = []  # words of each
        self.ends: list[int] = []  # words up to the end of each text

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.langs:
            self.langs[lang] = len(self.langs)
            self.numbers.append(Numbers(self.langs[lang], self.words, self.lang_of))
        number = self.numbers[self.langs[lang]].__getitem__
        for piece in text.lower().translate(CUT).split(b"\n"):
            found = piece.split()  # only blanks and tabs are left to split at
            if found:
                self.ids.extend(map(number, found))
                self.pieces.append(len(found))
        self.ends.append(len(self.ids))

    def close(self) -> Buffer:
        self.ids, pieces = np.array(self.ids, np.int64), np.array(self.pieces, np.int64)
        self.left = np.repeat(np.cumsum(pieces), pieces) - np.arange(len(self.ids))  # words from here to the piece's end
        return self

    def hashes(self) -> np.ndarray:
        seeds = [xxhash.xxh3_64_intdigest(lang) for lang in self.langs]
        own = np.fromiter((xxhash.xxh3_64_intdigest(w, seeds[k]) for w, k in zip(self.words, self.lang_of, strict=True)), np.uint64, len(self.words))
        return own[self.ids]

    def within(self, members: Members, k: int) -> np.ndarray:
        """Whether the k words from each place on lie in one piece and are a member."""
        out = np.zeros(len(self.ids), bool)
        if len(self.ids) >= k:
            out[: len(self.ids) - k + 1] = members.has(ngram_hashes(self.hashes(), k))
        return out & (self.left >= k)

    def counted(self, k: int, members: Members | None) -> Iterator[pa.RecordBatch]:
        """Phrases of k words with their counts here; members: the frequent ones of k - 1."""
        at = np.flatnonzero(self.left >= k)
        if members is not None:
            shorter = np.append(self.within(members, k - 1), False)
            at = at[shorter[at] & shorter[at + 1]]
        columns = [self.ids[at + j] for j in range(k)]
        bits = len(self.ids).bit_length()
        fit = max(2, 63 // bits)
        while len(columns) > 1:  # so many numbers fit 63 bits; what they make becomes a number again
            key = columns[0]
            for c in columns[1:fit]:
                key = key << bits | c
            columns = [key if len(columns) <= fit else np.unique(key, return_inverse=True)[1], *columns[fit:]]
        _, first, n = np.unique(columns[0], return_index=True, return_counts=True)
        words, names = pa.array(self.words, pa.string()), pa.array(list(self.langs), pa.string())
        lang_of = np.array(self.lang_of, np.int64)
        for low in range(0, len(first), ROWS):
            spots = at[first[low : low + ROWS]]
            parts = [words.take(pa.array(self.ids[spots + j])) for j in range(k)]
            phrase = pc.binary_join_element_wise(*parts, " ") if k > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(lang_of[self.ids[spots]])), phrase, pa.array(n[low : low + ROWS])], names=["lang", "phrase", "n"])

    def totals(self) -> pa.RecordBatch:
        n = np.bincount(np.array(self.lang_of, np.int64)[self.ids], minlength=len(self.langs))
        return pa.RecordBatch.from_arrays([pa.array(list(self.langs), pa.string()), pa.array([None] * len(n), pa.string()), pa.array(n.astype(np.int64))], names=["lang", "phrase", "n"])

    def runs(self, k: int, members: Members) -> pa.RecordBatch:
        """Of each text the stretches of more than k words in which all k neighbours are members, one a line."""
        inside = np.concatenate(([False], self.within(members, k), [False])).astype(np.int8)
        turns = np.diff(inside)
        begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1) + k - 1
        long = end - begin > k
        begin, end = begin[long], end[long]
        names, lang_of, lines = list(self.langs), self.lang_of, {}
        for text, a, b in zip(np.searchsorted(self.ends, begin, "right").tolist(), begin.tolist(), end.tolist(), strict=True):
            own = self.ids[a:b].tolist()
            lines.setdefault(text, (names[lang_of[own[0]]], []))[1].append(b" ".join([self.words[i] for i in own]))
        return pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in lines.values()], pa.string()), pa.array([b"\n".join(x) for _, x in lines.values()], pa.string())], names=["lang", "text"])


def buffers(batches) -> Iterator[Buffer]:
    """batches: lang, text."""
    now = Buffer()
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.large_binary()), strict=True):
            now.add(lang, text.as_py() or b"")
            if len(now.ids) >= BUFFER:
                yield now.close()
                now = Buffer()
    if now.ids:
        yield now.close()


def counts(texts: DataFrame, k: int, members=None) -> DataFrame:
    """texts: lang, text. lang, phrase, f of phrases of k words; k = 1: with a row of null phrase for each language, its number of words.

    members: a broadcast table of the frequent phrases of k - 1 words.
    """

    def run(batches):
        own = Members(members.value) if members is not None else None
        for b in buffers(batches):
            if k == 1:
                yield b.totals()
            yield from b.counted(k, own)

    return texts.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def table_of(level: DataFrame):
    """The broadcast bit table of a level's phrases; its size follows their number up to a bound."""

    def run(batches):
        for b in batches:
            h = [ngram_hashes(np.array([xxhash.xxh3_64_intdigest(w, xxhash.xxh3_64_intdigest(lang)) for w in phrase.split(" ")], np.uint64), 1 << 30)[0] for lang, phrase in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(h, np.uint64).view(np.int64))], names=["h"])

    n = level.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (n * BITS_EACH).bit_length()))
    return level.sparkSession.sparkContext.broadcast(membership(level.select("lang", "phrase").mapInArrow(run, "h long"), "h", bits))


def levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """docs: text, lang. (lang, phrase, k, f of the phrases of up to longest words that come at least so often; lang, n)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    first = written(counts(texts, 1).where((F.col("f") >= least) | F.col("phrase").isNull()), "phrases-1")
    totals = written(first.where("phrase is null").select("lang", F.col("f").alias("n")), "phrase-words")
    level = first.where("phrase is not null")
    out = level.withColumn("k", F.lit(1))
    for k in range(2, longest + 1):
        members = table_of(level)
        if k == 3:

            def run(batches, members=members):
                own = Members(members.value)
                for b in buffers(batches):
                    yield b.runs(2, own)

            texts = written(texts.mapInArrow(run, "lang string, text string"), "phrase-runs")
        level = written(counts(texts, k, members).where(F.col("f") >= least), f"phrases-{k}")
        out = out.unionByName(level.withColumn("k", F.lit(k)))
    return out, totals


def cuts(all_levels: DataFrame, totals: DataFrame) -> DataFrame:
    """Every cut of every candidate: lang, phrase, k, a, cut, first, rest, l, r, n, score."""
    whole = F.lit(1000).cast("decimal(4,0)")
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    words = F.split("phrase", " ")
    part = lambda low, n: F.array_join(F.slice(words, low, n), " ")
    d = all_levels.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    d = d.withColumns({"first": part(F.lit(1), F.col("cut")), "rest": part(F.col("cut") + 1, F.col("k")), "salt": F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")})
    salted = all_levels.select("lang", "phrase", "f", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
    for side, count in (("first", "l"), ("rest", "r")):
        d = d.join(salted.select("lang", F.col("phrase").alias(side), F.col("f").alias(count), "salt"), ["lang", side, "salt"])
    d = d.join(totals, "lang").withColumns({"top": whole * wide("a") * wide("n"), "low": wide("l") * wide("r")})
    return d.select("lang", "phrase", "k", "a", "cut", "first", "rest", "l", "r", "n", F.expr("top div low").alias("score"))


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE) -> DataFrame:
    """docs: text, lang. Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    all_levels, totals = levels(docs, least, longest)
    every = written(cuts(all_levels, totals), "phrase-cuts")
    weakest = every.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("c"))
    held = lambda count: 100 * F.col("a") >= share * F.col(count)
    first, rest = every.where(held("l") & (F.col("cut") > 1)).select("lang", F.col("first").alias("phrase")), every.where(held("r") & (F.col("k") - F.col("cut") > 1)).select("lang", F.col("rest").alias("phrase"))
    kept = weakest.join(first.unionByName(rest).distinct(), ["lang", "phrase"], "left_anti").select("lang", "phrase", "c.*")
    order = (F.desc("score"), F.desc("a"), F.col("phrase"))
    # A language may have most rows: its best of each salt first.
    some = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 collocations of documents: lang, rank, phrase, a, l, r, n, score."""
    return phrases(table(spark, sf_dir, "documents").select("text", "lang"))
