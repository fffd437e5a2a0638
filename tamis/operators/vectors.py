"""Nearest neighbours of vectors by cosine: cells around centroids, several probed, exact cosine on the candidates.

Equal vectors are one class first (the smallest id stands for it, with the number of its rows), so that a vector which a third of all rows
share is one candidate. Centroids are fitted on at most ``SAMPLE`` classes, chosen by hash; every class goes to its nearest cell. How many
cells a query looks into is measured: the fewest that find ``RECALL`` of the nearest neighbours within the sample; the nearest of all rows are nearer
still and found more often. Vectors without structure need most cells, so they cost as much as comparing all. Cells are dealt in blocks of about ``BLOCK`` classes and ``ASKED`` queries, each pair of blocks a group of its own, so a
crowded cell is many groups of bounded size; each sends at most k candidates a query on.

Null, empty or zero vectors, and those of another length than most, have no direction: they are no candidates and get no neighbours. Values that are no
numbers count as 0. Ties of cosine: by the smaller id. Null ids stand last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.scratch import written

SAMPLE = 20_000
CELL_CLASSES, MOST_CELLS = 500, 1_024
RECALL, TRIED = 0.95, 400  # share of neighbours that a sample of queries must find
ROUNDS = 8
BLOCK, ASKED = 4_096, 1_024
LAST_ID = (1 << 63) - 1


def unit(vectors: DataFrame, dims: int) -> DataFrame:
    """vectors: id, v (array). id, key (of the vector's bytes), v (float32 of length 1)."""

    def run(batches):
        for b in batches:
            ids, keys, out = [], [], []
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                v = np.nan_to_num(np.array([0 if y is None else y for y in x or ()], np.float32), posinf=0, neginf=0)
                length = float(np.linalg.norm(v.astype(np.float64)))
                if len(v) == dims and length > 0:
                    ids.append(LAST_ID if i is None else i)
                    keys.append(xxhash.xxh3_128_digest(v.tobytes()))
                    out.append((v / length).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(out, pa.binary())], names=["id", "key", "v"])

    return vectors.mapInArrow(run, "id long, key binary, v binary")


def fitted(classes: DataFrame, n: int, k_near: int) -> tuple[np.ndarray, int]:
    """(centroids, probes): spherical k-means on a bounded sample, and the cells to look into; the same for the same classes."""
    rows = classes.orderBy(F.xxhash64("key"), "key").select("v").limit(SAMPLE).collect()  # SAMPLE at most
    x = np.frombuffer(b"".join(r["v"] for r in rows), "<f4").reshape(len(rows), -1)
    k = max(1, min(MOST_CELLS, len(x), n // CELL_CLASSES))
    centre = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        near = np.argmax(x @ centre.T, axis=1)
        for c in range(k):
            if (own := x[near == c]).size:
                s = own.sum(axis=0)
                centre[c] = s / (np.linalg.norm(s) or 1)
    cell = np.argmax(x @ centre.T, axis=1)
    tried = np.unique(np.linspace(0, len(x) - 1, min(TRIED, len(x))).astype(int))
    sims = x[tried] @ x.T
    sims[np.arange(len(tried)), tried] = -2
    near = np.argsort(-sims, axis=1)[:, : min(k_near, max(1, len(x) - 1))]
    place = np.argsort(np.argsort(-(x[tried] @ centre.T), axis=1), axis=1)  # of each cell in each query's order
    needed = np.sort(np.take_along_axis(place, cell[near], axis=1).ravel())
    return centre, int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1


def _dealt(rows: DataFrame, centre, most: int, kind: int, mine, others) -> DataFrame:
    """Each row once for each of its ``most`` nearest cells and each block of the other side there: cell, r, q, kind, key, id, n, v."""

    def run(batches):
        c, own, other = centre.value, mine.value, others.value
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column(3).to_pylist()), "<f4").reshape(b.num_rows, -1)
            sims = x @ c.T
            top = np.argsort(-sims, axis=1, kind="stable")[:, :most]
            out = []
            for row, cells, (key, i, n, v) in zip(range(len(x)), top.tolist(), zip(*(col.to_pylist() for col in b.columns), strict=True), strict=True):
                spot = xxhash.xxh3_64_intdigest(key)
                for cell in cells:
                    for o in range(other.get(cell, 0)):
                        part = spot % own.get(cell, 1)
                        out.append((cell, *((o, part) if kind == 0 else (part, o)), kind, key, i, n, v))
            columns = list(zip(*out, strict=True)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["cell", "r", "q", "kind", "key", "id", "n", "v"])

    return rows.select("key", "id", "n", "v").mapInArrow(run, "cell int, r int, q int, kind int, key binary, id long, n long, v binary")


def _sizes(rows: DataFrame, centre, most: int, block: int) -> dict[int, int]:
    """Blocks of each cell: a number for each of at most MOST_CELLS."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = np.frombuffer(b"".join(b.column(0).to_pylist()), "<f4").reshape(b.num_rows, -1)
                cells = np.argsort(-(x @ centre.value.T), axis=1, kind="stable")[:, :most].ravel()
                found, n = np.unique(cells, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(n.astype(np.int64))], names=["cell", "n"])

    return {r["cell"]: -(-r["n"] // block) for r in rows.select("v").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()}


def neighbours(df: DataFrame, id: str, vector: str, asked: Column, k: int = 10, probes: int | None = None) -> DataFrame:
    """For each row that asked holds for, its k nearest other vectors: id, rank (from 1), neighbour (smallest id with that vector), copies (rows with it), cosine. probes: cells to look into, if not by measure."""
    spark = df.sparkSession
    dims = df.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0").orderBy(F.desc("n"), "d").first()
    schema = "id long, rank int, neighbour long, copies long, cosine double"
    if dims is None:
        return spark.createDataFrame([], schema)
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    every = written(unit(rows.select("id", "v"), dims["d"]), "vectors")
    classes = written(every.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")), "vector-classes")
    size = classes.count()
    if not size:
        return spark.createDataFrame([], schema)
    asks = written(unit(rows.where("asked").select("id", "v"), dims["d"]), "vector-asks")
    queries = written(asks.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")), "vector-queries")
    send = spark.sparkContext.broadcast
    centre, enough = fitted(classes, size, k)
    probes, centre = probes or enough, send(centre)
    row_blocks, query_blocks = send(_sizes(classes, centre, 1, BLOCK)), send(_sizes(queries, centre, probes, ASKED))

    def search(batches):
        now, wanted, held, best = None, [], [], {}

        def compare():
            if not (wanted and held):
                return
            sims = np.stack([w[1] for w in wanted]) @ np.stack([h[3] for h in held]).T
            ids = np.array([h[1] for h in held])
            for (key, _), row in zip(wanted, sims, strict=True):
                order = np.lexsort((ids, -np.round(row, 6)))[: k + 1]
                found = best.setdefault(key, [])
                found += [(-round(float(row[j]), 6), held[j][1], held[j][2]) for j in order if held[j][0] != key]
                found.sort()
                del found[k:]

        def sent():
            out = [(key, i, n, -s) for key, found in best.items() for s, i, n in found]
            columns = list(zip(*out, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["key", "neighbour", "copies", "cosine"])

        for b in batches:
            for cell, r, q, kind, key, i, n, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (cell, r, q) != now:
                    compare()
                    if best:
                        yield sent()
                    now, wanted, held, best = (cell, r, q), [], [], {}
                x = np.frombuffer(v, "<f4")
                if kind == 0:
                    wanted.append((key, x))
                else:
                    held.append((key, i, n, x))
                    if len(held) >= BLOCK:
                        compare()
                        held = []
        compare()
        if best:
            yield sent()

    group = ["cell", "r", "q"]
    both = _dealt(queries, centre, probes, 0, query_blocks, row_blocks).unionByName(_dealt(classes, centre, 1, 1, row_blocks, query_blocks))
    found = both.repartition(*group).sortWithinPartitions(*group, "kind").mapInArrow(search, "key binary, neighbour long, copies long, cosine double")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("key").orderBy(F.desc("cosine"), "neighbour"))).where(F.col("rank") <= k)
    # One vector may be asked for by many rows.
    salts = 16
    answers = ranked.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    return asks.select("id", "key", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt")).join(answers, ["key", "salt"]).select("id", "rank", "neighbour", "copies", "cosine")
