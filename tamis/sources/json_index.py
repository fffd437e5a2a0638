"""Elements of large JSON arrays by a structural index: string and bracket state by byte block, combined along the file.

A block doesn't know whether it begins within a string, so it gives both answers: its unescaped quotes, and its net depth if it begins outside
or inside one. Running sums of these narrow rows (one a block) fix where each block stands; then every task finds the commas at the array's depth in
its own blocks and reads the elements that begin after them, the last one on into the blocks that follow. A file of any size is dealt to many tasks; an element is
one value, and the outer object's fields besides the array are one value.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.scratch import written
from tamis.sources.byte_ranges import Batches, opened, register

BLOCK = 4 << 20
AHEAD = 1 << 14  # bytes first read behind a block, for the element that goes on there
QUOTE, BACKSLASH, COMMA, COLON, OPEN, CLOSE = 34, 92, 44, 58, (91, 123), (93, 125)
KEYS = ("example", "examples", "test", "data", "questions")
BLANKS = b" \t\r\n"
STEP = np.zeros(256, np.int64)
STEP[list(OPEN)], STEP[list(CLOSE)] = 1, -1
COUNTS = STEP != 0
COUNTS[[QUOTE, BACKSLASH, COMMA, COLON]] = True
BLANK = np.isin(np.arange(256), list(BLANKS + b"\xef\xbb\xbf"))


def structure(a: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places of commas, colons and brackets, these bytes, whether an odd number of quotes stands before each, unescaped quotes). run: backslashes just before the bytes.

    Only the few bytes that count are looked at, not every byte of the texts between.
    """
    i = np.flatnonzero(COUNTS[a])
    c = a[i]
    k = np.arange(len(i))
    chained = np.zeros(len(i), bool)  # a backslash stands just before
    chained[1:] = (c[:-1] == BACKSLASH) & (i[1:] == i[:-1] + 1)
    begun = np.maximum.accumulate(np.where(chained, 0, k))
    before = k - begun + np.where(i[begun] == 0, run, 0)
    quotes = (c == QUOTE) & (before & 1 == 0)
    odd = (np.cumsum(quotes) & 1).astype(bool)
    kept = (c != QUOTE) & (c != BACKSLASH)
    return i[kept], c[kept], odd[kept], int(quotes.sum())


def outside(a: np.ndarray, inside: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places of commas, colons and brackets outside strings, these bytes, their steps of depth, unescaped quotes) of bytes that begin within a string or not."""
    i, c, odd, quotes = structure(a, run)
    own = odd == bool(inside)
    return i[own], c[own], STEP[c[own]], quotes


def backslashes_before(f: pa.NativeFile, start: int) -> int:
    n = 0
    while start > n:
        low = max(0, start - n - 4096)
        f.seek(low)
        piece = f.read(start - n - low)
        own = len(piece) - len(piece.rstrip(b"\\"))
        n += own
        if own < len(piece):
            break
    return n


def block_of(f: pa.NativeFile, start: int, end: int) -> tuple[np.ndarray, int]:
    run = backslashes_before(f, start)
    f.seek(start)
    return np.frombuffer(f.read(end - start), np.uint8), run


def _rows(batches):
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def tasks(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def dealt_out(blocks: DataFrame) -> DataFrame:
    """Blocks dealt to all tasks: their rows are so few bytes that Spark would hand all of them to one, whatever files they stand for.

    Not by columns: behind a join by the same ones that counts as done, and the join's tasks become one.
    """
    return blocks.repartition(tasks(blocks.sparkSession))


def states(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """file, start, end, inside, depth: how each block begins; first: the file's first byte that isn't blank, where it stands in the block."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("quotes", pa.int64()), ("flat", pa.int64()), ("quoted", pa.int64()), ("first", pa.string()), ("spot", pa.int64())])

    def run(batches):
        out = Batches(schema)
        for file, start, end in _rows(batches):
            with opened(file) as f:
                a, before = block_of(f, start, end)
            blank = BLANK[a]
            seen = int(np.argmin(blank)) if len(a) else 0
            first, spot = (chr(a[seen]), start + seen) if len(a) and not blank[seen] else (None, None)
            _, c, odd, quotes = structure(a, before)
            yield from out.add((file, start, end, quotes, int(STEP[c[~odd]].sum()), int(STEP[c[odd]].sum()), first, spot), 100)
        yield out.out()

    register(spark)
    d = spark.read.format("tamis_ranges").options(block=block, tasks=tasks(spark)).load(path).mapInArrow(run, "file string, start long, end long, quotes long, flat long, quoted long, first string, spot long")
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)  # a row for each block
    d = d.withColumn("inside", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int"))
    d = d.withColumn("step", F.when(F.col("inside") == 1, F.col("quoted")).otherwise(F.col("flat")))
    whole = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first = F.first(F.when(F.col("first").isNotNull(), F.struct("first", "spot")), ignorenulls=True).over(whole)
    return d.withColumns({"depth": F.coalesce(F.sum("step").over(before), F.lit(0)), "f": first}).select("file", "start", "end", "inside", "depth", F.col("f.first").alias("first"), F.col("f.spot").alias("spot"))


def outer(blocks: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Of files that hold an object: file, low, high, level, top: where the array under one of keys, or else the first, stands; the object with that array empty."""

    def marks(batches):
        out = Batches(pa.schema([("file", pa.string()), ("at", pa.int64()), ("mark", pa.int32())]))
        for file, start, end, inside, depth in _rows(batches):
            with opened(file) as f:
                a, run = block_of(f, start, end)
            places, c, step, _ = outside(a, inside, run)
            after = depth + np.cumsum(step)
            upper = ((after == 1) & (step == 0)) | ((step > 0) & (after <= 2)) | ((step < 0) & (after <= 1))
            for i, mark in zip(places[upper].tolist(), c[upper].tolist(), strict=True):
                yield from out.add((file, start + i, mark), 20)
        yield out.out()

    def chosen(batches):
        out = Batches(pa.schema([("file", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("level", pa.int64()), ("top", pa.string())]))
        for file, found in _rows(batches):
            found = [(x["at"], x["mark"]) for x in found]
            with opened(file) as f:

                def text(low, high, f=f):
                    f.seek(low)
                    return f.read(high - low).strip(BLANKS)

                entries, begin, colon, lists = [], found[0][0] + 1, None, []
                for n, (at, mark) in enumerate(found[1:], 1):
                    if mark == COLON and colon is None:
                        colon = at
                    elif mark == OPEN[0] and colon is not None and not text(colon + 1, at):
                        lists.append((len(entries), at, found[n + 1][0] if n + 1 < len(found) else f.size()))
                    elif (mark == COMMA or n == len(found) - 1) and colon is not None:
                        entries.append((text(begin, colon), colon + 1, at))
                        begin, colon = at + 1, None
                names = [json.loads(k) if k.startswith(b'"') else k.decode("utf-8", "replace") for k, _, _ in entries]
                by_name = {names[n]: (n, low, high) for n, low, high in lists if n < len(names)}
                took = next((by_name[k] for k in keys if k in by_name), next(iter(by_name.values()), None))
                if took:
                    fields = {k: (b"[]" if n == took[0] else text(low, high)).decode("utf-8", "replace") for n, (k, (_, low, high)) in enumerate(zip(names, entries, strict=True))}
                    top = "{" + ",".join(f"{json.dumps(k)}:{v}" for k, v in fields.items()) + "}"
                    yield from out.add((file, took[1], took[2], 2, top), len(top))
        yield out.out()

    d = dealt_out(blocks.where("first = '{'").select("file", "start", "end", "inside", "depth")).mapInArrow(marks, "file string, at long, mark int")
    return d.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "mark"))).alias("found")).mapInArrow(chosen, "file string, low long, high long, level long, top string")


def found_in(f: pa.NativeFile, start: int, end: int, inside: int, depth: int, low: int, high: int, level: int, whole: bool):
    """Elements that begin after a bracket or comma of this block: their number, or with whole their texts."""
    a, run = block_of(f, start, end)
    i, c, step, quotes = outside(a, inside, run)
    after = depth + np.cumsum(step)
    places = start + i
    comma = (c == COMMA) & (after == level) & (places > low) & (places < high)
    at = i[comma | (places == low)]
    if not whole:
        return len(at)
    ends = i[comma | ((step < 0) & (after == level - 1) & (places > low) & (places <= high))]
    data, out = a.tobytes(), []
    for n, k in zip(at.tolist(), np.searchsorted(ends, at + 1).tolist(), strict=True):
        if k < len(ends):
            out.append(data[n + 1 : int(ends[k])])
            continue
        pieces, now, open_, deep, size, piece = [data[n + 1 :]], end, inside ^ (quotes & 1), int(after[-1]), f.size(), AHEAD
        while now < size:  # the last one goes on in later blocks: pieces that grow, as its end is mostly near
            b, before = block_of(f, now, min(now + piece, size))
            i_b, c_b, step_b, quotes_b = outside(b, open_, before)
            after_b = deep + np.cumsum(step_b)
            stop = i_b[((c_b == COMMA) & (after_b == level)) | ((step_b < 0) & (after_b == level - 1))]
            if len(stop):
                pieces.append(b[: stop[0]].tobytes())
                break
            pieces.append(b.tobytes())
            now, open_, deep, piece = now + len(b), open_ ^ (quotes_b & 1), int(after_b[-1]) if len(after_b) else deep, min(2 * piece, BLOCK)
        out.append(b"".join(pieces))
    return out


def elements(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS, block: int = BLOCK) -> DataFrame:
    """file, at, value (the element's text), top (text of the outer object with the array empty; null where the file is the array).

    The array is the file itself, the one under the first of keys that holds one, or the first of the outer object's. Files of anything else give no
    rows; an element that is no JSON is a row with its text; an array without elements gives none.
    """
    blocks = written(states(spark, path, block), "json-blocks")  # read more than once below: narrow rows, one a block
    arrays = blocks.where("first = '[' and spot >= start and spot < end").select("file", F.col("spot").alias("low"), F.lit((1 << 63) - 1).alias("high"), F.lit(1).cast("long").alias("level"), F.lit(None).cast("string").alias("top"))
    held = written(arrays.unionByName(outer(blocks, keys)), "json-arrays")  # a row a file
    dealt = blocks.select("file", "start", "end", "inside", "depth").join(held, "file").where("end > low and start <= high")

    def counted(batches):
        out = Batches(pa.schema([("file", pa.string()), ("start", pa.int64()), ("n", pa.int64())]))
        for file, *own in _rows(batches):
            with opened(file) as f:
                yield from out.add((file, own[0], found_in(f, *own, whole=False)), 20)
        yield out.out()

    def read(batches):
        out = Batches(pa.schema([("file", pa.string()), ("at", pa.int64()), ("value", pa.string()), ("top", pa.string())]))
        for file, *own, first, top in _rows(batches):
            with opened(file) as f:
                for at, value in enumerate(found_in(f, *own, whole=True), first):
                    if at or value.strip(BLANKS):
                        yield from out.add((file, at, value.strip(BLANKS).decode("utf-8", "replace"), top), len(value))
        yield out.out()

    columns = ["file", "start", "end", "inside", "depth", "low", "high", "level"]
    counts = dealt_out(dealt.select(*columns)).mapInArrow(counted, "file string, start long, n long")
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("first", before).where("n > 0")
    full = dealt.join(counts, ["file", "start"]).select(*columns, "first", "top")
    return dealt_out(full).mapInArrow(read, "file string, at long, value string, top string")
