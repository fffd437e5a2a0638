"""Helpers shared by the operators: scratch tables, word hashing, column access.

Words are maximal runs of anything but space, tab, LF, VT, FF and CR. In Python
that is exactly ``bytes.split()`` of the UTF-8 text, and ``bytes.lower()`` maps
A-Z only, so both run at C speed without touching other letters.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.scratch import passing as passing
from tamis.scratch import scratch_folder as scratch_folder
from tamis.scratch import written as written

WORD = r"[^\x20\x09-\x0D]+"

# Entries of a per-task word cache; a full cache is emptied, so memory stays bounded.
CACHE_ENTRIES = 200_000
# Rows and bytes of an Arrow batch. Texts can be long, so batches hold few of them.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20

MIX_1 = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
MIX_3 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small enough for a Python worker, by rows and by bytes. Stays set for the session."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    given = spark.conf.get(size).removesuffix("b")
    if not given.isdigit() or not 0 < int(given) <= BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))


_kept: dict = {}  # of this worker


def kept(name: str, make: Callable[[], object]):
    """What the tasks of a stage leave to the next ones in this worker: one thing, until a task comes that keeps another or none."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def released(batches: Iterable, keeps: bool = False) -> Iterator:
    """The batches of a task, before them what others have kept goes unless this one keeps() it; behind the last, memory held for later goes back, as workers stay alive between tasks."""
    import pyarrow as pa

    if not keeps:
        _kept.clear()
    yield from batches
    pa.default_memory_pool().release_unused()
    trimmed()


def trimmed() -> None:
    """Free memory of the C heap goes back to the system, where its library can do that."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def id_text(doc_id: str = "doc_id"):
    """doc_id as text; a null id counts as the empty string."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def fold(doc_id: str, folds: int):
    return F.crc32(id_text(doc_id)) % folds


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on demand and emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_2
    x = (x ^ (x >> np.uint64(27))) * MIX_3
    return x ^ (x >> np.uint64(31))


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n-grams of a sequence; of the whole sequence if it is shorter than n."""
    if len(hashes) == 0:
        return hashes
    n = min(n, len(hashes))
    out = np.full(len(hashes) - n + 1, np.uint64(n), dtype=np.uint64)
    for k in range(n):
        out = mixed(out * MIX_1 + hashes[k : len(hashes) - n + 1 + k])
    return out


def texts(column) -> Iterable[bytes]:
    """UTF-8 bytes of an Arrow string column; null counts as empty."""
    import pyarrow as pa

    return (x or b"" for x in column.cast(pa.large_binary()).to_pylist())


def membership(hashes: DataFrame, column: str, log2_bits: int) -> bytes:
    """A bit table of 2**log2_bits bits with the bits of all values of a long column set (top bits of the mixed value).

    Tasks set the bits of one stretch of the table each; what reaches the driver is the table, whose size is fixed.
    """
    import pyarrow as pa

    stretch = max(3, log2_bits - 6)  # 64 stretches
    at = F.shiftrightunsigned(F.col(column), 64 - log2_bits)

    def run(batches):
        tables: dict[int, np.ndarray] = {}
        for b in batches:
            bits = b.column(0).to_numpy()
            for part in np.unique(bits >> stretch):
                own = tables.setdefault(int(part), np.zeros(1 << stretch, dtype=bool))
                own[bits[bits >> stretch == part] & ((1 << stretch) - 1)] = True
        for part, own in tables.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], type=pa.int64()), pa.array([np.packbits(own).tobytes()], type=pa.binary())], names=["part", "bits"])

    dealt = hashes.select(at.alias("at")).where("at is not null").repartition(64, F.shiftright("at", stretch))
    out = bytearray(1 << (log2_bits - 3))
    size = 1 << (stretch - 3)
    for row in dealt.mapInArrow(run, "part long, bits binary").toLocalIterator():
        out[row["part"] * size : (row["part"] + 1) * size] = row["bits"]
    return bytes(out)


class Members:
    """Reads a bit table that membership() has made."""

    def __init__(self, table: bytes):
        self.bits = np.frombuffer(table, dtype=np.uint8)
        self.shift = np.uint64(64 - (len(table) * 8).bit_length() + 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> self.shift).astype(np.int64)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
