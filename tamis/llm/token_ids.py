"""Token ids in shard files with a minimal perfect hash index.

Documents are range-partitioned by id; each task encodes its documents in order and
packs them into shards of about ``SHARD_IDS`` ids. A shard is one binary value:

    magic "TMS1", n, buckets, payload ids, seed    5 x uint32
    displacement of each bucket                    2 x uint32 each
    fingerprint, offset, length of each slot       3 x uint32 each
    document keys in order                         n x (uint64, uint32)
    ids                                            uint32 each

The hash (hash and displace) sends each document key to a slot of its own among n; the
slot's fingerprint tells keys of other documents, the offset and length give the ids. So
one key costs two hashes, one displacement and one slot, whatever the shard's size. A key is the id and, for
an id that comes more than once in a shard, its ordinal there. Shards are rows of a Parquet table in the shared folder, as every file
system that Spark writes to can hold them; the table's columns first_key and last_key tell the shard of a key (``get``), so that
only the row groups that can hold it are read.

Null text: no ids but the end id. Null ids come first, as key ``NULL_KEY``. Repeated rows
each keep their ids; among equal doc_ids the order is that of the text's hash, then of its length. An empty table gives no shard. A
document longer than a shard has a shard to itself. Columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import functools
import operator
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamis.llm.common import kept, mixed, released, scratch_folder, small_batches, table

END_ID = 1
SHARD_IDS = 500_000
SHARD_DOCS = 20_000
ROW_GROUP_BYTES = 8 << 20
MAGIC = int.from_bytes(b"TMS1", "little")
NULL_KEY = -(1 << 63)
CACHE_WORDS = 110_000  # a generation of a cache; two are held
GROUP_BYTES = 2 << 20  # texts that are split together; a longer one is split by itself

# Texts whose characters lower-case and split alike everywhere: ASCII white space, marks, digits and letters, and the letters of Latin-1.
SIMPLE = re.compile("[ -~\t-\r\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
# Fixed by the tokenizer: how it splits such texts once they are lower case.
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^ \t-\ra-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

# The same of UTF-8 bytes, where each of these letters from U+00C0 on is the byte C3 and a second one.
LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))
SPACE, LETTER, DIGIT, MARK = range(4)
KINDS = bytes(SPACE if b == 32 or 9 <= b <= 13 else LETTER if bytes([b]).isalpha() or b >= 128 else DIGIT if 48 <= b <= 57 else MARK for b in range(256))
ODD = bytes(not (32 <= b <= 126 or 9 <= b <= 13 or b == 0xC3 or 0x80 <= b <= 0xBF and b not in (0x97, 0xB7)) for b in range(256))
SECOND = bytes(0x80 <= b <= 0xBF for b in range(256))
ENDS = np.frombuffer(b"stmd", dtype=np.uint8)
ENDS_OF_TWO = [tuple(x) for x in (b"re", b"ve", b"ll")]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Generations(dict):
    """A bounded cache: when it is full the older half goes, and entries still in use come back from it."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= CACHE_WORDS:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes texts piece by piece, each distinct piece once.

    Simple texts are split into the tokenizer's pieces here, and each piece goes to its BPE model. In any
    other text each word goes through the whole tokenizer, which never joins over white space and drops it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        # Split and fold by hand only for the tokenizer these rules are those of.
        probe = "Don't STOP, the '90s: \u00c9t\u00e9 a1b22 we'll--x"
        self.simple = True
        self.words, self.pieces = Generations(self._word), Generations(self._piece)
        self.simple = self.encode(probe.encode()) == self._packed(self.tokenizer.encode(probe, add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: bytes) -> bytes:
        letters = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.letters)
        return self._packed([t.id for t in self.model.tokenize(letters)])

    def _word(self, word: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def encode(self, text: bytes) -> bytes:
        s = text.decode()
        if self.simple and "<|" not in s and SIMPLE.fullmatch(s):
            return b"".join(map(self.pieces.__getitem__, map(str.encode, PIECES.findall(s.lower()))))
        return b"".join(map(self.words.__getitem__, text.split()))

    def encode_all(self, texts: list[bytes]) -> Iterator[bytes]:
        """encode() of each text; short simple ones are split together."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > GROUP_BYTES:
                yield from self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text) + 1
        yield from self._group(group)

    def _group(self, texts: list[bytes]) -> Iterator[bytes]:
        raw = b"\n".join((*texts, b"", b"", b""))  # white space between them, and behind the last for the looks ahead below
        if not self.simple or len(raw) > 2 * GROUP_BYTES:
            yield from map(self.encode, texts)
            return
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        by_byte = lambda table: np.frombuffer(raw.translate(table), dtype=np.uint8)
        # Texts that aren't simple: by bytes, by a first byte C3 without its second or the reverse, by what may be a special token.
        second = by_byte(SECOND)
        odd = by_byte(ODD) != 0
        odd[1:] |= (np.frombuffer(raw, dtype=np.uint8)[:-1] == 0xC3) != (second[1:] != 0)
        odd[0] |= second[0] != 0
        apart = set((np.searchsorted(begins, np.flatnonzero(odd), side="right") - 1).tolist())
        if b"<|" in raw:
            apart.update(k for k, t in enumerate(texts) if b"<|" in t)

        low, kind = by_byte(LOWER), by_byte(KINDS)
        first = kind != SPACE
        for k in apart:
            first[begins[k] : begins[k + 1]] = False
        inside = first.copy()
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        # An apostrophe that begins a piece takes these letters along; the letters behind them begin another.
        quotes = np.flatnonzero(first & (low == ord("'")))
        one, two = low[quotes + 1], low[quotes + 2]
        length = np.isin(one, ENDS) + 2 * np.any([(one == a) & (two == b) for a, b in ENDS_OF_TWO], axis=0)
        quotes, length = quotes[length > 0], length[length > 0]
        first[quotes + 1] = False
        first[quotes + 1 + length] |= kind[quotes + 1 + length] == LETTER

        at = np.flatnonzero(first[inside]).astype(np.int32)
        data = low[inside]
        pieces = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(np.append(at, np.int32(len(data)))), pa.py_buffer(data)]).dictionary_encode()
        ids = pa.array(list(map(self.pieces.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False))), type=pa.binary()).take(pieces.indices)
        ends = np.frombuffer(ids.buffers()[1], dtype=np.int32)[: len(at) + 1] if len(at) else np.zeros(1, dtype=np.int32)
        of_text = ends[np.searchsorted(np.flatnonzero(first), begins)].tolist()
        packed = memoryview(ids.buffers()[2] or b"")
        for k, text in enumerate(texts):
            yield self.encode(text) if k in apart else packed[of_text[k] : of_text[k + 1]].tobytes()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def key_hash(keys: np.ndarray, ordinals: np.ndarray, seed: int) -> np.ndarray:
    return mixed(mixed(keys.astype(np.uint64) + np.uint64(seed)) + ordinals.astype(np.uint64))


def placed(keys: np.ndarray, ordinals: np.ndarray, n: int, buckets: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each key, and the two numbers that its slots are counted from."""
    b = key_hash(keys, ordinals, 4 * seed) % np.uint64(buckets)
    h1 = key_hash(keys, ordinals, 4 * seed + 1) % np.uint64(n)
    h2 = key_hash(keys, ordinals, 4 * seed + 2) % np.uint64(max(1, n - 1))
    return b.astype(np.int64), h1.astype(np.int64), h2.astype(np.int64) + 1


def perfect_hash(keys: np.ndarray, ordinals: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(seed, displacements (buckets, 2), slot of each key): hash and displace, large buckets first."""
    for seed in range(1, 1_000):
        if (found := _displaced(keys, ordinals, seed)) is not None:
            return seed, *found
    raise ValueError("keys are not distinct")


def _displaced(keys: np.ndarray, ordinals: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray] | None:
    n = len(keys)
    buckets = max(1, n // 4)
    b, h1, h2 = placed(keys, ordinals, n, buckets, seed)
    order = np.argsort(b, kind="stable")
    starts = np.searchsorted(b[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    free = np.ones(n, dtype=bool)
    moved, slots = np.zeros((buckets, 2), dtype=np.uint32), np.zeros(n, dtype=np.int64)
    for bucket in np.argsort(-sizes, kind="stable"):
        mine = order[starts[bucket] : starts[bucket + 1]]
        if not len(mine):
            break
        for d0 in range(64):
            at = (h1[mine] + d0 * h2[mine]) % n
            if len(mine) > 1 and len(set(at.tolist())) < len(mine):
                continue
            # The first shift that puts the whole bucket on free slots.
            shifts = (np.flatnonzero(free) - at[0]) % n
            for k in at[1:].tolist():
                shifts = shifts[free[(shifts + k) % n]]
            if len(shifts):
                moved[bucket] = d0, shifts[0]
                slots[mine] = (at + shifts[0]) % n
                free[slots[mine]] = False
                break
        else:
            return None  # two keys of a bucket agree in both numbers, or no room: another seed
    return moved, slots


def pack(keys: list[int], ordinals: list[int], payloads: list[bytes]) -> bytes:
    k, o = np.array(keys, dtype=np.int64), np.array(ordinals, dtype=np.uint32)
    seed, moved, slots = perfect_hash(k, o)
    n = len(k)
    lengths = np.array([len(p) // 4 for p in payloads], dtype=np.uint32)
    offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.uint64)[:-1])).astype(np.uint32)
    index = np.zeros((n, 3), dtype="<u4")
    index[slots, 0] = key_hash(k, o, 0) >> np.uint64(32)
    index[slots, 1], index[slots, 2] = offsets, lengths
    head = np.array([MAGIC, n, len(moved), int(lengths.sum()), seed], dtype="<u4")
    return b"".join((head.tobytes(), moved.astype("<u4").tobytes(), index.tobytes(), k.astype("<i8").tobytes(), o.astype("<u4").tobytes(), *payloads))


class Shard:
    """Keyed access to one shard's bytes."""

    def __init__(self, data: bytes):
        magic, self.n, buckets, self.n_ids, self.seed = np.frombuffer(data, "<u4", 5).tolist()
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = 20
        self.moved = np.frombuffer(data, "<u4", 2 * buckets, at).reshape(-1, 2)
        at += 8 * buckets
        self.index = np.frombuffer(data, "<u4", 3 * self.n, at).reshape(-1, 3)
        at += 12 * self.n
        self.keys = np.frombuffer(data, "<i8", self.n, at)
        at += 8 * self.n
        self.ordinals = np.frombuffer(data, "<u4", self.n, at)
        self.payload = at + 4 * self.n
        self.data = data

    def find(self, keys: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 where the fingerprint differs."""
        n = self.n
        b, h1, h2 = placed(keys, ordinals, n, len(self.moved), self.seed)
        moved = self.moved[b].astype(np.int64)
        slots = (h1 + moved[:, 0] * h2 + moved[:, 1]) % n
        same = self.index[slots, 0] == (key_hash(keys, ordinals, 0) >> np.uint64(32)).astype(np.uint32)
        return np.where(same, slots, -1)

    def ids(self, slot: int) -> bytes:
        _, offset, length = self.index[slot].tolist()
        return self.data[self.payload + 4 * offset : self.payload + 4 * (offset + length)]

    def get(self, key: int, ordinal: int = 0) -> np.ndarray | None:
        slot = int(self.find(np.array([key], dtype=np.int64), np.array([ordinal], dtype=np.uint32))[0])
        return None if slot < 0 else np.frombuffer(self.ids(slot), "<u4")


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """docs: doc_id, text. Writes rows (part, shard, first_key, last_key, n_docs, n_ids, data) to a Parquet table at path."""
    small_batches(docs.sparkSession)
    tokenizer = tokenizer or default_tokenizer()
    tie = F.struct(F.xxhash64("text"), F.length("text"))
    dealt = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)

    def run(batches):
        from pyspark import TaskContext

        encoder = kept(f"token-ids {tokenizer}", lambda: Encoder(tokenizer))
        part, shard, last, ordinal = TaskContext.get().partitionId(), 0, None, 0
        keys, ordinals, payloads, size = [], [], [], 0
        end = np.array([END_ID], dtype="<u4").tobytes()

        def out():
            data = pack(keys, ordinals, payloads)
            return pa.RecordBatch.from_arrays([pa.array([x], type=t) for x, t in ((part, pa.int64()), (shard, pa.int64()), (keys[0], pa.int64()), (keys[-1], pa.int64()), (len(keys), pa.int64()), (size, pa.int64()), (data, pa.binary()))], names=["part", "shard", "first_key", "last_key", "n_docs", "n_ids", "data"])

        for b in released(batches, keeps=True):
            texts = [text or b"" for text in b.column(1).cast(pa.large_binary()).to_pylist()]
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode_all(texts), strict=True):
                key = NULL_KEY if doc_id is None else doc_id
                ordinal = ordinal + 1 if key == last else 0
                last = key
                ids += end
                if payloads and (size + len(ids) // 4 > shard_ids or len(keys) == SHARD_DOCS):
                    yield out()
                    keys, ordinals, payloads, size, shard, ordinal = [], [], [], 0, shard + 1, 0
                keys.append(key)
                ordinals.append(ordinal)
                payloads.append(ids)
                size += len(ids) // 4
        if payloads:
            yield out()

    shards = dealt.mapInArrow(run, "part long, shard long, first_key long, last_key long, n_docs long, n_ids long, data binary")
    # Values are large: a page each and few in a row group, else a writer and a reader hold all shards of a file at once.
    shards.write.option("parquet.page.size.row.check.min", "1").option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the shards at path, each fetched by its key: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.parquet(path)
    sizes = shards.select("part", "shard", "n_ids")
    # Parts come in key order. Sums of parts are a narrow table; within a part shards follow one another.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before_part"))
    within = sizes.select("part", "shard", (F.sum("n_ids").over(W.partitionBy("part").orderBy("shard")) - F.col("n_ids")).alias("before"))
    starts = within.join(parts, "part").select("part", "shard", (F.col("before_part") + F.col("before")).alias("base"))

    def run(batches):
        for b in released(batches):
            for part, number, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                s = Shard(data.as_py())
                slots = s.find(s.keys, s.ordinals)
                if (slots < 0).any():
                    raise ValueError("a key is not found in its own shard")
                crc = [zlib.crc32(s.ids(k)) for k in slots.tolist()]
                n = s.n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part)), pa.array(np.full(n, number)), pa.array(s.keys, mask=s.keys == NULL_KEY), pa.array(s.index[slots, 1].astype(np.int64)), pa.array(s.index[slots, 2].astype(np.int64)), pa.array(crc, type=pa.int64())],
                    names=["part", "shard", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    docs = shards.select("part", "shard", "data").mapInArrow(run, "part long, shard long, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return docs.join(starts, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def get(spark: SparkSession, path: str, keys: list[int | None]) -> DataFrame:
    """The rows of some documents, by key: doc_id, ids. An id that the shards don't hold gives no row; one that comes more than once gives as many.

    Meant for a handful of keys: they stand in the filter that prunes the shards.
    """
    wanted = sorted({NULL_KEY if k is None else int(k) for k in keys})
    low, high = F.col("first_key"), F.col("last_key")
    near = [(low <= k) & (high >= k) for k in wanted]
    shards = spark.read.parquet(path).where(functools.reduce(operator.or_, near, F.lit(False))).select("first_key", "last_key", "data")

    def run(batches):
        for b in batches:
            found: list[tuple[int | None, list[int]]] = []
            for first, last, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                s = Shard(data.as_py())
                for key in wanted:
                    ordinal = 0
                    while first <= key <= last and (ids := s.get(key, ordinal)) is not None:
                        found.append((None if key == NULL_KEY else key, ids.tolist()))
                        ordinal += 1
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], type=pa.int64()), pa.array([i for _, i in found], type=pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return shards.mapInArrow(run, "doc_id long, ids array<long>")


def encoded(docs: DataFrame) -> DataFrame:
    """Writes docs as shards in the shared folder and reads them back."""
    spark = docs.sparkSession
    path = f"{scratch_folder(spark)}/token-shards-{uuid.uuid4().hex}"
    write(docs, path)
    return read(spark, path)


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, from the files: doc_id, start, n_tokens, ids_crc32."""
    return encoded(table(spark, sf_dir, "documents"))
