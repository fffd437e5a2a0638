"""Data sources over byte ranges of files: lines, Arrow record batches, members of ZIP archives. No file is one value of a task.

Python data sources (``pyspark.sql.datasource``): ``register(spark)`` once, then ``spark.read.format("tamis_lines").load(path)``. Files are
reached by ``pyarrow.fs``: local paths, hdfs, s3 and gs. A path is a file, a folder (all files below it, names beginning with . or _ left out) or
a pattern of names in a folder.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import json
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 64 << 20  # bytes of a range of lines
CHUNK = 4 << 20  # bytes read at once
ROWS, SIZE = 10_000, 8 << 20  # rows and bytes of a batch


class BadRow(ValueError):
    """A row that can't be read, with its file and line."""


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else pafs.FileSystem.from_uri(f"file://{path}")


def files(path: str) -> list[tuple[str, int]]:
    """(file, bytes) below a path, by name."""
    fs, inner = filesystem(path)
    prefix = path[: -len(inner)] if path.endswith(inner) else ""
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.File:
        found, hidden = [info], False
    elif info.type == pafs.FileType.Directory:
        found, hidden = fs.get_file_info(pafs.FileSelector(inner, recursive=True)), True
    else:
        folder, _, name = inner.rpartition("/")
        found, hidden = [f for f in fs.get_file_info(pafs.FileSelector(folder or "/")) if fnmatch.fnmatchcase(f.base_name, name)], False
        if not found:
            raise FileNotFoundError(path)
    plain = lambda f: not hidden or not any(p[:1] in "._" for p in f.path[len(inner) :].strip("/").split("/"))
    return sorted((prefix + f.path, f.size) for f in found if f.type == pafs.FileType.File and plain(f))


def opened(file: str) -> pa.NativeFile:
    fs, inner = filesystem(file)
    return fs.open_input_file(inner)


@dataclass
class Range(InputPartition):
    file: str
    start: int
    end: int


class Batches:
    """Rows gathered to record batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.size += size
        if len(self.rows) >= ROWS or self.size >= SIZE:
            yield self.out()

    def out(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0
        return batch


def lines_of(f: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines whose first byte lies in the range; the last may go on beyond it. Without line ends."""
    at = start
    if start:
        at = start - 1
        f.seek(at)
        while at < end:  # the line that began before the range is another's
            chunk = f.read(min(CHUNK, end - at))
            if not chunk:
                return
            cut = chunk.find(b"\n")
            if cut >= 0:
                at += cut + 1
                break
            at += len(chunk)
    if at >= end:
        return
    f.seek(at)
    pending: list[bytes] = []
    while True:
        chunk = f.read(CHUNK)
        if not chunk:
            break
        *whole, rest = chunk.split(b"\n")
        for line in whole:
            line = b"".join([*pending, line])
            pending = []
            yield at, line.removesuffix(b"\r")
            at += len(line) + 1
            if at >= end:
                return
        pending.append(rest)
    rest = b"".join(pending)
    if rest:
        yield at, rest.removesuffix(b"\r")


def line_number(file: str, offset: int) -> int:
    """Number from 1 of the line that begins at the offset: read only where an error names it."""
    n, at = 1, 0
    with opened(file) as f:
        while at < offset:
            chunk = f.read(min(CHUNK, offset - at))
            if not chunk:
                break
            n += chunk.count(b"\n")
            at += len(chunk)
    return n


class RangeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.block = options["path"], int(options.get("block") or BLOCK)

    def partitions(self):
        return [Range(file, low, min(low + self.block, size)) for file, size in files(self.path) for low in range(0, size, self.block)] or [Range("", 0, 0)]


class LineReader(RangeReader):
    SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("nth", pa.int64()), ("offset", pa.int64()), ("value", pa.string())])

    def __init__(self, options: dict):
        super().__init__(options)
        self.json = options.get("json", "false") == "true"  # fail at a line that is no JSON
        self.errors = options.get("errors", "replace")

    def read(self, partition: Range):
        out = Batches(self.SCHEMA)
        if partition.end:
            with opened(partition.file) as f:
                for nth, (offset, line) in enumerate(lines_of(f, partition.start, partition.end)):
                    try:
                        value = line.decode("utf-8", self.errors)
                        if self.json and value.strip():
                            json.loads(value)
                    except ValueError as e:
                        raise BadRow(f"{partition.file}, line {line_number(partition.file, offset)}: {e}") from None
                    yield from out.add((partition.file, partition.start, nth, offset, value), len(line))
        yield out.out()


class Lines(DataSource):
    """Lines of files by byte ranges: file, block (where its range begins), nth (from 0 in the block), offset, value.

    Options: block (bytes of a range), errors (replace or strict, for bytes that are no UTF-8), json (true: a line that is no JSON is an error that names file and line).
    """

    @classmethod
    def name(cls):
        return "tamis_lines"

    def schema(self):
        return "file string, block long, nth long, offset long, value string"

    def reader(self, schema):
        return LineReader(self.options)


class Ranges(DataSource):
    """Byte ranges of files, one a row: file, start, end. A task takes neighbouring ones.

    Options: block (bytes of a range), tasks (how many tasks at least, if there are so many ranges; a task has about BLOCK bytes of files at most, or one range).
    """

    @classmethod
    def name(cls):
        return "tamis_ranges"

    def schema(self):
        return "file string, start long, end long"

    def reader(self, schema):
        return RowOfRange(self.options)


@dataclass
class Several(InputPartition):
    ranges: list[Range]


class RowOfRange(RangeReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.tasks = int(options.get("tasks") or 1)

    def partitions(self):
        ranges = super().partitions()
        n = min(len(ranges), max(self.tasks, -(-sum(r.end - r.start for r in ranges) // BLOCK)))
        return [Several(ranges[len(ranges) * k // n : len(ranges) * (k + 1) // n]) for k in range(n)]

    def read(self, partition: Several):
        for r in partition.ranges:
            if r.end:
                yield r.file, r.start, r.end


def json_rows(rows: list[dict]) -> list[str]:
    return [json.dumps(r, default=str, ensure_ascii=False) for r in rows]


ROW_SCHEMA = pa.schema([("file", pa.string()), ("at", pa.int64()), ("json", pa.string())])


@dataclass
class Messages(InputPartition):
    file: str
    head: list  # (offset, bytes) of schema and dictionaries before these
    batches: list  # (offset, bytes)
    at: int  # rows before


def body_length(metadata: bytes) -> tuple[int, int]:
    """(kind of message, bytes of its body) of an Arrow message's flatbuffer: its second and fourth fields."""
    table = struct.unpack_from("<i", metadata, 0)[0]
    fields = table - struct.unpack_from("<i", metadata, table)[0]
    size = struct.unpack_from("<H", metadata, fields)[0]
    spot = lambda k: struct.unpack_from("<H", metadata, fields + 4 + 2 * k)[0] if size > 4 + 2 * k else 0
    kind = metadata[table + spot(1)] if spot(1) else 0
    return kind, struct.unpack_from("<q", metadata, table + spot(3))[0] if spot(3) else 0


def messages(file: str) -> Iterator[tuple[int, int, int, int]]:
    """(offset, bytes, kind, rows) of the messages of an Arrow stream; bodies are skipped. Kinds: 1 schema, 2 dictionary, 3 record batch."""
    with opened(file) as f:
        size, at = f.size(), 0
        while at + 8 <= size:
            f.seek(at)
            mark, length = struct.unpack("<Ii", f.read(8))
            if mark != 0xFFFFFFFF or length == 0:
                break
            metadata = f.read(length)
            kind, body = body_length(metadata)
            rows = 0
            if kind == 3:  # the header's first field
                table = struct.unpack_from("<i", metadata, 0)[0]
                fields = table - struct.unpack_from("<i", metadata, table)[0]
                spot = table + struct.unpack_from("<H", metadata, fields + 4 + 2 * 2)[0]
                header = spot + struct.unpack_from("<i", metadata, spot)[0]
                inner = header - struct.unpack_from("<i", metadata, header)[0]
                own = struct.unpack_from("<H", metadata, inner + 4)[0] if struct.unpack_from("<H", metadata, inner)[0] > 4 else 0
                rows = struct.unpack_from("<q", metadata, header + own)[0] if own else 0
            yield at, 8 + length + body, kind, rows
            at += 8 + length + body


class ArrowReader(RangeReader):
    def partitions(self):
        out = []
        for file, _ in files(self.path):
            head, now, size, at, first = [], [], 0, 0, 0
            for offset, length, kind, rows in messages(file):
                if kind in (1, 2):
                    if now:
                        out.append(Messages(file, list(head), now, first))
                        now, size, first = [], 0, at
                    head.append((offset, length))
                elif kind == 3:
                    now.append((offset, length))
                    size, at = size + length, at + rows
                    if size >= self.block:
                        out.append(Messages(file, list(head), now, first))
                        now, size, first = [], 0, at
            if now:
                out.append(Messages(file, list(head), now, first))
        return out or [Messages("", [], [], 0)]

    def read(self, partition: Messages):
        at = partition.at
        if partition.batches:
            with opened(partition.file) as f:

                def piece(spot):
                    f.seek(spot[0])
                    return f.read(spot[1])

                head = b"".join(map(piece, partition.head))
                for spot in partition.batches:
                    for b in pa.ipc.open_stream(io.BytesIO(head + piece(spot))):
                        for low in range(0, b.num_rows, ROWS):
                            rows = json_rows(b.slice(low, ROWS).to_pylist())
                            yield pa.RecordBatch.from_arrays([pa.array([partition.file] * len(rows)), pa.array(range(at, at + len(rows)), pa.int64()), pa.array(rows, pa.string())], schema=ROW_SCHEMA)
                            at += len(rows)
        yield Batches(ROW_SCHEMA).out()


class ArrowStream(DataSource):
    """Rows of Arrow streams as JSON: file, at, json. A partition is a run of record batches of about block bytes; bodies are read by its task alone."""

    @classmethod
    def name(cls):
        return "tamis_arrow"

    def schema(self):
        return "file string, at long, json string"

    def reader(self, schema):
        return ArrowReader(self.options)


@dataclass
class Member(InputPartition):
    file: str
    name: str


class ZipReader(RangeReader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.begin, self.end = options.get("begin", ""), options.get("end", ".csv")

    def partitions(self):
        out = []
        for file, _ in files(self.path):
            with opened(file) as f, zipfile.ZipFile(f) as z:  # the central directory alone
                out += [Member(file, n) for n in sorted(z.namelist()) if n.startswith(self.begin) and n.endswith(self.end)]
        return out or [Member("", "")]

    def read(self, partition: Member):
        out = Batches(ROW_SCHEMA)
        if partition.file:
            name = f"{partition.file}!{partition.name}"
            with opened(partition.file) as f, zipfile.ZipFile(f) as z, z.open(partition.name) as m:
                rows = csv.DictReader(io.TextIOWrapper(m, encoding="utf-8-sig", newline=""))
                csv.field_size_limit(1 << 31)
                for at, r in enumerate(rows):
                    text = json.dumps(r, ensure_ascii=False)
                    yield from out.add((name, at, text), len(text))
        yield out.out()


class ZipMembers(DataSource):
    """Rows of CSV members of ZIP archives as JSON: file (archive!member), at, json; a task streams one member. Options: begin and end of the members' names."""

    @classmethod
    def name(cls):
        return "tamis_zip"

    def schema(self):
        return "file string, at long, json string"

    def reader(self, schema):
        return ZipReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (Lines, Ranges, ArrowStream, ZipMembers):
        spark.dataSource.register(source)
