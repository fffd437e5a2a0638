"""Exports that are whole or not there: a data source whose tasks write ``.partial`` files, renamed when all have ended.

``export(df, path, order)`` writes a folder of parts in the order of the whole, so that the parts one after the other are the file:
a CSV's header (with a byte order mark, if asked for) is a part of its own before the others. A path that exists is refused unless ``overwrite``. If a task
fails, or its worker dies, nothing of the job stays; of tasks run twice the one that Spark commits counts.
"""

from __future__ import annotations

import csv
import io
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tamis.sources.byte_ranges import CHUNK, filesystem, opened

MARK = "﻿"
DONE = "_SUCCESS"


@dataclass
class Part(WriterCommitMessage):
    file: str
    number: int
    rows: int


def exists(path: str) -> bool:
    fs, inner = filesystem(path)
    return fs.get_file_info(inner).type != pafs.FileType.NotFound


def text_of(value) -> str:
    """A value as a field of a CSV: null is empty, nested values and booleans are JSON."""
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, default=str, ensure_ascii=False)


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = options["path"].rstrip("/"), columns, overwrite
        self.kind, self.mark = options.get("kind", "jsonl"), options.get("mark", "false") == "true"
        if self.kind not in ("csv", "jsonl"):
            raise ValueError(f"csv or jsonl, not {self.kind}")
        if not overwrite and exists(self.path):
            raise FileExistsError(f"{self.path} is there; give overwrite to replace it")
        self.partial = f"{self.path}.{uuid.uuid4().hex}.partial"
        fs, folder = filesystem(self.partial)
        fs.create_dir(folder, recursive=True)  # here alone: a task that is late finds it gone after an abort

    def lines(self, rows: list[dict]) -> str:
        if self.kind == "jsonl":
            return "".join(json.dumps(r, default=str, ensure_ascii=False) + "\n" for r in rows)
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows([text_of(r[c]) for c in self.columns] for r in rows)
        return out.getvalue()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        fs, folder = filesystem(self.partial)
        file, rows = f"{folder}/{uuid.uuid4().hex}.partial", 0
        with fs.open_output_stream(file) as f:
            for b in iterator:
                f.write(self.lines(b.to_pylist()).encode())
                rows += b.num_rows
        return Part(file, number, rows)

    def commit(self, messages: list[Part]) -> None:
        fs, folder = filesystem(self.partial)
        _, target = filesystem(self.path)
        kept = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.number)
        for m in kept:
            fs.move(m.file, f"{folder}/part-{m.number + 1:06d}.{self.kind}")
        if self.kind == "csv":
            head = io.StringIO()
            csv.writer(head, lineterminator="\n").writerow(self.columns)
            with fs.open_output_stream(f"{folder}/part-{0:06d}.csv") as f:
                f.write((MARK * self.mark + head.getvalue()).encode())
        for info in fs.get_file_info(pafs.FileSelector(folder)):
            if info.path.endswith(".partial"):  # of tasks run twice, or without rows
                fs.delete_file(info.path)
        with fs.open_output_stream(f"{folder}/{DONE}"):
            pass
        if exists(self.path):
            if not self.overwrite:
                raise FileExistsError(self.path)
            fs.delete_dir(target)
        fs.move(folder, target)

    def abort(self, messages: list[Part]) -> None:
        fs, folder = filesystem(self.partial)
        for _ in range(20):  # tasks may still write there
            try:
                fs.delete_dir(folder)
            except FileNotFoundError:
                return
            except OSError:
                time.sleep(0.1)


class Export(DataSource):
    @classmethod
    def name(cls):
        return "tamis_export"

    def schema(self):
        return "value string"

    def writer(self, schema, overwrite: bool):
        return Writer(self.options, schema.fieldNames(), overwrite)


def default_path(name: str, date: str, kind: str = "jsonl") -> str:
    return f"./{name}.{date}.{kind}"


def export(df: DataFrame, path: str, order: list | None = None, columns: list[str] | None = None, mark: bool = False, overwrite: bool = False) -> None:
    """df as .csv (if the path ends so) or JSON lines, in the order of the whole; a folder of parts to be read one after the other."""
    df = df.select(*columns) if columns else df
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.sparkSession.dataSource.register(Export)
    kind = "csv" if path.rstrip("/").endswith(".csv") else "jsonl"
    df.write.format("tamis_export").mode("overwrite" if overwrite else "append").options(kind=kind, mark=mark).save(path)


def one_file(spark: SparkSession, folder: str, file: str, overwrite: bool = False) -> None:
    """The parts of an export as one file, streamed by one task and renamed at its end."""
    if not overwrite and exists(file):
        raise FileExistsError(f"{file} is there; give overwrite to replace it")

    def run(batches):
        for b in batches:
            for source, target in zip(*(c.to_pylist() for c in b.columns), strict=True):
                fs, inner = filesystem(source)
                parts = sorted(i.path for i in fs.get_file_info(pafs.FileSelector(inner)) if i.base_name.startswith("part-"))
                to, out = filesystem(target)
                with to.open_output_stream(f"{out}.partial") as f:
                    for p in parts:
                        with fs.open_input_file(p) as g:
                            while chunk := g.read(CHUNK):
                                f.write(chunk)
                to.move(f"{out}.partial", out)
                yield pa.RecordBatch.from_arrays([pa.array([target])], names=["file"])

    spark.createDataFrame([(folder, file)], "folder string, file string").mapInArrow(run, "file string").collect()


def first_bytes(file: str, n: int = 3) -> bytes:
    with opened(file) as f:
        return f.read(n)


# --- counts of what a sink writes ---------------------------------------------------------------


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """df and the counts that are taken while an action runs over it; put it last before a write, where each row passes once."""
    o = Observation(name)
    return df.observe(o, *[c.alias(k) for k, c in metrics.items()]), o


def write_counted(df: DataFrame, path: str, reason: str, codes: list[str], text: list[str]) -> dict[str, int]:
    """Writes rows as JSON lines by outcome: written, or the reject's code. Returns the counts of the same pass.

    reason: the column of the code, null for good rows; codes: those that can come, any other is counted as other. rows, written, chars (of the
    columns of text, good rows alone), and rejects by code.
    """
    good = F.col(reason).isNull()
    chars = F.lit(0)
    for c in text:
        chars = chars + F.length(F.coalesce(c, F.lit("")))
    metrics = {"rows": F.count(F.lit(1)), "written": F.count_if(good), "chars": F.coalesce(F.sum(F.when(good, chars)), F.lit(0))}
    metrics |= {f"reject_{i}": F.count_if(F.col(reason) == code) for i, code in enumerate(codes)} | {"other": F.count_if(~good & ~F.col(reason).isin(*codes))}
    out, seen = observed(df, f"written-{uuid.uuid4().hex}", **metrics)
    out.withColumn("outcome", F.coalesce(reason, F.lit("written"))).write.mode("overwrite").partitionBy("outcome").json(path)
    found = seen.get
    return {k: found[k] for k in ("rows", "written", "chars", "other")} | {code: found[f"reject_{i}"] for i, code in enumerate(codes)}


def line_counts(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """lines: value. The lines that are JSON objects as row (VARIANT), and counts of the pass: bytes, blank lines, bad lines, records."""
    d = lines.withColumn("row", F.try_parse_json("value"))
    blank = F.trim("value") == ""
    is_object = F.coalesce(F.startswith(F.schema_of_variant("row"), F.lit("OBJECT")), F.lit(False))
    d, seen = observed(d, f"lines-{uuid.uuid4().hex}", bytes=F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)), blank=F.count_if(blank), bad=F.count_if(~blank & ~is_object), records=F.count_if(is_object))
    return d.where(is_object), seen
