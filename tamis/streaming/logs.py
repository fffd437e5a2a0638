"""Session logs that grow: new lines of all files as a stream, and the state of each file carried from trigger to trigger.

The source's offset is the size of each file up to its last whole line, so a file that has grown is read from where the last trigger ended. The state of
a file is the session named last and, for each of its sessions, the number of messages that ended a run of blocks; an item leaves with
both, so that items of all triggers, put together, are those of a batch parse.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tamis.operators import session_logs
from tamis.sources.byte_ranges import BLOCK, CHUNK, LineReader, Range, files, opened

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def whole_lines(file: str, start: int, size: int) -> int:
    """The end of the last whole line between start and size, else start."""
    with opened(file) as f:
        end = size
        while end > start:
            low = max(start, end - CHUNK)
            f.seek(low)
            at = f.read(end - low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            end = low
    return start


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.block = options["path"], int(options.get("block") or BLOCK)
        self.lines = LineReader({"path": self.path})
        self.known: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        self.known = {file: whole_lines(file, self.known.get(file, 0), size) for file, size in files(self.path)}
        return {"files": json.dumps(self.known, sort_keys=True)}

    def partitions(self, start: dict, end: dict):
        old, new = json.loads(start["files"]), json.loads(end["files"])
        return [Range(file, low, min(low + self.block, size)) for file, size in new.items() for low in range(old.get(file, 0), size, self.block)] or [Range("", 0, 0)]

    def read(self, partition: Range):
        return self.lines.read(partition)

    def commit(self, end: dict) -> None:
        return None


class GrowingLines(DataSource):
    """Lines of files as they grow: file, block, nth, offset, value."""

    @classmethod
    def name(cls):
        return "tamis_growing"

    def schema(self):
        return "file string, block long, nth long, offset long, value string"

    def streamReader(self, schema):
        return GrowingReader(self.options)


class Spans(StatefulProcessor):
    """Items of one file: each gets the session named last before it and its island in that session."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.session = handle.getValueState("session", "name string")
        self.stops = handle.getMapState("stops", "session string", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        d = pd.concat(list(rows)).sort_values("at", kind="stable")  # a file's new lines
        name = self.session.get()[0] if self.session.exists() else "default"
        stops, out = {}, []
        for at, named, item, stop in zip(d["at"], d["named"], d["item"], d["stop"], strict=True):
            if named is not None:
                name = named
            if item is None:
                continue
            if name not in stops:
                stops[name] = self.stops.getValue((name,))[0] if self.stops.containsKey((name,)) else 0
            stops[name] += int(stop)
            out.append((key[0], name, int(at), stops[name], item))
        self.session.update((name,))
        for k, n in stops.items():
            self.stops.updateValue((k,), (n,))
        yield pd.DataFrame(out, columns=["file", "session", "at", "island", "item"])

    def close(self) -> None:
        return None


ITEM = "struct<block:struct<type:string,thinking:string,text:string,name:string,input:string>,other:struct<role:string,content:string>>"


def spans(lines: DataFrame) -> DataFrame:
    """lines (a stream): file, at, row. file, session, at, island, item (JSON): append them to a table, and read sessions with assembled()."""
    d = session_logs.codex_items(lines)
    packed = F.when(F.col("block").isNotNull() | F.col("other").isNotNull(), F.to_json(F.struct("block", "other")))
    d = d.select("file", "at", "named", packed.alias("item"), F.col("other").isNotNull().cast("long").alias("stop")).where("named is not null or item is not null")
    return d.groupBy("file").transformWithStateInPandas(Spans(), "file string, session string, at long, island long, item string", "Append", "none")


def assembled(kept: DataFrame) -> DataFrame:
    """Sessions of a table of spans: what a batch parse of the whole files gives."""
    item = F.from_json("item", ITEM)
    return session_logs.codex_sessions(kept.select("file", "session", "at", "island", item["block"].alias("block"), item["other"].alias("other")))


def follow(spark: SparkSession, path: str, table: str, checkpoint: str):
    """Appends the spans of what has grown below path since the last call to a table, then ends. Sets the session's state store to RocksDB, which state by key needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    spark.dataSource.register(GrowingLines)
    lines = spark.readStream.format("tamis_growing").load(path).select("file", F.col("offset").alias("at"), F.try_parse_json("value").alias("row"))
    return spans(lines).writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
