"""An event topic as a Spark data source: ``spark.read``, ``readStream``, ``write`` and ``writeStream`` with
``format("shelf_topic")`` after ``register(spark)``.

A topic is a folder with a log.  Each commit is one numbered entry of the log that names the segments it adds: a
segment holds consecutive messages of one partition.  Writing tasks put segments down under names of their own, and
nothing of them is visible before the driver has made the log entry, whole and at once; segments of failed or
repeated tasks are never named.  Entries are made by exclusive creation, so two writers never take one number, and a
batch of a stream that is committed again, under its number, is found in the log and left out.

Messages go to the partition that the FNV-1a hash of their key names, and keep their order within a writing task
and partition; offsets of a partition are gapless and grow in the order of the log.  A message without key goes to
the partition of the empty key.  The folder lies in any store that Arrow's file systems reach; exclusive creation is
guarded on a local or mounted file system and, elsewhere, one writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Row, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT, PARTITIONS = "shelf_topic", 8
#: Messages of a segment, at most; a task holds one segment of each partition.
SEGMENT = 50_000
# fixed values: 32-bit FNV-1a
FNV_BASIS, FNV_PRIME = 2166136261, 16777619


def partition_of(key: str | None, partitions: int) -> int:
    h = FNV_BASIS
    for b in (key or "").encode():
        h = ((h ^ b) * FNV_PRIME) & 0xFFFFFFFF
    return h % partitions


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TopicSource)


class Topic:
    """Files of one topic."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.files, self.root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.local = isinstance(self.files, fs.LocalFileSystem)

    def entries(self) -> list[dict]:
        """The log in order, up to the first number that is missing."""
        from pyarrow import fs

        found = self.files.get_file_info(fs.FileSelector(f"{self.root}/log", allow_not_found=True))
        names = sorted(f.base_name for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("."))
        out = []
        for k, name in enumerate(names):
            if name != f"{k:012d}.json":
                break
            out.append(json.loads(self.files.open_input_stream(f"{self.root}/log/{name}").readall()))
        return out

    def ends(self, entries: list[dict]) -> dict[int, int]:
        """The next offset of every partition that has messages."""
        out: dict[int, int] = {}
        for e in entries:
            for s in e["segments"]:
                out[s["partition"]] = s["first"] + s["count"]
        return out

    def commit(self, segments: list[dict], batch: str | None = None) -> None:
        """Make segments visible, with offsets after those before; a batch that is in the log is not added again."""
        from .files import link_once

        self.files.create_dir(f"{self.root}/log")
        while True:
            entries = self.entries()
            if batch is not None and any(e.get("batch") == batch for e in entries):
                return
            end, placed = self.ends(entries), []
            for s in sorted(segments, key=lambda s: (s["partition"], s["task"], s["number"])):
                first = end.get(s["partition"], 0)
                placed.append({k: s[k] for k in ("partition", "name", "count")} | {"first": first})
                end[s["partition"]] = first + s["count"]
            text = json.dumps({"batch": batch, "segments": placed}).encode()
            path = f"{self.root}/log/{len(entries):012d}.json"
            if self.local:
                if link_once(path, text):
                    return
                continue  # another writer took the number: look again
            with self.files.open_output_stream(path) as f:
                f.write(text)
            return

    def write_segment(self, rows: list[tuple]) -> str:
        name = uuid.uuid4().hex
        self.files.create_dir(f"{self.root}/segments")
        table = pa.table({"key": pa.array([k for k, _ in rows], pa.string()), "value": pa.array([v for _, v in rows], pa.string())})
        with self.files.open_output_stream(f"{self.root}/segments/{name}.parquet") as f:
            pq.write_table(table, f)
        return name

    def delete(self, names: list[str]) -> None:
        for name in names:
            self.files.delete_file(f"{self.root}/segments/{name}.parquet")

    def rows(self, segment: dict) -> Iterator[tuple]:
        with self.files.open_input_file(f"{self.root}/segments/{segment['name']}.parquet") as f:
            offset = segment["first"]
            for batch in pq.ParquetFile(f).iter_batches(8192):
                for key, value in zip(*(c.to_pylist() for c in batch.columns)):
                    yield key, value, segment["partition"], offset
                    offset += 1


@dataclass
class Segment(InputPartition):
    path: str
    segment: dict


@dataclass
class Written(WriterCommitMessage):
    segments: list[dict]


class TopicSource(DataSource):
    """Options: ``path``, and for writers ``partitions``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key string, value string, partition int, offset bigint"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TopicReader(self.options["path"])

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TopicStreamReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("messages are appended to a topic, never replaced")
        return TopicWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return TopicStreamWriter(self.options)


class TopicReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [Segment(self.path, s) for e in Topic(self.path).entries() for s in e["segments"]] or [Segment(self.path, {})]

    def read(self, partition: Segment) -> Iterator[tuple]:
        return Topic(partition.path).rows(partition.segment) if partition.segment else iter(())


class TopicStreamReader(DataSourceStreamReader):
    """Offsets of the stream are numbers of log entries."""

    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        return {"entry": len(Topic(self.path).entries())}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Segment(self.path, s) for e in Topic(self.path).entries()[start["entry"] : end["entry"]] for s in e["segments"]] or [Segment(self.path, {})]

    read = TopicReader.read


class _Writer:
    def __init__(self, options: dict):
        self.path, self.count, self.run = options["path"], int(options.get("partitions", PARTITIONS)), options.get("run", "")

    def write(self, rows: Iterator[Row]) -> Written:
        from pyspark import TaskContext

        topic, open_, out = Topic(self.path), {}, []
        task = TaskContext.get().partitionId()

        def close(p: int) -> None:
            some = open_.pop(p)
            out.append({"partition": p, "task": task, "number": len(out), "name": topic.write_segment(some), "count": len(some)})

        for row in rows:
            p = partition_of(row["key"], self.count)
            open_.setdefault(p, []).append((row["key"], row["value"]))
            if len(open_[p]) >= SEGMENT:
                close(p)
        for p in sorted(open_):
            close(p)
        return Written(out)

    def _segments(self, messages: list[Written | None]) -> list[dict]:
        return [s for m in messages if m is not None for s in m.segments]

    def _give_up(self, messages: list[Written | None]) -> None:
        """Segments of tasks that ended go; those of tasks that broke off stay unnamed."""
        Topic(self.path).delete([s["name"] for s in self._segments(messages)])


class TopicWriter(_Writer, DataSourceWriter):
    def commit(self, messages: list[Written | None]) -> None:
        Topic(self.path).commit(self._segments(messages))

    def abort(self, messages: list[Written | None]) -> None:
        self._give_up(messages)


class TopicStreamWriter(_Writer, DataSourceStreamWriter):
    """``run`` names the query, so that batches of different queries are told apart."""

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        Topic(self.path).commit(self._segments(messages), f"{self.run}/{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self._give_up(messages)
