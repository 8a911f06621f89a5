"""A log of messages in folders, read from its beginning to an end marker.

The log has partitions: the folders right below its path (or the path itself),
each a row of files that are never changed once they can be seen and whose names
(with the folders they are in) rise.
An offset is a position in bytes in every partition, so planning a micro-batch
lists files and reads none. One task reads one partition from where the last
micro-batch stopped; at the message whose id is the end marker it stops for good
and notes the position, and later micro-batches plan nothing beyond it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidewatch.sources.files import listed, open_path, read_whole, write_new

FORMAT = "tidewatch_log"
SCHEMA = "partition string, position bigint, value string"
BATCH = 4 << 20


def _partitions(path: str) -> dict[str, list[tuple[str, int]]]:
    """Files and sizes of each partition, in order."""
    system, root = open_path(path)
    found: dict[str, list[tuple[str, int]]] = {}
    for f in listed(system, root):
        first, nested, _ = f.path[len(root) :].strip("/").partition("/")
        found.setdefault(first if nested else "", []).append((f.path, f.size))
    return found


def _note(ends: str, partition: str) -> str:
    return f"{ends}/{partition or 'all'}.json"


def _ended(ends: str) -> dict[str, int]:
    """Where the end marker of each partition was found."""
    system, root = open_path(ends)
    notes = [json.loads(read_whole(system, f.path)) for f in listed(system, root)]
    return {n["partition"]: n["end"] for n in notes}


def all_ended(path: str, ends: str) -> bool:
    """True when every partition was read to its end marker."""
    there = _partitions(path)
    return bool(there) and set(there) <= set(_ended(ends))


@dataclass
class Stretch(InputPartition):
    partition: str
    start: int
    end: int
    files: list[tuple[str, int]]


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.ends = options["path"], options["ends"]
        self.field, self.marker = options.get("field", "id"), json.loads(options["marker"])

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        ended = _ended(self.ends)
        return {p: ended.get(p, sum(size for _, size in files)) for p, files in _partitions(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        files = _partitions(self.path)
        return [Stretch(p, start.get(p, 0), at, files[p]) for p, at in sorted(end.items()) if at > start.get(p, 0)]

    def _is_marker(self, line: bytes) -> bool:
        if str(self.marker).encode() not in line:
            return False
        try:
            message = json.loads(line)
        except ValueError:
            return False
        return isinstance(message, dict) and message.get(self.field) == self.marker

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        system, _ = open_path(self.path)
        at, waiting, size = 0, [], 0

        def batch() -> pa.RecordBatch:
            values = [v.decode("utf-8", "replace") for _, v in waiting]
            columns = [pa.array([partition.partition] * len(waiting)), pa.array([p for p, _ in waiting], pa.int64()), pa.array(values)]
            return pa.RecordBatch.from_arrays(columns, names=["partition", "position", "value"])

        for path, length in partition.files:
            begin, at = at, at + length
            if at <= partition.start or begin >= partition.end:
                continue
            with system.open_input_file(path) as raw:
                # Micro-batches end where files end, or at the marker: never inside a message.
                skip = max(partition.start - begin, 0)
                raw.seek(skip)
                position = begin + skip
                for line in _lines(raw):
                    if position >= partition.end:
                        break
                    message = line.rstrip(b"\r\n")
                    if message:
                        waiting.append((position, message))
                        size += len(message)
                    position += len(line)
                    if message and self._is_marker(message):
                        note = {"partition": partition.partition, "end": position}
                        ends, root = open_path(self.ends)
                        write_new(ends, _note(root, partition.partition), json.dumps(note).encode())
                        yield batch()
                        return
                    if size >= BATCH:
                        yield batch()
                        waiting, size = [], 0
        if waiting:
            yield batch()


def _lines(raw) -> Iterator[bytes]:
    """Lines with their ends, a block of the file in memory at a time."""
    rest = b""
    while block := raw.read(BATCH):
        lines = (rest + block).split(b"\n")
        rest = lines.pop()
        for line in lines:
            yield line + b"\n"
    if rest:
        yield rest


class MessageLog(DataSource):
    """Options: path, ends (a folder for the notes of this consumer), marker (JSON value), field."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> LogReader:
        return LogReader(dict(self.options))


def log_until(spark: SparkSession, path: str, ends: str, marker, field: str = "id") -> tuple[DataFrame, Callable[[], bool]]:
    """A stream of the messages up to and with the marker of each partition, and a test whether all were reached.

    ``ends`` belongs to one consumer, as its checkpoint does: a query that
    starts again goes on where it stopped, and a new consumer (a new checkpoint
    and a new folder) begins at the earliest message. Lines that are no JSON are
    messages too. A partition without marker is read as far as it goes.
    """
    spark.dataSource.register(MessageLog)
    options = {"path": path, "ends": ends, "marker": json.dumps(marker), "field": field}
    return spark.readStream.format(FORMAT).options(**options).load(), lambda: all_ended(path, ends)
