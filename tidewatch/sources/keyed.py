"""A table with a key, written by tasks and published by one commit per batch.

The table is cut into buckets by a hash of its key. A batch is shuffled by
bucket, so one task has all rows of a bucket; it reads the stored keys of that
bucket only (those that the batch has, by a filter on the files), drops what is
there already and writes one new file. Nothing of it counts until the commit:
the files that the successful attempts name are added to the next snapshot, a
small file that appears as a whole. A task or a batch that runs twice therefore
adds nothing twice, and what a failed batch wrote is deleted.

Rows are ``ignored`` if their key is there (a table of facts) or ``replace`` the
stored row (a table of states). A bucket of many files is rewritten as one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

from tidewatch.sources.files import listed, open_path, read_whole, write_new

FORMAT, BUCKET = "tidewatch_keyed", "_bucket"
BUCKETS = 32
#: Files of a bucket from which the next write makes one of them.
MOST_FILES = 8
#: Snapshots that stay, so that readers of an older one find its files.
KEPT = 3


@dataclass
class Snapshot:
    """The committed files per bucket, and those that later snapshots dropped."""

    number: int = -1
    files: dict[str, list[str]] = field(default_factory=dict)
    dropped: dict[str, list[str]] = field(default_factory=dict)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: new files per bucket, and the buckets they stand for alone."""

    files: dict[str, str]
    whole: list[str]


def _log(path: str) -> str:
    return f"{path}/log"


def newest_snapshot(path: str) -> Snapshot:
    system, root = open_path(path)
    names = [f.path for f in listed(system, _log(root))]
    return Snapshot(**json.loads(read_whole(system, names[-1]))) if names else Snapshot()


def _match(rows: pa.Table, stored: pa.Table, keys: list[str]) -> set[tuple]:
    """Keys of ``rows`` that ``stored`` has."""
    have = set(zip(*(stored.column(k).to_pylist() for k in keys)))
    return have & set(zip(*(rows.column(k).to_pylist() for k in keys)))


class _Writer:
    def __init__(self, options: dict[str, str]):
        self.path, self.keys = options["path"], options["keys"].split(",")
        self.replace = options.get("conflict", "ignore") == "replace"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        batches = [b for b in iterator if b.num_rows]
        out = Written({}, [])
        if batches:
            rows, current = pa.Table.from_batches(batches), newest_snapshot(self.path)
            for bucket in rows.column(BUCKET).unique().to_pylist():
                own = rows.filter(pa.compute.equal(rows.column(BUCKET), bucket)).drop_columns([BUCKET])
                self._bucket(str(bucket), own, current.files.get(str(bucket), []), out)
        return out

    def _bucket(self, bucket: str, rows: pa.Table, stored: list[str], out: Written) -> None:
        system, root = open_path(self.path)
        names = list(zip(*(rows.column(k).to_pylist() for k in self.keys)))
        # One row per key: the first, or the last if rows replace each other.
        place = dict(zip(names, range(len(names)))) if self.replace else dict(zip(names[::-1], range(len(names))[::-1]))
        data = ds.dataset([f"{root}/{f}" for f in stored], schema=rows.schema, filesystem=system) if stored else None
        known: set[tuple] = set()
        if data is not None:
            first = self.keys[0]
            same = ds.field(first).isin(rows.column(first).unique().drop_null())
            known = _match(rows, data.to_table(columns=self.keys, filter=same | ds.field(first).is_null()), self.keys)
        new = sorted(at for name, at in place.items() if self.replace or name not in known)
        if not new:
            return
        fresh = rows.take(new)
        rewrite = data is not None and (len(stored) >= MOST_FILES or (self.replace and bool(known)))
        if rewrite:
            old = data.to_table()
            if known:
                held = list(zip(*(old.column(k).to_pylist() for k in self.keys)))
                stay = [i for i, name in enumerate(held) if not self.replace or name not in known]
                old = old.take(pa.array(stay, pa.int64()))
            fresh = pa.concat_tables([old, fresh])
            out.whole.append(bucket)
        name = f"data/{bucket}/{uuid.uuid4().hex}.parquet"
        system.create_dir(f"{root}/data/{bucket}", recursive=True)
        with system.open_output_stream(f"{root}/{name}") as sink:
            pq.write_table(fresh, sink)
        out.files[bucket] = name

    def publish(self, messages: Sequence[Written | None]) -> None:
        done = [m for m in messages if m is not None and m.files]
        if not done:
            return
        system, root = open_path(self.path)
        last = newest_snapshot(self.path)
        files, gone = {b: list(f) for b, f in last.files.items()}, []
        for message in done:
            for bucket, name in message.files.items():
                if bucket in message.whole:
                    gone += files.get(bucket, [])
                    files[bucket] = []
                files.setdefault(bucket, []).append(name)
        number = last.number + 1
        dropped = {k: v for k, v in last.dropped.items() if int(k) > number - KEPT} | {str(number): gone}
        entry = json.dumps({"number": number, "files": files, "dropped": dropped}).encode()
        write_new(system, f"{_log(root)}/{number:012d}.json", entry)
        # Files that were dropped KEPT snapshots ago, and the snapshots that still named them.
        for k in set(last.dropped) - set(dropped):
            for name in last.dropped[k]:
                self._delete(system, f"{root}/{name}")
        self._delete(system, f"{_log(root)}/{number - KEPT:012d}.json")

    def undo(self, messages: Sequence[Written | None]) -> None:
        system, root = open_path(self.path)
        for message in messages:
            for name in message.files.values() if message is not None else ():
                self._delete(system, f"{root}/{name}")

    @staticmethod
    def _delete(system, path: str) -> None:
        try:
            system.delete_file(path)
        except FileNotFoundError:
            pass


class _BatchWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages) -> None:
        self.publish(messages)

    def abort(self, messages) -> None:
        self.undo(messages)


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.publish(messages)

    def abort(self, messages, batchId: int) -> None:
        self.undo(messages)


class KeyedTable(DataSource):
    """Options: path, keys (comma-separated), conflict (ignore or replace)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a keyed table is appended to")
        return _BatchWriter(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(dict(self.options))


def _prepared(df: DataFrame, path: str, keys: Sequence[str], conflict: str, buckets: int) -> tuple[DataFrame, dict[str, str]]:
    df.sparkSession.dataSource.register(KeyedTable)
    dealt = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).repartition(BUCKET)
    return dealt, {"path": path, "keys": ",".join(keys), "conflict": conflict}


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], conflict: str = "ignore", buckets: int = BUCKETS) -> None:
    """Add a batch to a keyed table. Null is a key value like any other.

    A key that occurs twice in the batch counts once. ``buckets`` is a property
    of the table: take as many as its batches need tasks, and keep the number.
    """
    rows, options = _prepared(df, path, keys, conflict, buckets)
    rows.write.format(FORMAT).options(**options).mode("append").save()


def keyed_writer(
    df: DataFrame, path: str, keys: Sequence[str], checkpoint: str, conflict: str = "ignore", buckets: int = BUCKETS
) -> DataStreamWriter:
    """The same as the sink of a stream."""
    rows, options = _prepared(df, path, keys, conflict, buckets)
    return rows.writeStream.format(FORMAT).options(**options, checkpointLocation=checkpoint).outputMode("append")


def read_keyed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table as of its last commit; no rows before the first."""
    files = [f"{path}/{name}" for names in newest_snapshot(path).files.values() for name in names]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
