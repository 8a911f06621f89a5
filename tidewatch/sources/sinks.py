"""Sinks that stay right when a micro-batch is written twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewatch.sources.keyed import write_keyed
from tidewatch.sources.readers import path_exists

EPOCH = "epoch"


RUN_SHIFT = 40


def numbered_epoch(batch: DataFrame, epoch: int, path: str) -> int:
    """A number of the batch that grows over all runs that write to ``path``.

    A stream that goes on from its checkpoint keeps its query id, so a repeated
    batch keeps its number. A new checkpoint counts its batches from 0 again;
    it is a new run, and comes after those before it. The runs are listed in a
    folder that readers of the path skip: one row per checkpoint.
    """
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
    listed, schema = f"{path}/_runs", "run long, query string"
    known = {}
    if path_exists(spark, listed):
        known = {r["query"]: r["run"] for r in spark.read.schema(schema).json(listed).collect()}
    if query not in known:
        known[query] = max(known.values(), default=-1) + 1
        spark.createDataFrame([(known[query], query)], schema).coalesce(1).write.mode("append").json(listed)
    return (known[query] << RUN_SHIFT) + epoch


def epoch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to its own folder; a retry replaces that folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        number = numbered_epoch(batch, epoch, path)
        batch.write.mode("overwrite").parquet(f"{path}/{EPOCH}={number}")

    return write


def read_epochs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Everything written so far (the schema names ``epoch`` too); empty before the first batch."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def latest_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keyed table behind an epoch folder: the newest epoch wins."""
    values = [c for c in rows.columns if c not in (*keys, EPOCH)]
    newest = F.max_by(F.struct(*values), EPOCH).alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def append_new_keys(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key the target does not hold yet."""
    return batch.join(existing.select(*keys), list(keys), "left_anti")


def within_batch(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The rows of ``existing`` whose ``key`` lies between the least and largest of the batch."""
    low, high = batch.agg(F.min(key), F.max(key)).first()
    return existing.filter(F.col(key).between(F.lit(low), F.lit(high))) if low is not None else existing.limit(0)


def jdbc_writer(url: str, table: str, keys: Sequence[str], **options: str) -> Callable[[DataFrame, int], None]:
    """Append a micro-batch to a database table with a primary key.

    Keys that are already there are skipped, so a repeated batch cannot violate
    the key (the driver jar must be on the class path). Of the table only the
    range that the first key has in the batch is read: the bounds go to the
    database as a condition.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        settings = {"url": url, "dbtable": table, **options}
        there = batch.sparkSession.read.format("jdbc").options(**settings).load()
        fresh = append_new_keys(batch, within_batch(there, batch, keys[0]), keys)
        fresh.write.format("jdbc").options(**settings).mode("append").save()

    return write


def append_rows(df: DataFrame, path: str, keys: Sequence[str] | None = None) -> None:
    """Append facts (offences, domains) to a table.

    With ``keys`` it is a keyed table (``keyed.read_keyed``), and an append that
    is repeated adds nothing; without, rows are added as often as they are sent.
    """
    if keys:
        write_keyed(df, path, keys)
    else:
        df.write.mode("append").parquet(path)


def console_writer(df: DataFrame, checkpoint: str) -> DataStreamWriter:
    """A console copy of a stream, next to its real sink."""
    return df.writeStream.format("console").outputMode("append").option("checkpointLocation", checkpoint)


def kafka_writer(df: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Publish a ``value`` column (needs the connector jar)."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return df.writeStream.format("kafka").outputMode("append").options(**options)
