"""Start queries and replay a table as a stream."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from contextlib import AbstractContextManager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.session import ROCKSDB, STATE_STORE, pin, scratch_path, settings
from tidewatch.sources.streams import event_source


def to_files(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-mode parquet sink (exactly once through its commit log)."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint)


def to_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> DataStreamWriter:
    return df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)


def drain(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain_until(
    writer: DataStreamWriter, seen: Callable[[], bool], interval: str = "1 second", timeout: float | None = None
) -> None:
    """Keep a query running until ``seen()``: the end marker has reached the sink.

    Raises what made the query fail, and TimeoutError beyond ``timeout`` seconds
    (no limit by default): it never returns with a part of the rows.
    """
    query = writer.trigger(processingTime=interval).start()
    began = time.monotonic()
    try:
        while not seen():
            if not query.isActive:
                raise query.exception() or RuntimeError("the query ended before its end marker was seen")
            if timeout is not None and time.monotonic() - began > timeout:
                raise TimeoutError(f"the end marker was not seen within {timeout} s")
            query.awaitTermination(1)
    finally:
        query.stop()


def state_settings(spark: SparkSession, wanted: int) -> AbstractContextManager[None]:
    """Settings for queries that start meanwhile: at most ``wanted`` state partitions, state in RocksDB.

    Each partition is a store to commit per batch, whatever it holds. The
    checkpoint keeps both settings that a query was started with. Keyed state
    (``stream_scores``) needs RocksDB.
    """
    partitions = "spark.sql.shuffle.partitions"
    fewer = max(1, min(int(spark.conf.get(partitions)), wanted))
    return settings(spark, {partitions: str(fewer), STATE_STORE: ROCKSDB})


def replay(
    table: DataFrame,
    time: str,
    make_writer: Callable[[DataFrame], DataStreamWriter],
    slices: int = 3,
    quiet: timedelta = timedelta(days=30),
    closing: dict | None = None,
    rows_per_partition: int = 250_000,
) -> None:
    """Run a query over a table as if it arrived in ``slices`` steps of time.

    Each slice is written to a folder that the file source watches, then the
    query resumes from its checkpoint and takes the new files as one batch, so
    a slice may have any number of files. A last row, ``quiet`` after the end,
    moves the watermark past all real windows; it holds the ``closing`` values
    (keys that are filtered on must not be null) and null elsewhere.
    """
    spark, schema = table.sparkSession, table.schema
    folder = scratch_path(spark, "replay")
    table = pin(table)
    first, last, rows_in_all = table.agg(F.min(time), F.max(time), F.count(F.lit(1))).first()
    width = (last - first) / slices

    def deliver(rows: DataFrame) -> None:
        rows.write.mode("append").parquet(folder)
        with state_settings(spark, math.ceil(rows_in_all / rows_per_partition)):
            drain(make_writer(event_source(spark, "parquet", schema=schema, path=folder)))

    for i in range(slices):
        low, high = first + i * width, first + (i + 1) * width
        part = F.col(time) >= F.lit(low)
        if i < slices - 1:
            part = part & (F.col(time) < F.lit(high))
        deliver(table.filter(part))
    end = {**(closing or {}), time: last + quiet}
    deliver(spark.range(1).select(*[F.lit(end.get(c)).cast(t).alias(c) for c, t in table.dtypes]))
