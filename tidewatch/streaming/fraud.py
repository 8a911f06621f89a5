"""Fraud features and alerts on a stream of transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.operators.fraud import user_window_features
from tidewatch.sources.sinks import numbered_epoch
from tidewatch.sources.versioned import read_version, replace_version


def stream_user_features(
    txns: DataFrame,
    window_s: int = V.FRAUD_WINDOW_SECONDS,
    slide_s: int = V.FRAUD_SLIDE_SECONDS,
    delay: str = "10 minutes",
) -> DataFrame:
    """Window features in append mode: a window is sent once, when it is closed.

    The watermark is set on the event time only; a second one on the window
    column would keep the results back.
    """
    return user_window_features(txns.withWatermark("event_time", delay), window_s, slide_s)


def stream_fraud_features(
    txns: DataFrame,
    window_s: int = V.FRAUD_WINDOW_SECONDS,
    slide_s: int = V.FRAUD_SLIDE_SECONDS,
    delay: str = "10 minutes",
) -> DataFrame:
    """Every transaction with each of its user's closed windows (end inclusive).

    Each transaction is given the ends of all windows it falls into and meets
    the windows on (user, window end). As the watermark is on that key, both
    sides drop their state when the window is done, and the state of a hot user
    is spread over its windows. A range condition on the window's bounds would
    keep every row for ever.
    """
    windows = stream_user_features(txns, window_s, slide_s, delay).select(
        "user_id", F.col("window.end").alias("window_end"), "txn_count", "avg_amount"
    )
    micros, slide = F.unix_micros("event_time"), slide_s * 1_000_000
    first = F.ceil(micros / slide)
    last = F.floor((micros + window_s * 1_000_000) / slide)
    ends = F.transform(F.sequence(first, last), lambda e: F.timestamp_micros(e * slide))
    moves = txns.withColumn("window_end", F.explode(ends)).withWatermark("window_end", delay)
    start = F.col("window_end") - F.expr(f"INTERVAL {window_s} SECONDS")
    return moves.join(windows, ["user_id", "window_end"]).select(
        *txns.columns, start.alias("window_start"), "window_end", "txn_count", "avg_amount"
    )


def newest_alerts_writer(path: str, order: tuple[str, ...], n: int = 10):
    """Keep the newest ``n`` flagged alerts: per micro-batch, re-rank them with
    the stored ones and commit them as the next version.

    A repeated batch changes nothing, and old versions are removed.
    """
    newest = [F.desc(c) for c in order]

    def write(batch: DataFrame, epoch: int) -> None:
        fresh = batch.filter("is_fraud_alert")

        def ranked(stored: DataFrame | None) -> DataFrame:
            rows = fresh if stored is None else stored.unionByName(fresh)
            return rows.orderBy(*newest).limit(n)

        replace_version(batch.sparkSession, path, numbered_epoch(batch, epoch, path), ranked, batch.schema)

    return write


def read_newest_alerts(spark, path: str, order: tuple[str, ...]) -> DataFrame:
    return read_version(spark, path).orderBy(*[F.desc(c) for c in order])
