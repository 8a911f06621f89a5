"""Streaming operators driven to completion over a shared table.

Each query replays the table in slices of time through a real streaming query
and returns the sink's table, which must equal the batch result.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import fraud, intervals
from tidewatch.plans import inputs as I
from tidewatch.session import scratch_path
from tidewatch.sources import messages
from tidewatch.sources.streams import decode_json
from tidewatch.streaming import behavior as behavior_stream
from tidewatch.streaming import fraud as fraud_stream
from tidewatch.streaming import hype as hype_stream
from tidewatch.streaming.running import drain, replay, to_batches, to_files


SLICES = 2


def _with_timestamp(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Watermarks need a timestamp with time zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def _through_files(spark, table: DataFrame, build, time: str = "event_time") -> DataFrame:
    out, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "checkpoint")
    closing = {"user_id": -1} if "user_id" in table.columns else None
    replay(table, time, lambda stream: to_files(build(stream), out, checkpoint), slices=SLICES, closing=closing)
    return spark.read.parquet(out)


def _ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def stream_user_features(spark, d):
    def build(stream):
        return fraud_stream.stream_user_features(stream, I.WINDOW_S, I.SLIDE_S).select(
            "user_id", "window.start", "window.end", "txn_count", "avg_amount"
        )

    rows = _through_files(spark, _with_timestamp(I.transactions(spark, d)), build)
    named = rows.withColumnsRenamed({"start": "window_start", "end": "window_end"})
    return _ntz(named, "window_start", "window_end").withColumn("avg_amount", F.round("avg_amount", 6))


def stream_fraud_alerts(spark, d):
    def build(stream):
        features = fraud_stream.stream_fraud_features(stream, I.WINDOW_S, I.SLIDE_S)
        return fraud.fraud_alerts(features, I.HIGH_AMOUNT, I.HIGH_COUNT)

    rows = _through_files(spark, _with_timestamp(I.transactions(spark, d)), build)
    return _ntz(rows, "event_time", "window_start", "window_end").withColumn(
        "avg_amount", F.round("avg_amount", 6)
    )


def stream_hype_meter(spark, d):
    """One table with both kinds of rows is replayed, so the sides keep pace."""
    prices = I.prices(spark, d).select("event_time", "price", F.lit(None).cast("double").alias("sentiment_score"))
    social = I.social(spark, d).select("event_time", F.lit(None).cast("double").alias("price"), "sentiment_score")
    both = _with_timestamp(prices.unionByName(social))

    def build(stream):
        # The closing row has neither value and must reach both sides.
        price = stream.filter("sentiment_score IS NULL").select("event_time", "price")
        mood = stream.filter("price IS NULL").select("event_time", "sentiment_score")
        return hype_stream.stream_hype_meter(price, mood, I.BUCKET_S)

    rows = _through_files(spark, both, build)
    return _ntz(rows, "time").withColumns({c: F.round(c, 6) for c in ("avg_price", "hype_score")})


def stream_hype_interval_join(spark, d):
    """Both kinds of rows are replayed as one table; the closing row reaches both sides and meets itself."""
    price, said = I.interval_sides(spark, d)
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    both = price.select("price_id", "price", none("post_id", "bigint"), none("sentiment_score", "double"), F.col("price_time").alias("t"))
    both = both.unionByName(
        said.select(none("price_id", "bigint"), none("price", "double"), "post_id", "sentiment_score", F.col("post_time").alias("t"))
    )

    def build(stream):
        left = stream.filter("post_id IS NULL").select("price_id", "price", F.col("t").alias("price_time"))
        right = stream.filter("price_id IS NULL").select("post_id", "sentiment_score", F.col("t").alias("post_time"))
        bounds = [timedelta(seconds=x) for x in (I.BEFORE_S, I.AFTER_S)]
        pairs = intervals.interval_join(left, right, "price_time", "post_time", *bounds, delay="10 minutes")
        return pairs.select("price_id", "post_id", "price", "sentiment_score")  # what the result has: pairs are many

    rows = _through_files(spark, _with_timestamp(both, "t"), build, time="t")
    return rows.filter("price_id IS NOT NULL")


def stream_until_marker(spark, d):
    """Events as a log of messages in three partitions, each cut off by an end marker, read over a restart.

    The marker of a partition stands behind its events up to a certain id; what follows it must not be read.
    """
    end = I.table(spark, d, "events").agg(F.floor(F.max("event_id") * 0.8).cast("bigint")).first()[0]
    events = I.table(spark, d, "events").select(
        F.pmod("event_id", F.lit(3)).alias("part"), F.col("event_id").cast("double").alias("at"), "event_id", "event_type", "value"
    )
    markers = spark.range(3).select(
        F.col("id").alias("part"), F.lit(end + 0.5).alias("at"), F.lit(I.END_ID).cast("bigint").alias("event_id"),
        F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("value"),
    )
    log = events.unionByName(markers)
    message = F.to_json(F.struct(F.col("event_id").alias("id"), "event_type", "value")).alias("value")
    path, ends, out, checkpoint = (scratch_path(spark, n) for n in ("log", "ends", "sink", "checkpoint"))

    # Files sort by name: those of the second delivery come after those of the first.
    log = log.select("part", (F.col("at") > end // 2).cast("int").alias("step"), "at", message)
    for step in range(2):
        ranged = log.filter(F.col("step") == step).repartitionByRange("part", "step", "at")
        ranged.sortWithinPartitions("part", "step", "at").drop("at").write.partitionBy("part", "step").mode("append").text(path)
        stream, reached = messages.log_until(spark, path, ends, I.END_ID)
        decoded = decode_json(stream, "id bigint, event_type string, value double")
        drain(to_files(decoded, out, checkpoint))
    if not reached():
        raise RuntimeError("an end marker was not read")
    rows = spark.read.parquet(out).filter(F.col("id") != I.END_ID)
    return rows.select(F.col("id").alias("event_id"), "event_type", "value")


def stream_behavior_score(spark, d):
    """Each slice resumes from the state that the slices before left in the checkpoint."""
    offences = _with_timestamp(I.offences(spark, d).drop("content", "colour"), "ts")
    checkpoint = scratch_path(spark, "checkpoint")

    def writer(stream):
        scores = behavior_stream.stream_scores(stream)
        return scores.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)

    replay(offences, "ts", writer, SLICES)
    return behavior_stream.read_scores(spark, checkpoint).select("user_id", "behavior_score")


NEWEST = ("event_time", "transaction_id", "window_start")


def stream_latest_alerts(spark, d):
    alerts = _with_timestamp(_with_timestamp(I.alerts(spark, d)), "window_start").withColumn(
        "window_end", F.col("window_end").cast("timestamp")
    )
    path, checkpoint = scratch_path(spark, "newest"), scratch_path(spark, "checkpoint")
    writer = fraud_stream.newest_alerts_writer(path, NEWEST)
    replay(alerts, "event_time", lambda s: to_batches(s, writer, checkpoint), SLICES)
    rows = fraud_stream.read_newest_alerts(spark, path, NEWEST)
    return _ntz(rows, "event_time", "window_start", "window_end").withColumn(
        "avg_amount", F.round("avg_amount", 6)
    )


QUERIES = {
    f.__name__: f
    for f in (
        stream_user_features,
        stream_fraud_alerts,
        stream_hype_meter,
        stream_hype_interval_join,
        stream_until_marker,
        stream_behavior_score,
        stream_latest_alerts,
    )
}
