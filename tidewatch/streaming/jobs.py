"""The two standing jobs, put together from sources, operators and sinks.

Each takes message frames with a ``value`` column (a topic, files, ...), so the
transport is the caller's choice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewatch import fixed_values as V
from tidewatch.operators.fraud import TRANSACTION_SCHEMA, alert_json, fraud_alerts, transactions_from_json
from tidewatch.operators.scoring import Scorer, lexicon_sentiment
from tidewatch.sources.sinks import console_writer
from tidewatch.sources.streams import (
    PRICE_SCHEMA,
    SOCIAL_SCHEMA,
    decode_json,
    with_arrival_time,
    with_payload_time,
)
from tidewatch.streaming.fraud import stream_fraud_features
from tidewatch.streaming.hype import stream_hype_meter
from tidewatch.streaming.running import to_batches


def fraud_alert_messages(
    messages: DataFrame,
    window_s: int = V.FRAUD_WINDOW_SECONDS,
    slide_s: int = V.FRAUD_SLIDE_SECONDS,
    high_amount: float = V.HIGH_AMOUNT,
    high_count: int = V.HIGH_COUNT,
    delay: str = "10 minutes",
) -> DataFrame:
    """Transaction messages in, alert messages out (a ``value`` column)."""
    txns = transactions_from_json(decode_json(messages, TRANSACTION_SCHEMA))
    features = stream_fraud_features(txns, window_s, slide_s, delay)
    return alert_json(fraud_alerts(features, high_amount, high_count))


def hype_meter_rows(
    price_messages: DataFrame,
    social_messages: DataFrame,
    scorer: Scorer | None = None,
    width: int = 10,
    delay: str = "30 seconds",
    event_time: str = "payload",
) -> DataFrame:
    """Price and post messages in, one row per closed bucket out.

    ``event_time="arrival"`` takes the processing time instead of the time in
    the message.
    """
    timed = with_arrival_time if event_time == "arrival" else with_payload_time
    prices = timed(decode_json(price_messages, PRICE_SCHEMA)).select("price", "event_time")
    posts = timed(decode_json(social_messages, SOCIAL_SCHEMA))
    score = (scorer or lexicon_sentiment())(F.col("text"))
    social = posts.select("event_time", score.alias("sentiment_score"))
    return stream_hype_meter(prices, social, width, delay)


def hype_writers(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> list[DataStreamWriter]:
    """The keyed sink and a console copy, each with its own checkpoint."""
    return [
        to_batches(rows, write, f"{checkpoint}/table"),
        console_writer(rows, f"{checkpoint}/console"),
    ]


def run_until_any_stops(spark: SparkSession, writers: list[DataStreamWriter]) -> None:
    """Start all and wait; if one query ends or fails the others are stopped."""
    queries = [w.start() for w in writers]
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
