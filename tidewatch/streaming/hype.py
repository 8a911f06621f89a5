"""Price and sentiment streams, joined per bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_hype_meter(prices: DataFrame, social: DataFrame, width: int = 10, delay: str = "30 seconds") -> DataFrame:
    """Average price and sentiment per bucket, append mode.

    Each side is averaged per window first and the windows are joined: state is
    a few numbers per bucket and side instead of all rows of the interval. The
    result is that of joining first, as each price meets every post of its bucket.
    """
    span = f"{width} seconds"
    price = (
        prices.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", span))
        .agg(F.avg("price").alias("avg_price"))
    )
    mood = (
        social.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", span))
        .agg(F.avg("sentiment_score").alias("hype_score"))
    )
    return price.join(mood, "window").select(
        F.col("window.start").alias("time"), "avg_price", "hype_score"
    )
