"""Prices against the sentiment of posts, per time bucket.

A price frame has price and event_time, a social frame sentiment_score and
event_time. Both meet when they fall into the same bucket of ``width`` seconds;
the interval of plus or minus one bucket is implied by that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.temporal import bucket_start


def _per_bucket(df: DataFrame, width: int, value: str, mean: str, rows: str) -> DataFrame:
    time_type = df.schema["event_time"].dataType
    return df.groupBy(bucket_start("event_time", width).cast(time_type).alias("time")).agg(
        F.avg(value).alias(mean), F.count(F.lit(1)).alias(rows)
    )


def hype_pairs(prices: DataFrame, social: DataFrame, width: int = 10) -> DataFrame:
    """What the join of both sides holds per bucket, without building its rows.

    Within a bucket every price meets every post, so the join has
    ``n_price * n_social`` rows there and repeats each value equally often: its
    averages are the averages of the sides. Each side is reduced to one row per
    bucket before the join, which makes the work O(n + m).
    """
    left = _per_bucket(prices, width, "price", "avg_price", "n_price")
    right = _per_bucket(social, width, "sentiment_score", "hype_score", "n_social")
    return left.join(right, "time").withColumn("n_pairs", F.col("n_price") * F.col("n_social"))


def hype_meter(prices: DataFrame, social: DataFrame, width: int = 10) -> DataFrame:
    """Average price and average sentiment per bucket that has both."""
    return hype_pairs(prices, social, width).select("time", "avg_price", "hype_score")


def latest_hype(hype: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` buckets, oldest of them first."""
    return hype.orderBy(F.desc("time")).limit(n).orderBy("time")


def current_metric(hype: DataFrame) -> DataFrame:
    """Values of the newest bucket."""
    return hype.select("time", "avg_price", "hype_score").orderBy(F.desc("time")).limit(1)
