"""Transaction features per user and sliding window, rules and alerts.

A transaction frame has transaction_id, user_id, amount, event_time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as V
from tidewatch.functions.temporal import epoch_seconds, parse_event_time

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def transactions_from_json(decoded: DataFrame) -> DataFrame:
    """Decoded transaction messages with their event time."""
    return decoded.withColumn("event_time", parse_event_time("timestamp")).drop("timestamp")


def user_window_features(
    txns: DataFrame, window_s: int = V.FRAUD_WINDOW_SECONDS, slide_s: int = V.FRAUD_SLIDE_SECONDS
) -> DataFrame:
    """Count and average amount per user and sliding window (batch or stream).

    Counts and sums are combined before the shuffle, so a hot user is cheap.
    """
    return txns.groupBy(
        F.window("event_time", f"{window_s} seconds", f"{slide_s} seconds"), "user_id"
    ).agg(F.count("transaction_id").alias("txn_count"), F.avg("amount").alias("avg_amount"))


def fraud_features(
    txns: DataFrame, window_s: int = V.FRAUD_WINDOW_SECONDS, slide_s: int = V.FRAUD_SLIDE_SECONDS
) -> DataFrame:
    """Every transaction with the features of each of its user's windows.

    The match is ``start <= event_time <= end``: the end counts, so a
    transaction on a slide boundary also meets the window that ends there.

    Transactions are reduced to one row per (user, slide step) first; all
    window features of a step come from that small table by range frames (one
    row per user and step, whatever the number of transactions). The
    transactions themselves move once, on the equi key (user, step), which also
    spreads a hot user over its steps; a range condition would pair each
    transaction with every window of the user.
    """
    if window_s % slide_s:
        raise ValueError("the window must be a multiple of the slide")
    k = window_s // slide_s
    step = F.floor(epoch_seconds("event_time") / slide_s)
    placed = txns.filter(F.col("user_id").isNotNull() & F.col("event_time").isNotNull()).withColumn(
        "_step", step
    )
    steps = placed.groupBy("user_id", "_step").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("transaction_id").alias("ids"),
        F.sum("amount").alias("total"),
        F.count("amount").alias("amounts"),
    )
    by_step = Window.partitionBy("user_id").orderBy("_step")

    def window_starting(back: int) -> Column:
        """Features of the window that starts ``back`` steps ago; null if empty."""
        frame = by_step.rangeBetween(-back, k - 1 - back)
        amounts = F.sum("amounts").over(frame)
        feature = F.struct(
            F.lit(back).alias("back"),
            F.sum("ids").over(frame).alias("txn_count"),
            F.when(amounts > 0, F.sum("total").over(frame) / amounts).alias("avg_amount"),
        )
        return F.when(F.sum("n").over(frame) > 0, feature)

    features = steps.select(
        "user_id", "_step", F.array(*[window_starting(b) for b in range(k + 1)]).alias("_windows")
    )
    start = F.timestamp_seconds((F.col("_step") - F.col("back")) * slide_s)
    time_type = txns.schema["event_time"].dataType
    end = start + F.expr(f"INTERVAL {window_s} SECONDS")
    return (
        placed.join(features, ["user_id", "_step"])
        .select("*", F.explode(F.filter("_windows", lambda w: w.isNotNull())).alias("_w"))
        .select("*", "_w.*")
        .withColumns({"window_start": start.cast(time_type), "window_end": end.cast(time_type)})
        .filter(F.col("event_time") <= F.col("window_end"))
        .select(*txns.columns, "window_start", "window_end", "txn_count", "avg_amount")
    )


def fraud_alerts(
    features: DataFrame, high_amount: float = V.HIGH_AMOUNT, high_count: int = V.HIGH_COUNT
) -> DataFrame:
    """Add ``is_fraud_alert`` (null operands never flag) and ``fraud_score``."""
    flagged = (F.col("amount") > high_amount) | (F.col("txn_count").cast("int") > high_count)
    return features.withColumns(
        {
            "is_fraud_alert": F.when(flagged, True).otherwise(False),
            "fraud_score": F.col("txn_count") / F.lit(10.0),
        }
    )


def one_alert_per_transaction(alerts: DataFrame) -> DataFrame:
    """Keep the highest score of each transaction's windows."""
    best = F.max_by(F.struct(*alerts.columns), F.struct("fraud_score", "window_start"))
    return alerts.groupBy("transaction_id").agg(best.alias("r")).select("r.*")


ALERT_FIELDS = ("transaction_id", "user_id", "amount", "is_fraud_alert", "fraud_score")


def alert_json(alerts: DataFrame) -> DataFrame:
    """The message published per alert row."""
    return alerts.select(F.to_json(F.struct(*ALERT_FIELDS)).alias("value"))


def latest_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    """Newest flagged alerts first."""
    order = [F.desc("event_time"), F.desc("transaction_id"), F.desc("window_start")]
    return alerts.filter("is_fraud_alert").orderBy(*order).limit(n)
