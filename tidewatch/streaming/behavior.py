"""Behaviour scores over a stream of offences.

What a run of offences does to a user's score is two numbers: its total and its
lowest running sum. Two forms rest on that:

* ``stream_scores`` keeps the two numbers of each user in the state store. A
  micro-batch costs its own rows, whatever came before, and the scores of all
  users are read from the state (``read_scores``).
* ``score_writer`` stores the numbers of each batch (a repeated batch replaces
  its own) and ``current_scores`` composes them. Inside a batch the work is that
  of the batch operator, so it splits users that hold most of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators import ordered
from tidewatch.operators.behavior import ORDER, USER
from tidewatch.session import pin, unpin
from tidewatch.sources.sinks import EPOCH, epoch_writer, read_epochs

STEPS = f"user_id string, {ordered.CHUNK} int, total bigint, lowest bigint, {EPOCH} bigint"


def score_steps(
    offences: DataFrame, order: Sequence[str] = ORDER, max_rows_per_key: int = ordered.MAX_ROWS_PER_KEY
) -> DataFrame:
    """(user_id, chunk, total, lowest) of a set of consecutive offences."""
    parts, _ = ordered.chunked(offences, USER, order, max_rows_per_key)
    upto = ordered.in_chunk(USER, order).rowsBetween(Window.unboundedPreceding, 0)
    sums = parts.withColumn("_sum", F.sum("points").over(upto))
    return sums.groupBy(F.col("user_id").cast("string").alias("user_id"), ordered.CHUNK).agg(
        F.sum("points").cast("bigint").alias("total"), F.min("_sum").cast("bigint").alias("lowest")
    )


def score_writer(path: str, max_rows_per_key: int = ordered.MAX_ROWS_PER_KEY):
    """A foreachBatch function that stores the steps of each batch."""
    write = epoch_writer(path)

    def on_batch(batch: DataFrame, epoch: int) -> None:
        # End markers of a stream carry no user. The batch is stored, as its sizes are counted before it is worked on.
        real = pin(batch.filter(F.col("user_id").isNotNull()).select("user_id", *ORDER, "points"))
        write(score_steps(real, max_rows_per_key=max_rows_per_key), epoch)
        unpin(real)

    return on_batch


def current_scores(spark: SparkSession, path: str) -> DataFrame:
    """Score per user after all stored batches.

    A user has one small row per batch and chunk it occurs in.
    """
    steps = read_epochs(spark, path, STEPS)
    upto = (
        Window.partitionBy("user_id")
        .orderBy(EPOCH, ordered.CHUNK)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = steps.withColumn("after", F.sum("total").over(upto)).withColumn(
        "low", F.col("after") - F.col("total") + F.col("lowest")
    )
    return placed.groupBy("user_id").agg(
        (F.sum("total") - F.least(F.lit(0), F.min("low"))).cast("bigint").alias("behavior_score")
    )


STATE, STATE_SCHEMA = "steps", "total bigint, lowest bigint, n_offences bigint"
SCORES = "user_id string, behavior_score bigint, n_offences bigint"


class ScoreProcessor(StatefulProcessor):
    """Total, lowest running sum and number of offences of each user."""

    def __init__(self, order: Sequence[str] = ORDER):
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.steps = handle.getValueState(STATE, STATE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The offences of one user in one micro-batch, as numbers; texts do not come here.
        points = pd.concat(list(rows)).sort_values(self.order, kind="stable")["points"].to_numpy(np.int64)
        total, lowest, n = self.steps.get() if self.steps.exists() else (0, 0, 0)
        sums = total + np.cumsum(points)
        total, lowest, n = int(sums[-1]), min(int(lowest), int(sums.min())), int(n) + len(points)
        self.steps.update((total, lowest, n))
        yield pd.DataFrame({"user_id": [key[0]], "behavior_score": [total - lowest], "n_offences": [n]})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """A run with a new checkpoint goes on from given scores."""
        row = initialState.iloc[0]
        self.steps.update((int(row["behavior_score"]), 0, int(row["n_offences"])))

    def close(self) -> None:
        pass


def stream_scores(offences: DataFrame, order: Sequence[str] = ORDER, initial: DataFrame | None = None) -> DataFrame:
    """The new score of each user of a micro-batch (a stream for update mode).

    Offences count in the order of micro-batches and, within one, in ``order``
    (unique within a user). ``initial`` holds scores (``SCORES``) of an earlier
    run, which are taken over by the first batch of a new checkpoint. The points
    of one user in one micro-batch are sorted in one task: bound micro-batches
    at the source if single users send very many.
    """
    rows = offences.filter(F.col("user_id").isNotNull()).select(F.col("user_id").cast("string"), *order, "points")
    start = None if initial is None else initial.select("user_id", "behavior_score", "n_offences").groupBy("user_id")
    return rows.groupBy("user_id").transformWithStateInPandas(
        ScoreProcessor(order), outputStructType=SCORES, outputMode="Update", timeMode="None", initialState=start
    )


def read_scores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, behavior_score, n_offences) of all users, from the state after the last batch."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    total, lowest = F.col("value.total"), F.col("value.lowest")
    return state.select("key.user_id", (total - lowest).alias("behavior_score"), "value.n_offences")
