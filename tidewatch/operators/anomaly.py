"""Isolation forest: all trees grow together, level by level; scoring is a narrow map.

A level is one aggregate (size and range of every node of every tree), one draw
per node from a hash of (seed, tree, node), and one step of all rows to the side
of the cut they fall on. No task holds a tree, so the sample of a tree may be as
large as one likes, and the same draws can be repeated in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.operators.quantiles import quantiles
from tidewatch.session import pin, unpin

FEATURES = ("amount", "txn_count", "avg_amount")
NODE_SCHEMA = "tree int, node int, feature int, cut double, size int"
LEAF = -1
#: Scores are rounded, so that rows with equal paths are on one side of a cut.
SCORE_DIGITS = 6


def training_union(normal: DataFrame, anomalous: DataFrame) -> DataFrame:
    """Both sets as one training table."""
    return normal.unionByName(anomalous)


def _mean_path(size: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``size`` points."""
    n = np.maximum(size, 2).astype(float)
    full = 2.0 * (np.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n
    return np.where(size > 2, full, np.where(size == 2, 1.0, 0.0))


def draw(*parts: Column) -> Column:
    """A number from 0 to 2**32 - 1 that follows from its parts alone."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def _share(wanted: float, total: int) -> int:
    """Draws below this number pick ``wanted`` of ``total`` rows on average."""
    return math.floor(min(1.0, wanted / max(total, 1)) * 4294967296.0)


def tree_samples(points: DataFrame, key: str, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, node 0, x): ``sample`` rows for each tree, chosen by draws of their keys.

    Rows enter a pool by one draw each, as large as all samples together; the
    rows of the pool then draw for each tree, and the first by draw and key are
    its sample. A table of fewer rows is its own pool.
    """
    name = F.col(key).cast("string")
    pool = points.filter(draw(F.lit(seed), F.lit("pool"), name) < _share(1.5 * trees * sample, points.count()))
    pool = pin(pool)
    each = _share(1.5 * sample + 50, pool.count())
    own = draw(F.lit(seed), F.lit("tree"), F.col("tree"), name)
    chosen = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("_d", own)
    first = Window.partitionBy("tree").orderBy("_d", key)
    chosen = chosen.filter(F.col("_d") < each).withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= sample)
    rows = pin(chosen.select("tree", F.lit(0).alias("node"), "x"))
    unpin(pool)
    return rows


def grow(rows: DataFrame, features: int, depth_limit: int, seed: int) -> tuple[DataFrame, list[DataFrame]]:
    """The nodes (heap numbering) of all trees over ``rows`` (tree, node, x: array of the features), and what they are read from.

    A node of one row, of equal rows or at the limit is a leaf. Else it cuts a
    feature that is not constant in it, both drawn by hash: values below the cut
    go left. Rows are written once per level, with the cut of their node.
    """
    levels = []
    for depth in range(depth_limit + 1):
        ranges = [f(F.col("x")[i]).alias(f"{name}{i}") for i in range(features) for name, f in (("_lo", F.min), ("_hi", F.max))]
        found = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).cast("int").alias("size"), *ranges)
        spans = F.array(
            *[F.struct(F.lit(i).alias("i"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")) for i in range(features)]
        )
        found = found.withColumn("_s", F.filter(spans, lambda s: s["hi"] > s["lo"]))
        at = [F.lit(seed), F.col("tree"), F.col("node")]
        pick = F.pmod(draw(*at, F.lit("feature")), F.size("_s").cast("bigint")).cast("int")
        inner = (F.size("_s") > 0) & F.lit(depth < depth_limit)
        found = found.withColumn("_p", F.when(inner, F.col("_s")[pick]))
        width = draw(*at, F.lit("cut")).cast("double") / F.lit(4294967296.0) * (F.col("_p.hi") - F.col("_p.lo"))
        cuts = found.select(
            "tree",
            "node",
            F.coalesce("_p.i", F.lit(LEAF)).alias("feature"),
            F.coalesce(F.col("_p.lo") + width, F.lit(0.0)).alias("cut"),
            "size",
        )
        level = pin(rows.join(cuts, ["tree", "node"]))
        levels.append(level)
        right = F.when(F.col("x")[F.col("feature")] >= F.col("cut"), 2).otherwise(1)
        rows = level.filter(F.col("feature") != LEAF).select("tree", (2 * F.col("node") + right).alias("node"), "x")
    return reduce(DataFrame.unionByName, levels).drop("x").distinct(), levels


@dataclass(frozen=True)
class IsolationForest:
    """Node table of a fitted forest and the score cut for its contamination."""

    nodes: pd.DataFrame
    features: tuple[str, ...]
    sample: int
    cut: float

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"features": ",".join(self.features), "sample": self.sample, "cut": self.cut}
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(pd.DataFrame([meta])).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsolationForest:
        meta = spark.read.parquet(f"{path}/meta").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return IsolationForest(nodes, tuple(meta.features.split(",")), meta["sample"], meta.cut)

    def score(self, df: DataFrame) -> DataFrame:
        """Add anomaly_score in (0, 1] and is_anomaly (null features count as 0)."""
        return self.flag(_score(df, self.nodes, self.features, self.sample))

    def flag(self, scored: DataFrame) -> DataFrame:
        return scored.withColumn("is_anomaly", F.col("anomaly_score") > self.cut)


def _score(df: DataFrame, nodes: pd.DataFrame, features: Sequence[str], sample: int) -> DataFrame:
    # The node table is bounded: trees * (2 * sample - 1) small rows.
    trees = int(nodes["tree"].max()) + 1
    width = int(nodes["node"].max()) + 1
    feature = np.full((trees, width), LEAF, dtype=np.int16)
    cut, size = np.zeros((trees, width)), np.zeros((trees, width), dtype=np.int32)
    at = (nodes["tree"].to_numpy(), nodes["node"].to_numpy())
    feature[at], cut[at], size[at] = nodes["feature"], nodes["cut"], nodes["size"]
    shared = df.sparkSession.sparkContext.broadcast((feature, cut, size))
    depth = max(1, math.ceil(math.log2(max(sample, 2))))
    names = list(features)

    @F.pandas_udf("double")
    def anomaly_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, cut, size = shared.value
        norm = float(_mean_path(np.array([sample]))[0]) or 1.0
        for columns in batches:
            x = np.column_stack([c.fillna(0.0).to_numpy(dtype=float) for c in columns])
            rows, total = np.arange(len(x)), np.zeros(len(x))
            for tree in range(feature.shape[0]):
                node = np.zeros(len(x), dtype=np.int64)
                length = np.zeros(len(x))
                for _ in range(depth):
                    split = feature[tree, node]
                    inner = split != LEAF
                    right = x[rows, np.maximum(split, 0)] >= cut[tree, node]
                    node = np.where(inner, 2 * node + 1 + right, node)
                    length += inner
                total += length + _mean_path(size[tree, node])
            yield pd.Series(np.round(np.power(2.0, -total / (feature.shape[0] * norm)), SCORE_DIGITS))

    return df.withColumn("anomaly_score", anomaly_score(*[F.col(n).cast("double") for n in names]))


def fit_and_score(
    df: DataFrame,
    key: str,
    features: Sequence[str] = FEATURES,
    trees: int = 100,
    sample: int = 256,
    contamination: float = 0.1,
    seed: int = 42,
) -> tuple[IsolationForest, DataFrame]:
    """A forest of ``trees`` trees on ``sample`` rows each, and ``df`` scored and flagged by it.

    Keys must be unique. Only the node table comes to the driver:
    ``trees * (2 * sample - 1)`` rows at most. Scores are computed and stored
    once; the cut is their exact (1 - contamination) quantile.
    """
    values = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    points = df.select(F.col(key), values.alias("x"))
    rows = tree_samples(points, key, trees, sample, seed)
    # A table of fewer rows is its own sample; depth and norm follow from it.
    sample = min(sample, max(points.count(), 1))
    grown, levels = grow(rows, len(features), math.ceil(math.log2(max(sample, 2))), seed)
    nodes = grown.toPandas()
    unpin(rows, *levels)
    if nodes.empty:
        raise ValueError("no rows to train on")
    scored = pin(_score(df, nodes, features, sample))
    cut = quantiles(scored, "anomaly_score", (1.0 - contamination,)).first().q[0]
    forest = IsolationForest(nodes, tuple(features), sample, float(cut))
    return forest, forest.flag(scored)


def fit_isolation_forest(df: DataFrame, key: str, *args, **options) -> IsolationForest:
    """The forest of ``fit_and_score`` alone."""
    return fit_and_score(df, key, *args, **options)[0]
