"""Top-n per key, safe under skewed keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence, n: int, spread: Sequence[str], slices: int = 64
) -> DataFrame:
    """First ``n`` rows per key by ``order``, with their 1-based ``rank``.

    Two steps: first the best ``n`` of every (key, slice), with the slice taken
    from the hash of the ``spread`` columns, then the best ``n`` of at most
    ``n * slices`` rows per key. A hot key is thus shared by many tasks.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*spread), F.lit(slices)))
    part = Window.partitionBy(*keys, "_slice").orderBy(*order)
    best = sliced.withColumn("_r", F.row_number().over(part)).filter(F.col("_r") <= n)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        best.drop("_r", "_slice")
        .withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= n)
    )
