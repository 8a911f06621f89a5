"""Ordered work per key that does not rest on one task per key.

A window partitioned by the key alone puts a whole key into one task. That is
fine while every key is small; a key with a third of all rows is not. Here a
frame with such keys is range-partitioned on (key, order) into even chunks,
written once, and the operators work per (key, chunk) and carry the state of
the earlier chunks over: one small row per key and chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.session import pin

CHUNK = "_chunk"
POSITION = "_position"
MAX_ROWS_PER_KEY = 5_000_000
#: Fewer rows are no task of their own, however few a key may have.
LEAST_CHUNK = 50_000


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest key and of all (counts are combined before the shuffle)."""
    counts = df.groupBy(*keys).count()
    largest, total = counts.agg(F.max("count"), F.sum("count")).first()
    return largest or 0, total or 0


def chunked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
    chunks: int | None = None,
) -> tuple[DataFrame, bool]:
    """Add ``_chunk``: consecutive runs of each key's rows in ``order``.

    ``order`` must be unique within a key. Without a large key every row is in
    chunk 0 and nothing is moved or written; the flag says whether keys were
    split. The check counts rows per key, so ``df`` should be a stored table;
    ``max_rows_per_key=None`` states that keys are known to be small. A chunk is
    a task and a file: a bound below LEAST_CHUNK decides what is split, not how
    many chunks there are, so that their number follows the rows alone.
    """
    if max_rows_per_key is None:
        return df.withColumn(CHUNK, F.lit(0)), False
    largest, total = group_sizes(df, keys)
    if largest <= max_rows_per_key:
        return df.withColumn(CHUNK, F.lit(0)), False
    # Enough chunks that none holds many more rows than a key may, or than are worth a task.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks or max(partitions, math.ceil(total / max(max_rows_per_key, LEAST_CHUNK)))
    ranged = df.repartitionByRange(chunks, *keys, *order)
    # Range bounds come from a sample: fix the outcome before it is read twice.
    return pin(ranged.withColumn(CHUNK, F.spark_partition_id())), True


def in_chunk(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def before_chunk(keys: Sequence[str]) -> WindowSpec:
    """All earlier chunks of the key, over the one-row-per-chunk summary."""
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi join in which null keys equal each other, as they do in a window."""
    other = [f"_on_{k}" for k in keys]
    named = right.withColumnsRenamed(dict(zip(keys, other)))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)]
    return left.join(named, reduce(lambda a, b: a & b, same)).drop(*other)


def with_position(df: DataFrame, split: bool, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the 1-based ``_position`` within the key to a chunked frame."""
    local = df.withColumn(POSITION, F.row_number().over(in_chunk(keys, order)).cast("bigint"))
    if not split:
        return local
    sizes = df.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        *keys, CHUNK, F.coalesce(F.sum("_n").over(before_chunk(keys)), F.lit(0)).alias("_offset")
    )
    return (
        join_on_keys(local, offsets, [*keys, CHUNK])
        .withColumn(POSITION, F.col(POSITION) + F.col("_offset"))
        .drop("_offset")
    )


def with_sums_before(
    df: DataFrame, split: bool, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Add sums over all earlier rows of the key to a chunked frame."""
    earlier = in_chunk(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns({name: F.coalesce(F.sum(x).over(earlier), F.lit(0)) for name, x in sums.items()})
    if not split:
        return local
    totals = df.groupBy(*keys, CHUNK).agg(*[F.sum(x).alias(f"_t_{name}") for name, x in sums.items()])
    before = before_chunk(keys)
    starts = totals.select(
        *keys, CHUNK, *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_s_{name}") for name in sums]
    )
    joined = join_on_keys(local, starts, [*keys, CHUNK])
    return joined.withColumns({name: F.col(name) + F.col(f"_s_{name}") for name in sums}).drop(*[f"_s_{n}" for n in sums])


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    n: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
    max_rows_per_key: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Columns over the last ``n`` rows of a key.

    Large keys are cut into blocks of equal length by position, and the last
    ``n - 1`` rows of a block are also handed to the next one, so that no frame
    loses rows at a cut.
    """
    parts, split = chunked(df, keys, order, max_rows_per_key)
    if not split:
        frame = in_chunk(keys, order).rowsBetween(-(n - 1), 0)
        return parts.withColumns({name: f(frame) for name, f in columns.items()}).drop(CHUNK)
    length = max(max_rows_per_key // 4, 2 * n)
    placed = with_position(parts, split, keys, order)
    zero_based = F.col(POSITION) - 1
    block = F.floor(zero_based / length)
    in_tail = F.pmod(zero_based, F.lit(length)) >= length - (n - 1)
    homes = F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))
    spread = placed.withColumn("_block", F.explode(homes))
    frame = Window.partitionBy(*keys, "_block").orderBy(POSITION).rowsBetween(-(n - 1), 0)
    rolled = spread.withColumns({name: f(frame) for name, f in columns.items()})
    return rolled.filter(F.col("_block") == block).drop("_block", POSITION, CHUNK)
