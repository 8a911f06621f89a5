"""Join of two sides by the distance of their times, in batch and on streams.

Spark joins rows by equal values; a bare range condition would compare all with
all. Time is cut into bins as long as the interval: a row of the left side can
only meet rows of the one or two bins that its interval touches, a row of the
right side is in one bin, so every pair is compared once and found once. On
streams the rows that a micro-batch brings into a bin go into the state in
packs, as the state store pays per entry and not per byte; from the condition
on the packs (and the watermarks) Spark derives when one can meet nothing any
more and drops it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BIN = "_bin"
#: Rows of a pack, and rows that a task gathers before it packs them.
PACK, GATHERED = 512, 200_000


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def _span(length: timedelta) -> Column:
    return F.expr(f"INTERVAL '{length // timedelta(microseconds=1)}' SECOND / 1000000")


def _packs(table: pa.Table, by: list[str], time: str, names: list[str]) -> pa.RecordBatch:
    """Rows of equal ``by`` in order of time as lists of at most PACK, with the last time of each."""
    table = table.sort_by([(c, "ascending") for c in (*by, time)]).combine_chunks()
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for c in by:
        values = table.column(c)
        new[1:] |= pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(new)
    at = np.arange(len(new)) - np.repeat(first, np.diff([*first, len(new)]))
    cuts = np.flatnonzero(at % PACK == 0)
    ends = np.append(cuts[1:], len(new))
    rows = table.drop_columns(by).to_struct_array()
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(new)), pa.int32()), rows)
    columns = [*(table.column(c).take(pa.array(cuts)).combine_chunks() for c in by), table.column(time).take(pa.array(ends - 1)).combine_chunks(), lists]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _packed(side: DataFrame, by: list[str], time: str, at: str, rows: str) -> DataFrame:
    """One row per pack of the rows of a micro-batch with equal ``by``: ``by``, ``at`` (last time), ``rows``."""
    fields = {f.name: f for f in side.schema.fields}
    packed = T.ArrayType(T.StructType([T.StructField(c, f.dataType) for c, f in fields.items() if c not in by]))
    names = [*by, at, rows]
    schema = T.StructType([*(T.StructField(c, fields[c].dataType) for c in by), T.StructField(at, fields[time].dataType), T.StructField(rows, packed)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= GATHERED:
                yield _packs(pa.Table.from_batches(waiting), by, time, names)
                waiting, n = [], 0
        if waiting:
            yield _packs(pa.Table.from_batches(waiting), by, time, names)

    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    return side.filter(known).repartition(*by).mapInArrow(run, schema)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    before: timedelta,
    after: timedelta,
    keys: Sequence[str] = (),
    delay: str | None = None,
) -> DataFrame:
    """Pairs with ``left_time - before <= right_time <= left_time + after``, both ends included, and equal ``keys``.

    Apart from the keys, the sides must not share column names. Rows without a
    time or with a null key meet nothing. A negative bound moves the interval to
    one side of the left time; an empty interval gives no pairs. For streams
    give ``delay``, the watermark of both sides: a row is kept until the
    watermark of the other side is past its interval and that of its pack. The
    times of the pairs then carry no watermark of their own.
    """
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    unit = timedelta(microseconds=1)
    low, high = -(before // unit), after // unit
    width = max(high - low, 1)
    at = _micros(F.col(left_time))
    first, last = (F.floor((at + F.lit(x)) / width).cast("bigint") for x in (low, high))
    touched = F.when(F.lit(high >= low), F.sequence(first, F.greatest(first, last)))
    here = left.withColumn(BIN, F.explode(touched))
    named = {k: f"_r_{k}" for k in keys}
    there = right.withColumnsRenamed(named).withColumn("_r" + BIN, F.floor(_micros(F.col(right_time)) / width).cast("bigint"))
    same = [F.col(BIN) == F.col("_r" + BIN), *[F.col(k) == F.col(r) for k, r in named.items()]]
    near = F.col("_rt").between(F.col("_low"), F.col("_high"))
    # Bounds are worked out per row: a condition is evaluated per pair.
    here = here.withColumns({"_low": F.col(left_time) - _span(before), "_high": F.col(left_time) + _span(after)})
    there = there.withColumn("_rt", F.col(right_time))
    if delay is None:
        joined = here.join(there, reduce(lambda a, b: a & b, [*same, near]))
        return joined.drop(BIN, "_r" + BIN, "_low", "_high", "_rt", *named.values())
    here = _packed(here, [BIN, *keys], left_time, "_at", "_rows").withWatermark("_at", delay)
    there = _packed(there, ["_r" + BIN, *named.values()], right_time, "_r_at", "_r_rows").withWatermark("_r_at", delay)
    # Left rows of a pack lie within two bins, right ones within one: the last ones are as near as that.
    bin_ = timedelta(microseconds=width)
    may = F.col("_r_at").between(F.col("_at") - _span(before + 2 * bin_), F.col("_at") + _span(after + bin_))
    met = here.join(there, reduce(lambda a, b: a & b, [*same, may]))
    pairs = met.select(*keys, F.explode("_rows").alias("_l"), "_r_rows").select(*keys, "_l", F.explode("_r_rows").alias("_r"))
    pairs = pairs.filter(F.col("_r._rt").between(F.col("_l._low"), F.col("_l._high")))
    own = [F.col(c) if c in keys else F.col("_l").getField(c).alias(c) for c in left.columns]
    return pairs.select(*own, *[F.col("_r").getField(c).alias(c) for c in right.columns if c not in keys])
