"""Exact quantiles of any numeric column by radix selection.

Values become whole numbers that sort alike, and the wanted ranks of all groups
are found together, 21 bits at a time: count the rows per next digit among those
that share the digits found so far, then go on in the digit where the rank lies.
Counts are combined before they move, so a task holds digits, never values: four
passes at most, however many rows or distinct values there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.ordered import join_on_keys
from tidewatch.session import pin, unpin

BITS = 21
_KEY, _PREFIX, _DIGIT, _RANK, _FOUND = "_key", "_prefix", "_digit", "_rank", "_found"


def order_key(column: Column, kind: T.DataType) -> Column:
    """A bigint that sorts as the values do; null for null and NaN.

    Doubles give their bits, with all but the sign turned over below zero; both
    zeros are one.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("bigint")
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (column * F.lit(10**kind.scale)).cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        x = column.cast("double") + F.lit(0.0)
        raw = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), x).cast("bigint")
        key = F.when(raw >= 0, raw).otherwise(raw.bitwiseXOR(F.lit(2**63 - 1)))
        return F.when(x.isNotNull() & ~F.isnan(x), key)
    raise TypeError(f"no order key for {kind.simpleString()}")


def from_order_key(key: Column, kind: T.DataType) -> Column:
    """The value behind a key, as a double."""
    if isinstance(kind, T.DecimalType):
        return key.cast("double") / F.lit(float(10**kind.scale))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        raw = F.when(key >= 0, key).otherwise(key.bitwiseXOR(F.lit(2**63 - 1)))
        return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw).cast("double")
    return key.cast("double")


def _selected(keyed: DataFrame, wanted: DataFrame, by: list[str], width: int) -> DataFrame:
    """``wanted`` (by, _rank from 0) with ``_found``: the key that has this rank in its group.

    ``width`` bits tell the keys apart. The table of prefixes in work has one
    row per group and rank; it is written between passes, the rows never are.
    """
    rounds = max(1, -(-width // BITS))
    found = wanted.withColumn(_PREFIX, F.lit(0).cast("bigint")).withColumn("_left", F.col(_RANK))
    for step in range(rounds):
        shift = BITS * (rounds - 1 - step)
        digit = F.shiftright(_KEY, shift)
        rows = keyed.withColumn(_PREFIX, F.lit(0).cast("bigint"))
        if step:
            digit = digit.bitwiseAND(F.lit((1 << BITS) - 1))
            known = found.select(*by, _PREFIX).distinct()
            rows = keyed.withColumn(_PREFIX, F.shiftright(_KEY, shift + BITS))
            # Without groups there are as many rows as ranks were asked for.
            rows = join_on_keys(rows, known if by else F.broadcast(known), [*by, _PREFIX])
        counts = rows.withColumn(_DIGIT, digit).groupBy(*by, _PREFIX, _DIGIT).agg(F.count(F.lit(1)).alias("_c"))
        upto = F.sum("_c").over(Window.partitionBy(*by, _PREFIX).orderBy(_DIGIT))
        counts = counts.withColumn("_upto", upto).withColumnRenamed(_DIGIT, "_next")
        placed = join_on_keys(found, counts, [*by, _PREFIX]).filter("_left < _upto AND _left >= _upto - _c")
        before, found = found, pin(
            placed.select(
                *by,
                _RANK,
                (F.col("_left") - (F.col("_upto") - F.col("_c"))).alias("_left"),
                (F.shiftleft(_PREFIX, BITS) + F.col("_next")).alias(_PREFIX),
            )
        )
        if step:
            unpin(before)
    return found.select(*by, _RANK, F.col(_PREFIX).alias(_FOUND))


def quantiles(df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, n, q): rows with a value per group and its quantiles, interpolated between neighbours.

    Nulls and NaN do not count; groups without other values have no row. Null
    group keys are a group. ``value`` is any whole number, float, double or
    decimal of up to 18 digits; q is an array of doubles in the order of
    ``fractions``.
    """
    by, kind = list(by), df.schema[value].dataType
    keyed = df.select(*by, order_key(F.col(value), kind).alias(_KEY)).filter(F.col(_KEY).isNotNull())
    sizes = pin(keyed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(_KEY).alias("_low"), F.max(_KEY).alias("_high")))
    sizes = sizes.filter("n > 0")
    low, high = sizes.agg(F.min("_low"), F.max("_high")).first()
    if low is None:
        return sizes.select(*by, "n", F.array().cast("array<double>").alias("q"))
    # Keys that lie close together need few digits; far apart, the sign is part of the first.
    near = high - low < 2**62
    keyed = keyed.withColumn(_KEY, F.col(_KEY) - F.lit(low if near else 0).cast("bigint"))
    at = [(F.col("n") - 1).cast("double") * F.lit(float(f)) for f in fractions]
    ranks = F.array_distinct(F.array(*[f(h).cast("bigint") for h in at for f in (F.floor, F.ceil)]))
    wanted = sizes.select(*by, F.explode(ranks).alias(_RANK))
    found = _selected(keyed, wanted, by, (high - low).bit_length() if near else 64)
    values = found.select(*by, _RANK, from_order_key(F.col(_FOUND) + F.lit(low if near else 0).cast("bigint"), kind).alias("_v"))
    by_rank = values.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct(_RANK, "_v"))).alias("_at"))
    joined = join_on_keys(sizes, by_rank, by) if by else sizes.withColumn("_at", by_rank.scalar())
    below = [F.col("_at")[F.floor(h).cast("bigint")] for h in at]
    above = [F.col("_at")[F.ceil(h).cast("bigint")] for h in at]
    mixed = [F.when(a == b, a).otherwise(a + (b - a) * (h - F.floor(h))) for a, b, h in zip(below, above, at)]
    return joined.select(*by, "n", F.array(*mixed).alias("q"))
