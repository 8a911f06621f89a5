"""Rolling indicators over bars: symbol, date, close and a unique order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.numeric import nan_to_null
from tidewatch.operators import ordered
from tidewatch.operators.lookups import top_per_key

KEYS = ("symbol",)
ORDER = ("ts", "bar_id")


def moving_average(
    bars: DataFrame,
    n: int,
    value: str = "close",
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
    max_rows_per_key: int | None = ordered.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Mean of the last ``n`` rows; null unless all ``n`` are there and non-null."""

    def mean(frame):
        return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))

    return ordered.rolling(bars, keys, order, n, {f"sma_{n}": mean}, max_rows_per_key)


def daily_return(
    bars: DataFrame,
    value: str = "close",
    keys: Sequence[str] = KEYS,
    order: Sequence[str] = ORDER,
    max_rows_per_key: int = ordered.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Change against the previous row, gaps filled with the last known value.

    A change from 0 is infinite; from 0 to 0 it is null.
    """
    parts, split = ordered.chunked(bars, keys, order, max_rows_per_key)
    here = ordered.in_chunk(keys, order)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    filled = parts.withColumn("_filled", F.last(value, ignorenulls=True).over(upto))
    if split:
        known = F.col(value).isNotNull()
        ends = parts.groupBy(*keys, ordered.CHUNK).agg(
            F.max_by(value, F.when(known, F.struct(*order))).alias("_end")
        )
        carried = ends.select(
            *keys,
            ordered.CHUNK,
            F.last("_end", ignorenulls=True).over(ordered.before_chunk(keys)).alias("_carry"),
        )
        filled = ordered.join_on_keys(filled, carried, [*keys, ordered.CHUNK])
    else:
        filled = filled.withColumn("_carry", F.lit(None).cast("double"))
    current = F.coalesce("_filled", "_carry")
    before = F.coalesce(F.lag("_filled").over(here), F.col("_carry"))
    infinite = F.signum(current) * F.lit(float("inf"))
    from_zero = F.when(current != 0, infinite)
    change = F.when(before == 0, from_zero).otherwise(current / before - 1)
    return filled.withColumn("daily_return", change).drop("_filled", "_carry", ordered.CHUNK)


def recent_bars(bars: DataFrame, n: int = 500, sma: int = 50) -> DataFrame:
    """The last ``n`` bars of each symbol with the average inside that slice."""
    newest_first = [F.desc(c) for c in ORDER]
    recent = top_per_key(bars, KEYS, newest_first, n, spread=("bar_id",)).drop("rank")
    # At most n rows per symbol are left, so a plain window per symbol is bounded.
    return moving_average(recent, sma, max_rows_per_key=None)


def series_payload(bars: DataFrame, n: int = 500, sma: int = 50) -> DataFrame:
    """Parallel arrays per symbol over its last ``n`` bars, nulls kept."""
    points = recent_bars(bars, n, sma).select(
        "symbol",
        F.struct(
            *ORDER,
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            nan_to_null("close").alias("close"),
            nan_to_null(f"sma_{sma}").alias("sma"),
        ).alias("p"),
    )
    series = F.array_sort(F.collect_list("p"))
    return points.groupBy("symbol").agg(series.alias("s")).select(
        "symbol",
        F.col("s.date").alias("dates"),
        F.col("s.close").alias("closes"),
        F.col("s.sma").alias("sma_prices"),
    )


def unknown_symbols(requested: DataFrame, bars: DataFrame) -> DataFrame:
    """Requested symbols without bars, with the reason; empty requests too."""
    wanted = requested.select(F.upper(F.coalesce("symbol", F.lit(""))).alias("symbol")).distinct()
    known = bars.select(F.upper("symbol").alias("symbol")).distinct()
    reason = F.when(F.col("symbol") == "", "no symbol given").otherwise(
        F.concat(F.lit("no data found for symbol "), F.col("symbol"))
    )
    return wanted.join(known, "symbol", "left_anti").withColumn("reason", reason)


def bars_for(bars: DataFrame, requested: DataFrame) -> DataFrame:
    """Bars of the requested symbols only."""
    wanted = requested.select(F.upper("symbol").alias("symbol")).filter("symbol <> ''").distinct()
    return bars.join(wanted, "symbol", "left_semi")
