"""Offences and the behaviour score of their users.

An offence frame has user_id, name, ts, seq (unique order within a user: any
columns, see ORDER), offense, points (null = by severity), content.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.functions.numeric import signed
from tidewatch.functions.temporal import minute_prefix
from tidewatch.operators import ordered
from tidewatch.operators.lookups import top_per_key

ORDER = ("ts", "message_id", "seq")
USER = ("user_id",)


def offence_points(offences: DataFrame, severity: Mapping[str, int] = V.SEVERITY_POINTS) -> DataFrame:
    """Explicit points, else those of the type, else 1; and the colour class."""
    by_type = F.create_map(*[F.lit(v) for pair in severity.items() for v in pair])
    points = F.coalesce(
        F.col("points").cast("int"),
        F.try_element_at(by_type, F.col("offense")),
        F.lit(V.DEFAULT_SEVERITY),
    )
    pts = F.col("points")
    colour = F.when(pts < 0, "green").when(pts >= 50, "red").otherwise("orange")
    return offences.withColumn("points", points).withColumn("colour", colour)


def behavior_score(
    offences: DataFrame,
    order: Sequence[str] = ORDER,
    max_rows_per_key: int = ordered.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Running score per user, never below 0 after any step.

    With running sum S the clamped score is S - min(0, min S so far). A run of
    rows turns a start score s into max(s + S, S - min S), which composes: a
    large user is worked on in chunks, and each chunk starts from the score
    that the summaries of the earlier chunks give.
    """
    parts, split = ordered.chunked(offences, USER, order, max_rows_per_key)
    upto = ordered.in_chunk(USER, order).rowsBetween(Window.unboundedPreceding, 0)
    sums = parts.withColumn("_sum", F.sum("points").over(upto)).withColumn(
        "_low", F.min("_sum").over(upto)
    )
    start = F.lit(0)
    if split:
        chunks = sums.groupBy(*USER, ordered.CHUNK).agg(
            F.sum("points").alias("_total"), F.min("_sum").alias("_chunk_low")
        )
        before = ordered.before_chunk(USER)
        start_sum = F.coalesce(F.sum("_total").over(before), F.lit(0))
        starts = (
            chunks.withColumn("_start_sum", start_sum)
            .withColumn("_lowest", F.min(F.col("_start_sum") + F.col("_chunk_low")).over(before))
            .select(
                *USER,
                ordered.CHUNK,
                (F.col("_start_sum") - F.least(F.lit(0), F.coalesce("_lowest", F.lit(0)))).alias("_start"),
            )
        )
        sums = ordered.join_on_keys(sums, starts, [*USER, ordered.CHUNK])
        start = F.col("_start")
    score = F.greatest(start + F.col("_sum"), F.col("_sum") - F.col("_low"))
    # A lowest sum above 0 never clamps: the start (0 or more) decides then.
    return sums.withColumn("score", score.cast("bigint")).select(*offences.columns, "score")


def user_stats(scored: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Current score per user; users without offences have no row."""
    last = F.max_by("score", F.struct(*order))
    return scored.groupBy("user_id").agg(last.alias("behavior_score"))


def recent_history(
    offences: DataFrame, stats: DataFrame, n: int = 5, order: Sequence[str] = ORDER
) -> DataFrame:
    """Last ``n`` offences per user, newest first, with display texts.

    ``stats`` holds the current score per user. Contents move for the rows that
    are shown only, as the scores come from a frame without them.
    """
    newest = [F.desc(c) for c in order]
    recent = top_per_key(offences, USER, newest, n, spread=("message_id", "seq"))
    when = minute_prefix(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    title = F.concat(when, F.lit(" | "), "offense", F.lit(" ("), signed("points"), F.lit(")"))
    return recent.join(stats, list(USER)).withColumn("title", title)


def offender_ledger(scored: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """One row per user: first seen name, current score, number of offences."""
    at = F.struct(*order)
    return scored.groupBy("user_id").agg(
        F.min_by("name", at).alias("name"),
        F.max_by("score", at).alias("behavior_score"),
        F.count(F.lit(1)).alias("n_offences"),
    )


def history_pages(
    offences: DataFrame,
    page_rows: int = 1000,
    order: Sequence[str] = ORDER,
    max_rows_per_key: int = ordered.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """The whole history of each user as arrays of at most ``page_rows`` entries.

    Pages bound the size of a row; page 0 holds the oldest entries.
    """
    parts, split = ordered.chunked(offences, USER, order, max_rows_per_key)
    placed = ordered.with_position(parts, split, USER, order)
    page = F.floor((F.col(ordered.POSITION) - 1) / page_rows)
    entry = F.struct(ordered.POSITION, "offense", "points", "content", "ts")
    pages = placed.groupBy("user_id", page.alias("page")).agg(
        F.array_sort(F.collect_list(entry)).alias("history")
    )
    return pages.withColumn(
        "history", F.transform("history", lambda e: e.dropFields(ordered.POSITION))
    )


def history_pages_by_bytes(
    offences: DataFrame,
    page_bytes: int = 1 << 20,
    order: Sequence[str] = ORDER,
    max_rows_per_key: int = ordered.MAX_ROWS_PER_KEY,
) -> DataFrame:
    """The whole history of each user as pages of at most ``page_bytes`` bytes of content.

    One row per page: user_id, first_position (of its first entry, from 1),
    n_bytes, history. Only an entry that is larger than half a page gets a page
    of its own, and only such an entry can exceed the bound. The others are cut
    where the running sum of their bytes passes a multiple of half a page: what
    starts within half a page, and is at most half a page long, fits into one.
    """
    size = F.coalesce(F.octet_length("content"), F.lit(0)).cast("bigint")
    parts, split = ordered.chunked(offences, USER, order, max_rows_per_key)
    big = F.col("_size") * 2 > page_bytes
    parts = parts.withColumn("_size", size)
    sums = {"_bigs": big.cast("bigint"), "_small": F.when(big, 0).otherwise(F.col("_size"))}
    placed = ordered.with_position(
        ordered.with_sums_before(parts, split, USER, order, sums), split, USER, order
    )
    half = F.floor(F.col("_small") * 2 / page_bytes)
    entry = F.struct(ordered.POSITION, "offense", "points", "content", "ts")
    pages = placed.groupBy("user_id", "_bigs", half.alias("_half"), big.alias("_own")).agg(
        F.min(ordered.POSITION).alias("first_position"),
        F.sum("_size").alias("n_bytes"),
        F.array_sort(F.collect_list(entry)).alias("history"),
    )
    without = F.transform("history", lambda e: e.dropFields(ordered.POSITION))
    return pages.select("user_id", "first_position", "n_bytes", without.alias("history"))
