"""Time expressions. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def parse_event_time(text) -> Column:
    """Text to timestamp: ISO forms, else epoch seconds, else null."""
    text = _col(text)
    seconds = text.try_cast("double")
    micros = F.round(seconds * F.lit(1e6)).try_cast("bigint")
    return F.coalesce(
        F.when(seconds.isNull(), text.try_cast("timestamp")), F.timestamp_micros(micros)
    )


def from_epoch_millis(millis) -> Column:
    return F.timestamp_millis(_col(millis))


def epoch_seconds(ts) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))


def bucket_seconds(ts, width: int = 10) -> Column:
    """Start of the ``width``-second bucket, in epoch seconds."""
    seconds = epoch_seconds(ts)
    return seconds - F.pmod(seconds, F.lit(width))


def bucket_start(ts, width: int = 10) -> Column:
    """Start of the bucket as a timestamp."""
    return F.timestamp_seconds(bucket_seconds(ts, width))


def minute_prefix(ts_text) -> Column:
    return F.substring(_col(ts_text), 1, 16)
