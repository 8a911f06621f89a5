"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_number(text) -> Column:
    """Text to double; anything else becomes null (NaN too)."""
    return nan_to_null(_col(text).try_cast("double"))


def nan_to_null(value) -> Column:
    value = _col(value)
    return F.when(~F.isnan(value), value)


def softmax(logits) -> Column:
    """Softmax of an array of logits, shifted by the maximum so exp never overflows."""
    logits = _col(logits)
    exps = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(exps, lambda e: e / total)


def positive_probability(logits) -> Column:
    """Probability of class 1."""
    return F.element_at(softmax(logits), 2)


def signed(number) -> Column:
    return F.format_string("%+d", _col(number))


def dollars(amount) -> Column:
    return F.concat(F.lit("$"), F.format_number(_col(amount), 2))


def map_get(mapping, key: str, default) -> Column:
    """Value of a key, or the default where map or key is missing."""
    return F.coalesce(F.try_element_at(_col(mapping), F.lit(key)), F.lit(default))
