"""Profiles of a labelled table.

Quantiles are exact and found by radix selection, so a continuous column is no
harder than a length: no buffer ever holds its distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.ordered import join_on_keys
from tidewatch.operators.quantiles import quantiles

QUARTILES = (0.25, 0.5, 0.75)


def table_profile(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, in one pass."""
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot([], df.columns, "column_name", "non_null")
    kind = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return long.select("column_name", kind[F.col("column_name")].alias("data_type"), "non_null")


def preview(df: DataFrame, columns: list[str], key: str, n: int = 5) -> DataFrame:
    return df.select(*columns).orderBy(key).limit(n)


def distinct_count(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approx else F.count_distinct(column)
    return df.agg(count.alias(f"distinct_{column}"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def class_balance(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Share of each value in percent."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, digits))


def imbalance_ratio(df: DataFrame, column: str) -> DataFrame:
    """``"<percent of 0> : <percent of 1>"`` of a 0/1 column, without nulls."""
    ones = F.avg(F.col(column).cast("double")) * 100
    text = F.format_string("%.2f : %.2f", 100 - F.col("ones"), F.col("ones"))
    return df.agg(ones.alias("ones")).select(text.alias("ratio"))


def violation_rate(df: DataFrame, group: str, target: str) -> DataFrame:
    return (
        df.groupBy(group)
        .agg(F.count(target).alias("total_samples"), F.avg(target).alias("violation_rate"))
        .orderBy(F.desc("violation_rate"), group)
    )


def length_histogram_table(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Rows per distinct value (and group)."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def _numbers(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Rows with a value; NaN is none."""
    rows = df.select(*by, value).filter(F.col(value).isNotNull())
    return rows.filter(~F.isnan(value)) if dict(df.dtypes)[value] in ("float", "double") else rows


def describe(df: DataFrame, value: str) -> DataFrame:
    """count, mean, sample deviation, min, quartiles (interpolated), max of any numeric column.

    Nulls and NaN do not count; all but the count are null if nothing is left.
    """
    rows = _numbers(df, value)
    q = quantiles(rows, value, QUARTILES).select("q").scalar()
    x = F.col(value).cast("double")
    stats = rows.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = [q[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return stats.select("count", "mean", "std", "min", *quartiles, "max")


def histogram(df: DataFrame, value: str, label: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over all rows, counted per label; the last bin is closed."""
    counts = length_histogram_table(df, value, label)
    span = counts.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = span["lo"], span["hi"]
    raw = F.when(hi > lo, F.floor((F.col(value) - lo) * bins / (hi - lo))).otherwise(F.lit(0))
    return (
        counts.withColumn("bin", F.least(F.lit(bins - 1), raw).cast("int"))
        .groupBy(label, "bin")
        .agg(F.sum("n").alias("n"))
    )


def box_statistics(df: DataFrame, value: str, label: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outlier count per label, of any numeric column."""
    rows = _numbers(df, value, label)
    boxes = quantiles(rows, value, QUARTILES, by=(label,)).drop("n")
    q1, q3 = F.col("q")[0], F.col("q")[2]
    reach = (q3 - q1) * 1.5
    return (
        join_on_keys(rows, boxes.withColumns({"_low": q1 - reach, "_high": q3 + reach}), [label])
        .withColumn("_in", F.col(value).between(F.col("_low"), F.col("_high")))
        .groupBy(label)
        .agg(
            F.min(F.when(F.col("_in"), F.col(value))).alias("whisker_low"),
            F.max(F.when(F.col("_in"), F.col(value))).alias("whisker_high"),
            F.count_if(~F.col("_in")).alias("outliers"),
        )
        .transform(lambda found: join_on_keys(found, boxes, [label]))
        .select(
            label,
            q1.alias("q1"),
            F.col("q")[1].alias("median"),
            q3.alias("q3"),
            "whisker_low",
            "whisker_high",
            "outliers",
        )
    )
