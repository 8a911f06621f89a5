"""Radix selection against numpy, and the area under the curve against its definition."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import moderation, profiling
from tidewatch.operators.quantiles import order_key, quantiles

FRACTIONS = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
WILD = [0.0, -0.0, 5e-324, -5e-324, 1e308, -1e308, 1.5, 1.5, 1.5, -2.25, math.pi, 1e-300, float("inf"), -1e-5]


def test_order_key_sorts_as_doubles(spark):
    rows = spark.createDataFrame([(x,) for x in WILD], "x double")
    kind = rows.schema["x"].dataType
    keyed = rows.select("x", order_key(F.col("x"), kind).alias("k")).collect()
    for a in keyed:
        for b in keyed:
            assert (a.x < b.x) == (a.k < b.k) and (a.x == b.x) == (a.k == b.k)


@pytest.mark.parametrize("kind", ["double", "float", "bigint", "int", "decimal(12,3)"])
def test_quantiles_per_group_are_numpys(spark, kind):
    rng = random.Random(kind)
    make = {
        "double": lambda: rng.choice([rng.gauss(0, 1e6), rng.gauss(0, 1e-9), 7.0]),
        "float": lambda: float(np.float32(rng.gauss(0, 10))),
        "bigint": lambda: rng.choice([rng.randrange(-(2**62), 2**62), 3]),
        "int": lambda: rng.randrange(-50, 50),
        "decimal(12,3)": lambda: Decimal(rng.randrange(-(10**6), 10**6)) / 1000,
    }[kind]
    rows = [(rng.choice(["a", "b", None]), make()) for _ in range(700)] + [("one", make()), ("none", None), ("a", None)]
    df = spark.createDataFrame(rows, f"g string, x {kind}")
    got = {r.g: r for r in quantiles(df, "x", FRACTIONS, by=("g",)).collect()}
    assert set(got) == {"a", "b", None, "one"}
    for g, r in got.items():
        values = np.array([float(x) for h, x in rows if h == g and x is not None])
        assert r.n == len(values)
        want = np.quantile(values, FRACTIONS)
        assert np.allclose(r.q, want, rtol=1e-12, atol=1e-300)
    whole = quantiles(df, "x", FRACTIONS).first()
    assert np.allclose(whole.q, np.quantile([float(x) for _, x in rows if x is not None], FRACTIONS), rtol=1e-12)


def test_wild_doubles_nan_and_nothing(spark):
    df = spark.createDataFrame([(x,) for x in [*WILD, float("nan"), None]], "x double")
    ranks = [k / (len(WILD) - 1) for k in range(len(WILD))]
    r = quantiles(df, "x", ranks).first()
    assert r.n == len(WILD) and list(r.q) == sorted(WILD)
    assert quantiles(df.filter("x < -1.5e308"), "x", (0.5,)).count() == 0
    stats = profiling.describe(df.filter("isnan(x)"), "x").first()
    assert tuple(stats) == (0, None, None, None, None, None, None, None)
    with pytest.raises(TypeError):
        quantiles(df.selectExpr("cast(x AS string) AS x"), "x", (0.5,))


def test_no_buffer_holds_the_values(spark, capsys):
    df = spark.range(100).selectExpr("id % 3 AS g", "rand(1) AS x")
    quantiles(df, "x", (0.5,), by=("g",)).explain()
    assert "percentile" not in capsys.readouterr().out.lower()


def brute_auc(rows):
    good = [s for y, s in rows if y]
    bad = [s for y, s in rows if not y]
    if not good or not bad:
        return None
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.mark.parametrize("case", ["ties", "many", "one class", "empty", "equal"])
def test_auc(spark, case):
    rng = random.Random(3)
    rows = {
        "ties": [(rng.randrange(2), rng.randrange(8) / 8) for _ in range(300)],
        "many": [(rng.randrange(2), rng.random()) for _ in range(500)],
        "one class": [(1, 0.5)],
        "empty": [],
        "equal": [(0, 0.3), (1, 0.3)] * 5,
    }[case]
    extra = [(None, 0.5), (1, None), (1, float("nan"))] if case == "ties" else []
    df = spark.createDataFrame(rows + extra, "true_label int, prob_violation double")
    got = moderation.auc(df).collect()
    want = brute_auc(rows)
    assert len(got) == 1 and (got[0].auc is None if want is None else got[0].auc == pytest.approx(want, abs=1e-15))


def test_auc_runs_nothing_while_it_is_built(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.4)], "true_label int, prob_violation double")
    broken = df.withColumn("prob_violation", F.raise_error(F.lit("read")).cast("double"))
    spark.sparkContext.setJobGroup("building", "auc")
    try:
        moderation.auc(broken)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
