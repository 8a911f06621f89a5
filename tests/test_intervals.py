"""Interval join against all pairs, pages by bytes, and class shares of the split against plain Python."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import behavior, moderation
from tidewatch.operators.intervals import interval_join
from tidewatch.session import scratch_path
from tidewatch.streaming.running import replay, to_files

START = datetime(2024, 3, 1)
SEC = timedelta(seconds=1)


def sides(spark, rng, n=120, span=400):
    at = lambda: START + timedelta(microseconds=rng.randrange(span * 10**6)) if rng.random() > 0.2 else START + rng.randrange(span) * SEC
    left = [(i, rng.choice(["a", "b", None]), at()) for i in range(n)] + [(900, "a", None), (901, "a", START), (901, "a", START)]
    right = [(i, rng.choice(["a", "b", None]), at()) for i in range(n)] + [(900, "a", None)] + [(902 + i, "a", START + i * SEC) for i in range(-12, 13)]
    return (
        (left, spark.createDataFrame(left, "l int, k string, lt timestamp")),
        (right, spark.createDataFrame(right, "r int, k string, rt timestamp")),
    )


def plain(left, right, before, after, keyed):
    return sorted(
        (a, b)
        for a, k, t in left
        for b, j, u in right
        if t and u and t - before <= u <= t + after and (not keyed or (k is not None and k == j))
    )


@pytest.mark.parametrize(("before", "after"), [(10, 10), (0, 5), (7.25, 0.5), (-3, 8), (0, 0), (4, -6)])
def test_interval_join_is_all_pairs(spark, before, after):
    rng = random.Random(int(before * 4 + after))
    (left, l), (right, r) = sides(spark, rng)
    bounds = timedelta(seconds=before), timedelta(seconds=after)
    got = interval_join(l, r, "lt", "rt", *bounds, keys=("k",))
    assert got.columns == ["l", "k", "lt", "r", "rt"]
    assert sorted((x.l, x.r) for x in got.collect()) == plain(left, right, *bounds, True)
    got = interval_join(l, r.drop("k"), "lt", "rt", *bounds)
    assert sorted((x.l, x.r) for x in got.collect()) == plain(left, right, *bounds, False)


def test_interval_join_has_equal_bins_and_no_cross_product(spark, capsys):
    (_, l), (_, r) = sides(spark, random.Random(1))
    interval_join(l, r.drop("k"), "lt", "rt", SEC, SEC).explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError, match="k"):
        interval_join(l, r, "lt", "rt", SEC, SEC)


def test_interval_join_of_streams_drops_its_state(spark):
    rng = random.Random(9)
    (left, l), (right, r) = sides(spark, rng, span=4000)
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    both = l.filter("lt IS NOT NULL").select("l", none("r", "int"), F.col("lt").alias("t")).unionByName(
        r.filter("rt IS NOT NULL").select(none("l", "int"), "r", F.col("rt").alias("t"))
    )
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "c")

    def build(s):
        a = s.filter("r IS NULL").select("l", F.col("t").alias("lt"))
        b = s.filter("l IS NULL").select("r", F.col("t").alias("rt"))
        return to_files(interval_join(a, b, "lt", "rt", 10 * SEC, 5 * SEC, delay="5 seconds"), out, checkpoint)

    replay(both, "t", build, 3, timedelta(days=1))
    got = sorted((x.l, x.r) for x in spark.read.parquet(out).filter("l IS NOT NULL").collect())
    assert got == plain(left, right, 10 * SEC, 5 * SEC, False)
    kept = spark.read.format("statestore").option("joinSide", "left").load(checkpoint).count()
    assert kept < 20  # of some hundred rows


def test_bounds_are_worked_out_per_row_and_not_per_pair(spark, capsys):
    (_, l), (_, r) = sides(spark, random.Random(1))
    interval_join(l, r.drop("k"), "lt", "rt", SEC, SEC).explain()
    joins = [x for x in capsys.readouterr().out.splitlines() if "Join" in x]
    assert joins and not any("INTERVAL" in x for x in joins)


def test_rows_of_a_bin_go_into_the_state_in_packs(spark):
    rng = random.Random(2)
    at = lambda: START + timedelta(microseconds=rng.randrange(15 * 10**6))
    rows = [(i if i % 2 else None, None if i % 2 else i, at()) for i in range(3000)]
    both = spark.createDataFrame(rows, "l int, r int, t timestamp")
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "c")

    def build(s):
        a = s.filter("l IS NOT NULL").select("l", F.col("t").alias("lt"))
        b = s.filter("r IS NOT NULL").select("r", F.col("t").alias("rt"))
        return to_files(interval_join(a, b, "lt", "rt", 10 * SEC, 5 * SEC, delay="5 seconds"), out, checkpoint)

    replay(both, "t", build, 1, SEC)
    found = spark.read.parquet(out)
    left, right = [(x, None, t) for x, _, t in rows if x is not None], [(x, None, t) for _, x, t in rows if x is not None]
    assert found.columns == ["l", "lt", "r", "rt"]
    assert sorted((x.l, x.r) for x in found.select("l", "r").collect()) == plain(left, right, 10 * SEC, 5 * SEC, False)
    kept = spark.read.format("statestore").option("joinSide", "left").load(checkpoint).count()
    assert 0 < kept < 30  # of some 3000 entries of rows and bins


OFFENCES = "user_id string, name string, ts int, message_id int, seq int, offense string, points int, content string"


@pytest.mark.parametrize("split", [None, 10])
@pytest.mark.parametrize("limit", [1, 40, 1000])
def test_pages_never_exceed_their_bytes(spark, limit, split):
    rng = random.Random(limit)
    rows = [
        (rng.choice(["a", "a", "b", None]), "n", t, t, 0, f"o{t}", 1, rng.choice(["é" * rng.randrange(30), "x" * rng.randrange(60), "", None]))
        for t in range(300)
    ]
    df = spark.createDataFrame(rows, OFFENCES)
    pages = behavior.history_pages_by_bytes(df, limit, max_rows_per_key=split).collect()
    size = lambda e: len((e.content or "").encode())
    for user in ("a", "b", None):
        mine = sorted((p for p in pages if p.user_id == user), key=lambda p: p.first_position)
        told = [e.offense for p in mine for e in p.history]
        assert told == [r[5] for r in rows if r[0] == user]
        at = 1
        for p in mine:
            assert p.first_position == at and p.n_bytes == sum(map(size, p.history))
            assert p.n_bytes <= limit or len(p.history) == 1
            at += len(p.history)
        # Neighbouring pages could not all be one: fewer than four per bound of bytes, apart from large entries.
        large = sum(size(e) * 2 > limit for p in mine for e in p.history)
        assert len(mine) <= 2 * large + 1 + 2 * sum(p.n_bytes for p in mine) // limit + 1


def test_validation_shares_of_many_classes(spark):
    rng = random.Random(4)
    counts = {f"c{i}": rng.randrange(1, 9) for i in range(300)}
    sizes = spark.createDataFrame(list(counts.items()), "_label string, n bigint").repartition(7)
    got = {r._label: r.need for r in moderation._validation_counts(sizes, 0.2).collect()}
    total = sum(counts.values())
    wanted = math.ceil(0.2 * total)
    shares = {k: wanted * n / total for k, n in counts.items()}
    need = {k: math.floor(x) for k, x in shares.items()}
    for k in sorted(shares, key=lambda k: (need[k] - shares[k], k))[: wanted - sum(need.values())]:
        need[k] += 1
    assert got == need and sum(got.values()) == wanted
