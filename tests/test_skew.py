"""Hot keys: the split forms give the plain results, and joins are split."""

import random

from pyspark.sql import functions as F

from tidewatch.operators import behavior, lookups, ordered, timeseries
from tidewatch.streaming import behavior as behavior_stream


def offences(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.6 else f"u{rng.randrange(4)}"
        rows.append((user, f"{user}-{i % 3}", i // 3, i, 0, rng.choice(["Toxicity", "Manual Pardon"]), rng.randint(-4, 4), f"c{i}"))
    schema = "user_id string, name string, ts int, message_id int, seq int, offense string, points int, content string"
    return spark.createDataFrame(rows, schema), rows


def fold(rows):
    scores, out = {}, {}
    for r in sorted(rows, key=lambda r: r[2:5]):
        scores[r[0]] = max(0, scores.get(r[0], 0) + r[6])
        out[r[3]] = scores[r[0]]
    return scores, out


def test_behavior_score_is_the_fold(spark):
    df, rows = offences(spark)
    _, want = fold(rows)
    for limit in (10**6, 20):
        got = {r.message_id: r.score for r in behavior.behavior_score(df, max_rows_per_key=limit).collect()}
        assert got == want


def test_score_cases(spark):
    def last(points):
        rows = [("u", "n", i, i, 0, "x", p, "") for i, p in enumerate(points)]
        df = spark.createDataFrame(rows, "user_id string, name string, ts int, message_id int, seq int, offense string, points int, content string")
        return [r.score for r in behavior.behavior_score(df).orderBy("ts").collect()]

    assert last([3, -5, 1, 5]) == [3, 0, 1, 6]
    assert last([1, -1]) == [1, 0]
    assert last([-2, -2, 7]) == [0, 0, 7]


def test_streamed_steps_compose(spark):
    df, rows = offences(spark, 200, seed=3)
    want, _ = fold(rows)
    for limit in (10**6, 15):
        path = behavior_stream_path(spark)
        write = behavior_stream.score_writer(path, max_rows_per_key=limit)
        for epoch, (low, high) in enumerate([(0, 80), (80, 81), (81, 200)]):
            part = df.filter(F.col("message_id").between(low, high - 1))
            write(part, epoch)
            write(part, epoch)  # a repeated batch replaces its own output
        got = {r.user_id: r.behavior_score for r in behavior_stream.current_scores(spark, path).collect()}
        assert got == want


def behavior_stream_path(spark):
    from tidewatch.session import scratch_path

    return scratch_path(spark, "test-scores")


def test_positions_and_pages(spark):
    df, rows = offences(spark)
    for limit in (10**6, 25):
        parts, split = ordered.chunked(df, ["user_id"], behavior.ORDER, limit, chunks=6)
        assert split == (limit == 25)
        placed = ordered.with_position(parts, split, ["user_id"], behavior.ORDER).collect()
        by_user = {}
        for r in sorted(placed, key=lambda r: r[ordered.POSITION]):
            by_user.setdefault(r.user_id, []).append(r.message_id)
        assert by_user == {
            u: [r[3] for r in sorted(rows, key=lambda r: r[2:5]) if r[0] == u] for u in by_user
        }
        pages = behavior.history_pages(df, 7, max_rows_per_key=limit).collect()
        assert max(len(p.history) for p in pages) == 7
        flat = [e.content for p in sorted(pages, key=lambda p: p.page) if p.user_id == "hot" for e in p.history]
        assert flat == [r[7] for r in sorted(rows, key=lambda r: r[2:5]) if r[0] == "hot"]


def test_chunks_follow_the_rows_and_not_the_bound(spark, monkeypatch):
    df, _ = offences(spark)
    count = lambda: ordered.chunked(df, ["user_id"], behavior.ORDER, 2)[0].select(ordered.CHUNK).distinct().count()
    assert 1 < count() <= 4  # shuffle partitions of the tests; 200 by the bound
    monkeypatch.setattr(ordered, "LEAST_CHUNK", 20)
    assert 10 < count() <= 20


def bars(spark, n=300, seed=5):
    rng = random.Random(seed)
    rows = [
        ("hot" if rng.random() < 0.7 else "cold", i // 2, i, None if rng.random() < 0.15 else rng.randint(0, 9) / 4)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "symbol string, ts int, bar_id int, close double")


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_rolling_blocks_equal_plain_windows(spark):
    df = bars(spark)
    for n in (3, 20):
        plain = timeseries.moving_average(df, n)
        split = timeseries.moving_average(df, n, max_rows_per_key=40)
        assert rows_of(plain) == rows_of(split.select(plain.columns))


def test_daily_return_across_chunks(spark):
    df = bars(spark)
    plain = timeseries.daily_return(df)
    split = timeseries.daily_return(df, max_rows_per_key=12)
    assert rows_of(plain) == rows_of(split.select(plain.columns))


def test_series_cases(spark):
    df = spark.createDataFrame(
        [("s", i, i, v) for i, v in enumerate([10.0, 12.0, None, 15.0, 0.0, 3.0])],
        "symbol string, ts int, bar_id int, close double",
    )
    returns = [r.daily_return for r in timeseries.daily_return(df).orderBy("ts").collect()]
    assert returns[0] is None and returns[5] == float("inf")
    assert [round(x, 9) for x in returns[1:5]] == [0.2, 0.0, 0.25, -1.0]
    ramp = spark.createDataFrame([("s", i, i, float(i + 1)) for i in range(4)], df.schema)
    assert [r.sma_3 for r in timeseries.moving_average(ramp, 3).orderBy("ts").collect()] == [None, None, 2.0, 3.0]


def test_top_per_key(spark):
    df, rows = offences(spark)
    got = lookups.top_per_key(df, ["user_id"], [F.desc("message_id")], 5, spread=("message_id",), slices=4)
    hot = [r.message_id for r in got.filter("user_id = 'hot'").orderBy("rank").collect()]
    assert hot == sorted((r[3] for r in rows if r[0] == "hot"), reverse=True)[:5]


def test_null_keys_survive_the_split(spark):
    df, rows = offences(spark)
    orphan = [(None, "nobody", i, 1000 + i, 0, "x", 2 - i, "c") for i in range(9)]
    both = df.union(spark.createDataFrame(orphan, df.schema))
    for make in (behavior.behavior_score, behavior.history_pages):
        whole, split = (sorted(map(str, make(both, max_rows_per_key=n).collect())) for n in (10**6, 20))
        assert whole == split and any("None" in r for r in whole)
    bars = both.select(F.col("user_id").alias("symbol"), "ts", F.col("message_id").alias("bar_id"), F.col("points").cast("double").alias("close"))
    for make in (timeseries.daily_return, lambda b, max_rows_per_key: timeseries.moving_average(b, 3, max_rows_per_key=max_rows_per_key)):
        whole, split = (sorted(map(str, make(bars, max_rows_per_key=n).collect())) for n in (10**6, 40))
        assert whole == split and len(whole) == 409


def test_hot_step_is_split_by_adaptive_execution(spark):
    """One user and step with most rows: the feature join splits it."""
    from tidewatch.operators import fraud

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        user = F.when(F.col("id") % 10 < 7, F.lit(1)).otherwise(F.col("id").cast("int"))
        txns = spark.range(0, 40_000, 1, 8).select(
            user.alias("user_id"),
            F.col("id").cast("string").alias("transaction_id"),
            F.lit(1.0).alias("amount"),
            F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 60).alias("event_time"),
        )
        features = fraud.fraud_features(txns)
        rows = features.count()
        features.write.format("noop").mode("overwrite").save()
        done = fraud.fraud_features(txns)
        done.collect()
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert rows == 40_000 * 2
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
