"""Streams on finite input: same rows as the batch form, bounded state, late rows dropped."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import fraud, hype
from tidewatch.session import scratch_path
from tidewatch.sources import sinks, streams
from tidewatch.streaming import fraud as fraud_stream
from tidewatch.streaming import hype as hype_stream
from tidewatch.streaming import jobs
from tidewatch.streaming.running import drain, drain_until, replay, to_batches, to_files

START = datetime(2024, 1, 1)
SCHEMA = "user_id int, transaction_id string, amount double, event_time timestamp"


def transactions(spark, n=50):
    rows = [(i % 3, str(i), float(i), START + timedelta(minutes=i)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, table, build, closing=None):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "cp")
    writers = lambda s: to_files(build(s), out, checkpoint)
    replay(table, "event_time", writers, 2, timedelta(days=1), closing, rows_per_partition=25)
    return spark.read.parquet(out)


def test_fraud_stream_equals_batch(spark):
    txns = transactions(spark)
    got = run(spark, txns, fraud_stream.stream_fraud_features, closing={"user_id": -1})
    want = fraud.fraud_features(txns)
    columns = want.columns
    assert got.count() == want.count() > 100
    assert got.select(columns).exceptAll(want).count() == 0


def test_fraud_stream_drops_finished_state(spark):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "cp")
    removed = []

    def writer(stream):
        return to_files(fraud_stream.stream_fraud_features(stream), out, checkpoint)

    folder = scratch_path(spark, "in")
    for part in (transactions(spark), transactions(spark).withColumn("event_time", F.expr("event_time + INTERVAL 1 DAY"))):
        part.write.mode("append").parquet(folder)
        query = drain(writer(streams.event_source(spark, "parquet", schema=SCHEMA, path=folder)))
        removed += [op["numRowsRemoved"] for p in query.recentProgress for op in p["stateOperators"] if op["operatorName"] == "symmetricHashJoin"]
    assert sum(removed) > 0


def test_late_rows_are_dropped(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    late = [(0, "late", 1.0, START)]
    beat = [(9, "beat", 0.0, START + timedelta(days=2))]
    for rows in (transactions(spark), spark.createDataFrame(late, SCHEMA), spark.createDataFrame(beat, SCHEMA)):
        rows.write.mode("append").parquet(folder)
        stream = streams.event_source(spark, "parquet", schema=SCHEMA, path=folder)
        windows = fraud_stream.stream_user_features(stream).select("user_id", "window", "txn_count", "avg_amount")
        drain(to_files(windows, out, checkpoint))
    want = fraud.user_window_features(transactions(spark)).select("user_id", "window", "txn_count", "avg_amount")
    got = spark.read.parquet(out)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_hype_stream_equals_batch(spark):
    rows = [(START + timedelta(seconds=7 * i), float(i) if i % 2 else None, None if i % 2 else float(i % 4 == 0)) for i in range(60)]
    both = spark.createDataFrame(rows, "event_time timestamp, price double, sentiment_score double")
    sides = lambda df: (df.filter("sentiment_score IS NULL"), df.filter("price IS NULL"))
    got = run(spark, both, lambda s: hype_stream.stream_hype_meter(*sides(s)))
    want = hype.hype_meter(*sides(both))
    assert got.count() == want.count() > 10
    assert got.select(want.columns).exceptAll(want).count() == 0


def test_alert_messages_and_newest_alerts(spark):
    alerts = fraud.fraud_alerts(fraud.fraud_features(transactions(spark)), high_amount=20.0)
    order = ("event_time", "transaction_id", "window_start")
    path, checkpoint = scratch_path(spark, "newest"), scratch_path(spark, "cp")
    write = fraud_stream.newest_alerts_writer(path, order)

    def twice(batch, epoch):
        write(batch, epoch)
        write(batch, epoch)

    replay(alerts, "event_time", lambda s: to_batches(s, twice, checkpoint), slices=3)
    got = fraud_stream.read_newest_alerts(spark, path, order).select("transaction_id", "window_start").collect()
    want = fraud.latest_alerts(alerts).select("transaction_id", "window_start").collect()
    assert got == want and len(got) == 10
    value = fraud.alert_json(alerts.filter("transaction_id = '7'")).first().value
    assert value == '{"transaction_id":"7","user_id":1,"amount":7.0,"is_fraud_alert":false,"fraud_score":0.3}'


def test_json_topic_from_earliest_to_marker(spark):
    """Messages are decoded from a file source until the end marker arrives."""
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    messages = spark.range(10).select(F.to_json(F.struct("id", F.lit("x").alias("message"))).alias("value"))
    messages.coalesce(1).write.text(folder)
    decoded = streams.decode_json(streams.event_source(spark, "text", path=folder), "id bigint, message string")
    seen = []

    def on_batch(batch, epoch):
        sinks.epoch_writer(out)(batch, epoch)
        seen.append(batch.filter("id = 9").count())

    drain_until(to_batches(decoded, on_batch, checkpoint), lambda: sum(seen) > 0, timeout=60)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(10))


def test_two_sinks_for_one_result(spark):
    folder = scratch_path(spark, "in")
    transactions(spark, 3).write.parquet(folder)
    stream = streams.with_arrival_time(streams.event_source(spark, "parquet", schema=SCHEMA, path=folder))
    stored = scratch_path(spark, "out")
    drain(to_files(stream, stored, scratch_path(spark, "cp")))
    drain(sinks.console_writer(stream, scratch_path(spark, "cp")))
    times = spark.read.parquet(stored).select("event_time").distinct().collect()
    assert len(times) == 1 and times[0].event_time > START


def feed(spark, folder, rows, schema):
    df = spark.createDataFrame(rows, schema)
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(folder)


def test_fraud_job_from_messages_to_messages(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    schema = "user_id int, transaction_id string, amount double, timestamp string"
    text = lambda m: (START + timedelta(minutes=m)).isoformat(sep=" ")
    feed(spark, folder, [(1, "a", 600.0, text(3)), (1, "b", 20.0, text(8))], schema)
    spark.createDataFrame([("garbage",)], "value string").write.mode("append").text(folder)
    build = lambda: jobs.fraud_alert_messages(streams.event_source(spark, "text", path=folder))
    drain(to_files(build(), out, checkpoint))
    feed(spark, folder, [(9, "beat", 0.0, text(600))], schema)
    drain(to_files(build(), out, checkpoint))
    got = sorted(r.value for r in spark.read.parquet(out).collect())
    alert = '{"transaction_id":"%s","user_id":1,"amount":%s,"is_fraud_alert":%s,"fraud_score":%s}'
    assert got == sorted(
        [
            alert % ("a", "600.0", "true", "0.1"),
            alert % ("a", "600.0", "true", "0.2"),
            alert % ("b", "20.0", "false", "0.2"),
            alert % ("b", "20.0", "false", "0.1"),
        ]
    )


def test_hype_job_from_messages_to_keyed_table(spark):
    prices, posts, out, checkpoint = (scratch_path(spark, n) for n in ("p", "s", "table", "cp"))
    millis = lambda s: int((START + timedelta(seconds=s)).timestamp() * 1000)
    price_schema, social_schema = "symbol string, price double, timestamp bigint", "username string, text string, timestamp bigint"
    feed(spark, prices, [("B", 100.0, millis(0)), ("B", 102.0, millis(5)), ("B", 110.0, millis(12))], price_schema)
    feed(spark, posts, [("u", "to the moon", millis(3)), ("u", "crash", millis(9)), ("u", "win", millis(25))], social_schema)

    def run_once():
        rows = jobs.hype_meter_rows(
            streams.event_source(spark, "text", path=prices), streams.event_source(spark, "text", path=posts)
        )
        for writer in jobs.hype_writers(rows, sinks.epoch_writer(out), checkpoint):
            drain(writer)

    run_once()
    feed(spark, prices, [("B", 0.0, millis(900))], price_schema)
    feed(spark, posts, [("u", "", millis(900))], social_schema)
    run_once()
    schema = "time timestamp, avg_price double, hype_score double, epoch bigint"
    table = sinks.latest_per_key(sinks.read_epochs(spark, out, schema), ["time"])
    assert [(r.avg_price, r.hype_score) for r in table.collect()] == [(101.0, 0.5)]


def test_sinks_outlive_a_new_checkpoint(spark):
    """A second run with a checkpoint of its own adds to what the first one stored."""
    from tidewatch.session import scratch_path
    from tidewatch.streaming import behavior as behavior_stream
    from tidewatch.streaming.running import drain, to_batches

    schema = "user_id string, name string, ts int, message_id int, seq int, offense string, points int, content string"
    scores, best = scratch_path(spark, "scores"), scratch_path(spark, "alerts")
    for run, points in enumerate((15, 1)):
        inbox = scratch_path(spark, "inbox")
        rows = [("u", "n", run, run, 0, "x", points, "c")]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        drain(to_batches(stream, behavior_stream.score_writer(scores), scratch_path(spark, "c")))
        alerts = stream.select("message_id", (F.col("points") > 0).alias("is_fraud_alert"))
        drain(to_batches(alerts, fraud_stream.newest_alerts_writer(best, ("message_id",)), scratch_path(spark, "c")))
    assert [tuple(r) for r in behavior_stream.current_scores(spark, scores).collect()] == [("u", 16)]
    shown = fraud_stream.read_newest_alerts(spark, best, ("message_id",)).collect()
    assert [r.message_id for r in shown] == [1, 0]


def test_drain_until_raises(spark):
    from tidewatch.session import scratch_path

    stream = spark.readStream.format("rate").load()
    with pytest.raises(TimeoutError):
        drain_until(to_batches(stream, lambda b, e: None, scratch_path(spark, "c")), lambda: False, timeout=2)

    def fails(batch, epoch):
        raise ValueError("no")

    with pytest.raises(Exception, match="no"):
        drain_until(to_batches(stream, fails, scratch_path(spark, "c")), lambda: False)


OFFENCES = "user_id string, ts int, message_id int, seq int, points int"


def plain_scores(rows):
    scores = {}
    for user, *_, points in rows:
        if user is not None:
            score, n = scores.get(user, (0, 0))
            scores[user] = (max(0, score + points), n + 1)
    return {u: (u, *s) for u, s in scores.items()}


def test_scores_in_the_state_go_on_after_restarts(spark):
    """Every micro-batch is a new start from the checkpoint; the input of earlier ones is gone by then."""
    import random
    from pathlib import Path

    from tidewatch.session import scratch_path
    from tidewatch.streaming import behavior as behavior_stream

    rng = random.Random(10)
    rows = [(rng.choice(["a", "b", "c", None]), t, t, 0, rng.choice([-9, -2, 1, 4, 15])) for t in range(200)]
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "c")
    for k in range(4):
        part = rows[50 * k : 50 * k + 50]
        mixed = spark.createDataFrame(rng.sample(part, 50), OFFENCES).repartition(3)
        mixed.write.mode("append").parquet(inbox)
        stream = behavior_stream.stream_scores(spark.readStream.schema(OFFENCES).parquet(inbox))
        query = stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        drain(query)
        got = behavior_stream.read_scores(spark, checkpoint).collect()
        assert {r.user_id: tuple(r) for r in got} == plain_scores(rows[: 50 * k + 50])
        for f in Path(inbox.removeprefix("file:")).glob("part-*"):
            f.write_bytes(b"")  # an old file that is read again would fail the query
    # A new checkpoint takes the scores over.
    scores = behavior_stream.read_scores(spark, checkpoint)
    again, other = scratch_path(spark, "inbox"), scratch_path(spark, "c")
    more = [("a", 1, 1, 0, 7), ("new", 1, 2, 0, -3), ("new", 2, 3, 0, 2)]
    spark.createDataFrame(more, OFFENCES).write.parquet(again)
    stream = behavior_stream.stream_scores(spark.readStream.schema(OFFENCES).parquet(again), initial=scores)
    drain(stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", other))
    want = plain_scores(rows)
    want = {u: (u, s + 7 if u == "a" else s, n + (u == "a")) for u, (_, s, n) in want.items()} | {"new": ("new", 2, 2)}
    assert {r.user_id: tuple(r) for r in behavior_stream.read_scores(spark, other).collect()} == want
