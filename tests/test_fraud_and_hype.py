from datetime import datetime as D

from pyspark.sql import functions as F

from tidewatch.functions import temporal
from tidewatch.operators import fraud, hype
from tidewatch.sources.streams import decode_json, with_payload_time, PRICE_SCHEMA


def at(minute, second=0, day=2):
    return D(2024, 1, day, 0, minute, second)


def transactions(spark):
    rows = [
        (1, "a", 600.0, at(3)),
        (1, "b", 20.0, at(10)),
        (1, "c", None, at(12)),
        (None, "d", 900.0, at(12)),
        (1, "e", 5.0, None),
    ]
    return spark.createDataFrame(rows, "user_id int, transaction_id string, amount double, event_time timestamp_ntz")


def test_alerts_of_the_fixture(spark):
    alerts = fraud.fraud_alerts(fraud.fraud_features(transactions(spark)))
    got = sorted(
        (r.transaction_id, r.window_start, r.txn_count, r.avg_amount, r.is_fraud_alert, r.fraud_score)
        for r in alerts.collect()
    )
    before = D(2024, 1, 1, 23, 55)
    assert got == sorted(
        [
            ("a", before, 1, 600.0, True, 0.1),
            ("a", at(0), 1, 600.0, True, 0.1),
            ("b", at(0), 1, 600.0, False, 0.1),
            ("b", at(5), 2, 20.0, False, 0.2),
            ("b", at(10), 2, 20.0, False, 0.2),
            ("c", at(5), 2, 20.0, False, 0.2),
            ("c", at(10), 2, 20.0, False, 0.2),
        ]
    )


def test_features_equal_the_range_join(spark):
    rows = [
        (i % 3, str(i), float(i * 7 % 50), at(i * 37 % 60, 0 if i % 4 else i % 60)) for i in range(120)
    ]
    txns = spark.createDataFrame(rows, "user_id int, transaction_id string, amount double, event_time timestamp")
    for window_s, slide_s in ((600, 300), (900, 300), (300, 300)):
        t = txns.alias("t")
        w = fraud.user_window_features(txns, window_s, slide_s).alias("w")
        by_range = t.join(
            w,
            (F.col("t.user_id") == F.col("w.user_id"))
            & (F.col("t.event_time") >= F.col("w.window.start"))
            & (F.col("t.event_time") <= F.col("w.window.end")),
        ).select("t.transaction_id", "w.window.start", "w.txn_count", F.round("w.avg_amount", 9).alias("a"))
        got = fraud.fraud_features(txns, window_s, slide_s).select(
            "transaction_id", "window_start", "txn_count", F.round("avg_amount", 9)
        )
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, by_range.collect()))


def test_one_alert_per_transaction(spark):
    alerts = fraud.fraud_alerts(fraud.fraud_features(transactions(spark)))
    best = {r.transaction_id: r.fraud_score for r in fraud.one_alert_per_transaction(alerts).collect()}
    assert best == {"a": 0.1, "b": 0.2, "c": 0.2}


def test_null_operands_never_flag(spark):
    rows = spark.createDataFrame([(None, 1), (None, 9), (501.0, None), (500.0, 5)], "amount double, txn_count bigint")
    flags = [r.is_fraud_alert for r in fraud.fraud_alerts(rows).collect()]
    assert flags == [False, True, True, False]


def test_decode(spark):
    raw = spark.createDataFrame(
        [("garbage",), ('{"user_id":1,"amount":"x","more":2}',), ('{"user_id":2,"timestamp":"1733047200.123"}',)],
        "value string",
    )
    rows = fraud.transactions_from_json(decode_json(raw, fraud.TRANSACTION_SCHEMA)).collect()
    assert tuple(rows[0]) == (None, None, None, None)
    assert (rows[1].user_id, rows[1].amount) == (1, None)
    stamp = spark.range(1).select(
        F.date_format(temporal.parse_event_time(F.lit("1733047200.123")), "yyyy-MM-dd HH:mm:ss.SSS").alias("t")
    )
    assert stamp.first().t == "2024-12-01 10:00:00.123"
    assert rows[2].event_time is not None


def test_payload_time(spark):
    raw = spark.createDataFrame([('{"symbol":"X","price":1.5,"timestamp":1733047200123}',)], "value string")
    row = with_payload_time(decode_json(raw, PRICE_SCHEMA)).select(
        F.date_format("event_time", "HH:mm:ss.SSS").alias("t"), "price"
    )
    assert tuple(row.first()) == ("10:00:00.123", 1.5)


def hype_sides(spark):
    prices = spark.createDataFrame(
        [(100.0, at(0)), (102.0, at(0, 5)), (110.0, at(0, 12))], "price double, event_time timestamp_ntz"
    )
    social = spark.createDataFrame(
        [(1.0, at(0, 3)), (0.0, at(0, 9)), (1.0, at(0, 25))], "sentiment_score double, event_time timestamp_ntz"
    )
    return prices, social


def test_hype_meter_of_the_fixture(spark):
    pairs = hype.hype_pairs(*hype_sides(spark)).collect()
    assert [(r.time, r.avg_price, r.hype_score, r.n_pairs) for r in pairs] == [(at(0), 101.0, 0.5, 4)]


def test_hype_averages_are_those_of_the_pairs(spark):
    """With nulls on both sides too, the averages equal those over all pairs."""
    prices = spark.createDataFrame(
        [(None if i % 5 == 0 else float(i), at(i % 2, i % 60)) for i in range(90)],
        "price double, event_time timestamp_ntz",
    )
    social = spark.createDataFrame(
        [(None if i % 7 == 0 else float(i % 2), at(i % 3, i * 7 % 60)) for i in range(80)],
        "sentiment_score double, event_time timestamp_ntz",
    )
    bucket = lambda: temporal.bucket_start("event_time").cast("timestamp_ntz").alias("time")
    joined = prices.select(bucket(), "price").join(social.select(bucket(), "sentiment_score"), "time")
    want = joined.groupBy("time").agg(F.round(F.avg("price"), 9), F.round(F.avg("sentiment_score"), 9))
    got = hype.hype_meter(prices, social).select("time", F.round("avg_price", 9), F.round("hype_score", 9))
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_latest_hype_is_ascending(spark):
    rows = spark.createDataFrame([(at(i), float(i), 0.0) for i in range(9)], "time timestamp_ntz, avg_price double, hype_score double")
    assert [r.avg_price for r in hype.latest_hype(rows, 3).collect()] == [6.0, 7.0, 8.0]
    assert hype.current_metric(rows).first().avg_price == 8.0


def test_buckets_before_the_epoch(spark):
    t = spark.createDataFrame([(D(1969, 12, 31, 23, 59, 55),)], "t timestamp_ntz")
    assert t.select(temporal.bucket_seconds("t").alias("b")).first().b == -10
