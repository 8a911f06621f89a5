import json

import pytest
from pyspark.sql import functions as F

from tidewatch import session
from tidewatch.operators import anomaly, classifier
from tidewatch.session import pin, scratch_path, shared_dir
from tidewatch.sources import readers, sinks


def test_comments_csv(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        "row_id,body,rule,positive_example_1,positive_example_2,negative_example_1,negative_example_2,rule_violation\n"
        '1,"two\nlines, ""quoted""",r,p1,p2,n1,n2,1\n2,x,r,p1,p2,n1,n2,oops\n'
    )
    rows = readers.read_comments(spark, str(path)).orderBy("row_id").collect()
    assert rows[0].body == 'two\nlines, "quoted"' and rows[0].rule_violation == 1
    assert rows[1].rule_violation is None
    with pytest.raises(FileNotFoundError):
        readers.read_comments(spark, str(tmp_path / "none.csv"))
    assert readers.read_comments(spark, str(tmp_path / "none.csv"), missing="empty").count() == 0


def test_ledger(spark, tmp_path):
    path = tmp_path / "ledger.json"
    assert readers.read_ledger(spark, str(path)).count() == 0
    path.write_text("{broken")
    assert readers.read_ledger(spark, str(path)).count() == 0
    entry = {"offense": "Toxicity", "points": 3, "content": "x", "timestamp": "2024-01-01 10:00:00"}
    path.write_text(json.dumps({"7": {"name": "n", "behavior_score": 3, "history": [entry]}}, indent=4))
    row = readers.read_ledger(spark, str(path)).first()
    assert (row.user_id, row.name, row.behavior_score, row.history[0].points) == ("7", "n", 3, 3)


def test_keyed_series(spark):
    day = {"1. open": "1", "2. high": "2.5", "3. low": "bad", "4. close": "2", "5. volume": "10"}
    payloads = [
        ("a", json.dumps({"Meta": {"x": "y"}, "Time Series (Daily)": {"2024-01-02": day, "2024-01-01": day}})),
        ("b", json.dumps({"Weekly Time Series": {"2024-01-05": day}})),
        ("c", json.dumps({"Error Message": "no"})),
        ("d", json.dumps({"Other": {"2024-01-05": day}})),
        ("e", "garbage"),
    ]
    df = spark.createDataFrame(payloads, "symbol string, payload string")
    rows = readers.flatten_keyed_series(df).orderBy("symbol", "date").collect()
    assert [r.symbol for r in rows] == ["a", "a", "b"]
    assert (rows[0].open, rows[0].high, rows[0].low, rows[0].close, rows[0].volume) == (1.0, 2.5, None, 2.0, 10.0)


def test_epoch_sink_is_idempotent(spark):
    path = scratch_path(spark, "epochs")
    schema = "time int, avg_price double"
    assert sinks.read_epochs(spark, path, schema + ", epoch bigint").count() == 0
    write = sinks.epoch_writer(path)
    frame = lambda rows: spark.createDataFrame(rows, schema)
    write(frame([(1, 1.0), (2, 2.0)]), 0)
    write(frame([(2, 9.0)]), 1)
    write(frame([(2, 3.0)]), 1)
    rows = sinks.latest_per_key(sinks.read_epochs(spark, path, schema + ", epoch bigint"), ["time"])
    assert sorted(map(tuple, rows.collect())) == [(1, 1.0), (2, 3.0)]
    fresh = sinks.append_new_keys(frame([(2, 5.0), (4, 4.0)]), rows, ["time"])
    assert [tuple(r) for r in fresh.collect()] == [(4, 4.0)]


def test_append_rows(spark):
    path = scratch_path(spark, "facts")
    for i in range(2):
        sinks.append_rows(spark.createDataFrame([(i,)], "i int"), path)
    assert sorted(r.i for r in spark.read.parquet(path).collect()) == [0, 1]


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    df = spark.range(5).withColumn("x", F.rand())
    fixed = pin(df)
    assert fixed.exceptAll(fixed).count() == 0 and fixed.count() == 5


def test_release_deletes_own_scratch_only(spark):
    mine = scratch_path(spark, "mine")
    other = f"{shared_dir(spark)}/other-{mine[-8:]}"
    for path in (mine, other):
        spark.range(3).write.parquet(path)
    session._scratch[:] = [mine]
    session.release(spark)
    assert not readers.path_exists(spark, mine) and readers.path_exists(spark, other)


def forest_rows(spark):
    near = F.when(F.col("id") < 950, F.col("id") % 10).otherwise(F.lit(500) + F.col("id"))
    return spark.range(1000).select("id", near.cast("double").alias("amount"), (F.col("id") % 3).alias("txn_count"), near.cast("double").alias("avg_amount"))


def test_isolation_forest(spark):
    rows = forest_rows(spark)
    forest = anomaly.fit_isolation_forest(rows, "id", trees=30, sample=64, contamination=0.05)
    assert len(forest.nodes) <= 30 * (2 * 64 - 1)
    scored = forest.score(rows)
    assert scored.filter("is_anomaly AND id < 950").count() <= 10
    assert scored.filter("is_anomaly AND id >= 950").count() >= 40
    path = scratch_path(spark, "forest")
    forest.save(spark, path)
    again = anomaly.IsolationForest.load(spark, path)
    assert scored.exceptAll(again.score(rows)).count() == 0


def test_isolation_forest_on_many_rows(spark):
    """Above 2 * trees * sample rows each row is a candidate of one tree."""
    rows = forest_rows(spark)
    forest = anomaly.fit_isolation_forest(rows, "id", trees=8, sample=16)
    assert forest.nodes["tree"].nunique() == 8
    assert forest.score(rows).filter("anomaly_score > 0 AND anomaly_score <= 1").count() == 1000


def test_classifier_is_trained_once(spark):
    rows = spark.createDataFrame(
        [(i, "bad spam offer" if i % 2 else "kind helpful words", i % 2) for i in range(40)],
        "row_id int, model_input string, rule_violation int",
    )
    path = scratch_path(spark, "model")
    model = classifier.fit_or_load(rows, path)
    loaded = classifier.fit_or_load(rows.limit(0), path)
    scored = classifier.predict(loaded, rows)
    assert scored.exceptAll(classifier.predict(model, rows)).count() == 0
    assert scored.filter("(prob_violation > 0.5) = (rule_violation = 1)").count() == 40
    assert len(scored.first().logits) == 2
