import math

import pytest
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.functions import numeric
from tidewatch.operators import behavior, chat, encoding, moderation, profiling, scoring

BARE = "message_id int, user_id string, name string, ts int, text string"
NO_LINKS = "message_id int, n_malicious bigint, threats string"


def verdicts(spark, texts, bad=(), **options):
    rows = spark.createDataFrame([(i, "u", "n", i, t) for i, t in enumerate(texts)], BARE)
    links = spark.createDataFrame([(i, 1, "MALWARE") for i in bad], NO_LINKS)
    out = chat.moderation_verdict(rows, links, **options).orderBy("message_id").collect()
    return [r.offense for r in out]


def test_cascade_order(spark):
    texts = ["https://bad.example/x kys", "kys free nitro", "free nitro idiot", "you idiot", "ass", "fine"]
    assert verdicts(spark, texts, bad=[0]) == [
        V.MALICIOUS_LINK, V.ZERO_TOLERANCE, V.SPAM, V.TOXICITY, None, None,
    ]
    swapped = (V.ZERO_TOLERANCE, V.MALICIOUS_LINK, V.SPAM, V.TOXICITY)
    assert verdicts(spark, texts[:1], bad=[0], order=swapped) == [V.ZERO_TOLERANCE]


def test_one_offence_per_message(spark):
    assert len(verdicts(spark, ["https://bad.example/x kys idiot"], bad=[0])) == 1


def test_model_sees_only_the_last_stage(spark):
    def load():
        def predict(texts):
            assert all("idiot" in t or "dumb" in t for t in texts), texts
            return [{"insult": 0.95 if "idiot" in t else 0.1} for t in texts]

        return predict

    texts = ["kys idiot", "free nitro idiot", "idiot", "dumb", "nothing"]
    got = verdicts(spark, texts, scorer=scoring.model_toxicity(load))
    assert got == [V.ZERO_TOLERANCE, V.SPAM, V.TOXICITY, None, None]


def test_without_model_nothing_is_toxic(spark):
    assert verdicts(spark, ["you idiot"], scorer=scoring.no_model) == [None]


def test_a_model_is_loaded_once_per_worker(spark):
    import os
    import tempfile

    folder = tempfile.mkdtemp(prefix="loads-")

    def load():
        tempfile.mkstemp(prefix=f"{os.getpid()}-", dir=folder)
        return lambda texts: [float(os.getpid())] * len(texts)

    scored = spark.range(64).repartition(32).select(scoring.model_sentiment(load)(F.col("id").cast("string")).alias("pid"))
    workers = {r.pid for _ in range(3) for r in scored.collect()}
    loads = [int(name.split("-")[0]) for name in os.listdir(folder)]
    assert sorted(set(loads)) == sorted(loads) and set(loads) == workers and len(loads) <= 16


def test_model_sentiment_skips_nulls(spark):
    load = lambda: lambda texts: [1.0 if "up" in t else 0.0 for t in texts]
    df = spark.createDataFrame([(0, "up"), (1, None), (2, "down")], "i int, t string").coalesce(1)
    scored = df.withColumn("s", scoring.model_sentiment(load)(F.col("t"))).orderBy("i").collect()
    assert [r.s for r in scored] == [1.0, None, 0.0]


def test_malicious_links_join(spark):
    urls = spark.createDataFrame(
        [(1, "http://e.vil/a"), (1, "http://e.vil/b"), (2, "https://youtube.com/bad"), (3, "http://ok.x")],
        "message_id int, url string",
    )
    threats = spark.createDataFrame(
        [
            ("http://e.vil/a", True, ["SOCIAL", "MALWARE"]),
            ("http://e.vil/b", True, ["MALWARE"]),
            ("https://youtube.com/bad", True, ["MALWARE"]),
            ("http://ok.x", False, []),
        ],
        "url string, malicious boolean, threats array<string>",
    )
    rows = chat.malicious_links(urls, threats).collect()
    assert [tuple(r) for r in rows] == [(1, 2, "MALWARE, SOCIAL")]


def test_offence_points(spark):
    rows = spark.createDataFrame(
        [("Toxicity", None), ("unknown", None), ("Manual Adjustment", 50), ("Manual Pardon", -10)],
        "offense string, points int",
    )
    got = [(r.points, r.colour) for r in behavior.offence_points(rows).collect()]
    assert got == [(3, "orange"), (1, "orange"), (50, "red"), (-10, "green")]
    signs = rows.select(numeric.signed(F.coalesce("points", F.lit(5))).alias("s")).collect()
    assert [r.s for r in signs] == ["+5", "+5", "+50", "-10"]


def test_ledger_keeps_first_name_and_user_id(spark):
    rows = spark.createDataFrame(
        [("u", "old", 1, 1, 0, "Toxicity", 3, "x"), ("u", "new", 2, 2, 0, "Toxicity", 3, "y")],
        "user_id string, name string, ts int, message_id int, seq int, offense string, points int, content string",
    )
    scored = behavior.behavior_score(rows)
    assert tuple(behavior.offender_ledger(scored).first()) == ("u", "old", 6, 2)
    assert tuple(behavior.user_stats(scored).first()) == ("u", 6)


def test_recent_history(spark):
    rows = spark.createDataFrame(
        [("u", "n", i, 0, "Toxicity", i, f"c{i}") for i in range(1, 8)],
        "user_id string, name string, message_id int, seq int, offense string, points int, content string",
    ).withColumn("ts", F.timestamp_seconds(F.col("message_id") * 60))
    stats = behavior.user_stats(behavior.behavior_score(rows))
    recent = behavior.recent_history(rows, stats).orderBy("rank").collect()
    assert [r.content for r in recent] == ["c7", "c6", "c5", "c4", "c3"]
    assert recent[0].title == "1970-01-01 00:07 | Toxicity (+7)"
    assert {r.behavior_score for r in recent} == {28}


def test_softmax(spark):
    rows = spark.createDataFrame([([0.0, 0.0],), ([1000.0, 1000.0 + math.log(3)],)], "l array<double>")
    got = [round(r.p, 12) for r in rows.select(numeric.positive_probability("l").alias("p")).collect()]
    assert got == [0.5, 0.75]


def test_auc(spark):
    rows = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)]
    df = spark.createDataFrame(rows, "true_label int, prob_violation double")
    assert moderation.auc(df).first().auc == pytest.approx(0.75)
    tied = spark.createDataFrame([(0, 0.5), (1, 0.5)], df.schema)
    assert moderation.auc(tied).first().auc == pytest.approx(0.5)
    assert moderation.auc(df.filter("true_label = 1")).first().auc is None


def test_error_types(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.6), (1, 0.35), (1, 0.5)], "true_label int, prob_violation double")
    got = [r.error_type for r in moderation.with_error_type(df).collect()]
    assert got == [V.CORRECT, V.FALSE_POSITIVE, V.FALSE_NEGATIVE, V.CORRECT]


def test_prompt(spark):
    row = ("a <b>x</b>", "No  ads", "p1", None, "n1", "n2")
    columns = "body string, rule string, positive_example_1 string, positive_example_2 string, negative_example_1 string, negative_example_2 string"
    df = spark.createDataFrame([row], columns)
    text = df.select(moderation.fewshot_prompt().alias("p")).first().p
    assert text == (
        "COMMENT TO CLASSIFY: a x [SEP_TOKEN] RULE: No ads [SEP_TOKEN] POSITIVE EXAMPLES (Violation): p1 |  "
        "[SEP_TOKEN] NEGATIVE EXAMPLES (No Violation): n1 | n2"
    )
    flagged = df.select(moderation.fewshot_prompt("</s>", flag_links=True).alias("p")).first().p
    assert flagged.endswith(" </s> URL_PRESENT: 0") and "[SEP_TOKEN]" not in flagged


@pytest.mark.parametrize("prefix_len", [1, 2, 4])
def test_split_is_exact_and_repeatable(spark, prefix_len):
    df = spark.range(1003).select("id", F.when(F.col("id") % 7 == 0, "rare").otherwise("common").alias("y"))
    split = moderation.stratified_split(df, "id", "y", prefix_len=prefix_len)
    counts = {(r.y, r.split): r["count"] for r in split.groupBy("y", "split").count().collect()}
    # ceil(0.2 * 1003) = 201 rows: 144 / 1003 of them rare.
    assert counts == {("rare", "val"): 29, ("rare", "train"): 115, ("common", "val"): 172, ("common", "train"): 687}
    again = moderation.stratified_split(df.repartition(7), "id", "y", prefix_len=4)
    assert split.exceptAll(again).count() == 0
    assert moderation.stratified_split(df.limit(0), "id", "y").count() == 0
    other = moderation.stratified_split(df, "id", "y", seed=7)
    assert split.exceptAll(other).count() > 0


def test_encoding(spark):
    df = spark.createDataFrame([("one two",), (" ".join(map(str, range(600))),)], "t string")
    rows = encoding.encode_tokens(df, "t", 16).collect()
    assert all(len(r.input_ids) == len(r.attention_mask) == 16 for r in rows)
    assert rows[0].input_ids[0] == V.START_ID and rows[0].input_ids[3] == V.END_ID
    assert rows[0].input_ids[4:] == [V.PAD_ID] * 12 and sum(rows[0].attention_mask) == 4
    assert sum(rows[1].attention_mask) == 16 and rows[1].input_ids[-1] == V.END_ID


def test_profile_edge_cases(spark):
    one = spark.createDataFrame([(5, "a")], "x int, y string")
    assert tuple(profiling.describe(one, "x").first()) == (1, 5.0, None, 5, 5.0, 5.0, 5.0, 5)
    assert [tuple(r) for r in profiling.histogram(one, "x", "y").collect()] == [("a", 0, 1)]
    box = profiling.box_statistics(
        spark.createDataFrame([(v, "a") for v in (1, 2, 3, 4, 100)], "x int, y string"), "x", "y"
    ).first()
    assert (box.whisker_low, box.whisker_high, box.outliers) == (1, 4, 1)


def test_roadmap_columns(spark):
    df = spark.createDataFrame([(0.96, "r1"), (0.5, "r2"), (0.41, "r1")], "prob_violation double, rule string")
    assert [r.action for r in moderation.route_actions(df).collect()] == ["auto_remove", "review", "keep"]
    assert [r.prob_violation for r in moderation.uncertain(df).collect()] == [0.5, 0.41]
    record = df.select(moderation.prediction_record().alias("r")).first().r
    assert record == '{"violation_predicted":true,"rule":"r1","confidence_score":0.96}'


def test_split_of_thousands_of_classes_and_null_labels(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 3000).alias("y"))
    split = moderation.stratified_split(df, "id", "y", test_size=0.25)
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {None: 900, "val": 2025, "train": 6075}


def test_auc_leaves_out_nulls(spark):
    rows = [(1, 0.9), (0, 0.2), (1, 0.1), (0, 0.05), (None, 0.7), (1, None)]
    assert moderation.auc(spark.createDataFrame(rows, "true_label int, prob_violation double")).first()[0] == 0.75
