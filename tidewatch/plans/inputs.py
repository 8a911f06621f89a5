"""The shared tables seen as transactions, prices, posts, comments, messages, bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.operators import behavior, chat, fraud, moderation, scoring
from tidewatch.session import pin
from tidewatch.sources.readers import read_table

# Parameters of the queries: the tables hold other words and amounts than the
# defaults are made for.
WINDOW_S, SLIDE_S = 2 * 86_400, 86_400
HIGH_AMOUNT, HIGH_COUNT = 200.0, 5
BUCKET_S = 3_600
# Prices and posts meet within these bounds, whatever bucket they are in.
BEFORE_S, AFTER_S = 90, 120
PAGE_BYTES = 6_000
# Customers in a ledger file, and bytes of a split: far less than a file holds.
LEDGER_ROWS, LEDGER_SPLIT = 5_000, 1 << 16
END_ID = -1  # the id of a message that ends a log
# Rows per key beyond which the *_split queries cut a key into chunks.
SPLIT_OFFENCES, SPLIT_BARS = 8, 200
ZERO_TOLERANCE = ("scum", "pathetic")
PHRASES = V.SPAM_PHRASES + ("for the the", "license", "subscribe")
POSITIVE = ("the", "with", "les", "und")
NEGATIVE = ("of", "to", "des", "die", "worthless", "idiot")
TRUSTED = V.TRUSTED_DOMAINS + ("ththhe.example.com", "thther.example.org")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return read_table(spark, sf_dir, name)


def transactions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        "user_id",
        F.col("value").alias("amount"),
        F.col("ts").alias("event_time"),
    )


def coarse_transactions(spark: SparkSession, d: str) -> DataFrame:
    """A few users with all transactions, every seventh on a boundary of five minutes."""
    at = F.when(F.col("event_id") % 7 == 0, F.window("ts", "5 minutes").start).otherwise(F.col("ts"))
    return table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.pmod("user_id", F.lit(3)).alias("user_id"),
        F.col("value").alias("amount"),
        at.alias("event_time"),
    )


def features(spark: SparkSession, d: str) -> DataFrame:
    return fraud.fraud_features(transactions(spark, d), WINDOW_S, SLIDE_S)


def alerts(spark: SparkSession, d: str) -> DataFrame:
    return fraud.fraud_alerts(features(spark, d), HIGH_AMOUNT, HIGH_COUNT)


def prices(spark: SparkSession, d: str) -> DataFrame:
    bought = F.col("event_type").isin("view", "purchase")
    return table(spark, d, "events").filter(bought).select(
        F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").alias("event_time")
    )


def posts(spark: SparkSession, d: str, scorer=None) -> DataFrame:
    """Click and error events, scored by the document of their number modulo their count.

    Texts are scored before the join, so only the score moves.
    """
    score = (scorer or scoring.lexicon_sentiment(POSITIVE, NEGATIVE))(F.col("text"))
    scores = table(spark, d, "documents").select(
        "doc_id", score.alias("sentiment_score")
    )
    count = table(spark, d, "documents").select(F.count(F.lit(1)).alias("n")).scalar()
    said = table(spark, d, "events").filter(F.col("event_type").isin("click", "error"))
    said = said.withColumn("doc_id", F.pmod(F.col("event_id"), count))
    return said.join(scores, "doc_id").select(
        "event_id", F.col("ts").alias("event_time"), "sentiment_score"
    )


def social(spark: SparkSession, d: str) -> DataFrame:
    return posts(spark, d).select("event_time", "sentiment_score")


def interval_sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Prices and posts with their ids; scores are rounded here, once per post and not once per pair."""
    bought = F.col("event_type").isin("view", "purchase")
    price = table(spark, d, "events").filter(bought).select(
        F.col("event_id").alias("price_id"), F.col("value").alias("price"), F.col("ts").alias("price_time")
    )
    said = posts(spark, d).select(
        F.col("event_id").alias("post_id"), F.col("event_time").alias("post_time"), F.round("sentiment_score", 6).alias("sentiment_score")
    )
    return price, said


def comments(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.col("toxic").alias("rule_violation"))
    return table(spark, d, "documents").join(labels, "doc_id").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("body"), F.col("source").alias("rule"), "rule_violation"
    )


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Row id and label only: no text is read."""
    return table(spark, d, "labels").select(
        F.col("doc_id").alias("row_id"), F.col("toxic").alias("rule_violation")
    )


def unit_hash(key) -> Column:
    """A reproducible number in [0, 1) from a key."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """A stand-in for model output: noise plus a share of the label."""
    noise, true = unit_hash("row_id"), F.col("rule_violation")
    return labelled(spark, d).select(
        "row_id",
        true.alias("true_label"),
        (noise * F.lit(0.75) + true * F.lit(0.25)).alias("prob_violation"),
    )


def errors(spark: SparkSession, d: str) -> DataFrame:
    return moderation.with_error_type(predictions(spark, d))


def bars(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_type").alias("symbol"), "ts", F.col("event_id").alias("bar_id"), F.col("value").alias("close")
    )


def message_time(message_id: Column) -> Column:
    return F.timestamp_seconds(F.lit(1_704_067_200) + message_id * 60).cast("timestamp_ntz")


def messages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as posts of their source; a page of the same number adds its link."""
    pages = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "url")
    text = F.concat_ws(" ", "text", "url")
    return table(spark, d, "documents").join(pages, "doc_id", "left").select(
        F.col("doc_id").alias("message_id"),
        F.col("source").alias("user_id"),
        F.concat_ws("-", "source", "lang").alias("name"),
        message_time(F.col("doc_id")).alias("ts"),
        text.alias("text"),
    )


def threats(spark: SparkSession, d: str) -> DataFrame:
    """A verdict per page link: feed links and pill shops are bad."""
    url = F.col("url")
    kinds = F.array_compact(
        F.array(
            F.when(url.contains("utm_source"), F.lit("SOCIAL_ENGINEERING")),
            F.when(url.contains("/de/"), F.lit("UNWANTED_SOFTWARE")),
            F.when(url.contains("cheap"), F.lit("MALWARE")),
        )
    )
    return table(spark, d, "pages").select("url").distinct().select(
        "url", (F.size(kinds) > 0).alias("malicious"), kinds.alias("threats")
    )


def allowed_domains(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(x,) for x in TRUSTED], "domain string")


def bad_links(spark: SparkSession, d: str) -> DataFrame:
    urls = chat.message_urls(messages(spark, d))
    return chat.malicious_links(urls, threats(spark, d), allowed_domains(spark, d))


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    return chat.moderation_verdict(
        messages(spark, d), bad_links(spark, d), zero_tolerance=ZERO_TOLERANCE, phrases=PHRASES
    )


def manual_actions(spark: SparkSession, d: str) -> DataFrame:
    """What moderators did by hand, taken from the labels of the documents."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    harsh = F.when(F.col("quality") == 0, F.lit(60)).otherwise(F.lit(4))
    toxic = F.col("toxic") == 1
    return table(spark, d, "labels").join(docs, "doc_id").select(
        F.col("doc_id").alias("message_id"),
        F.col("source").alias("user_id"),
        F.concat_ws("-", "source", "lang").alias("name"),
        message_time(F.col("doc_id")).alias("ts"),
        F.lit(1).alias("seq"),
        F.when(toxic, V.MANUAL_ADJUSTMENT).otherwise(V.MANUAL_PARDON).alias("offense"),
        F.when(toxic, harsh).otherwise(F.lit(-2)).alias("points"),
        F.lit("by hand").alias("content"),
    )


def offences(spark: SparkSession, d: str) -> DataFrame:
    """Automatic offences (points by type) and manual ones."""
    found = verdicts(spark, d).filter("offense IS NOT NULL").select(
        "message_id",
        "user_id",
        "name",
        "ts",
        F.lit(0).alias("seq"),
        "offense",
        F.lit(None).cast("int").alias("points"),
        "content",
    )
    return behavior.offence_points(found.unionByName(manual_actions(spark, d)))


def offence_log(spark: SparkSession, d: str) -> DataFrame:
    """The offences as the stored table that all score work starts from."""
    return pin(offences(spark, d))


def scored_offences(spark: SparkSession, d: str) -> DataFrame:
    return behavior.behavior_score(offence_log(spark, d).drop("content"))
