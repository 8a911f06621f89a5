"""Every operator as a query over the shared tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.functions import numeric, temporal, text
from tidewatch.operators import (
    anomaly,
    behavior,
    chat,
    classifier,
    encoding,
    fraud,
    hype,
    intervals,
    moderation,
    phrases,
    profiling,
    quantiles,
    scoring,
    timeseries,
)
from tidewatch.plans import inputs as I
from tidewatch.plans import stream_queries
from tidewatch.session import pin, scratch_path
from tidewatch.sources.ledger import read_large_ledger
from tidewatch.sources.readers import flatten_keyed_series
from tidewatch.sources.streams import decode_json

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(column: str) -> Column:
    return F.round(column, 6).alias(column)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources and sinks -------------------------------------------------------


@query
def json_decode(spark, d):
    events = I.table(spark, d, "events").select("event_id", "props")
    return decode_json(events, "k bigint", column="props", keep=("event_id",))


@query
def parse_event_time(spark, d):
    events = I.table(spark, d, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    parsed = events.select(
        "event_id",
        temporal.parse_event_time(F.col("ts").cast("string")).alias("from_text"),
        temporal.parse_event_time(F.concat(seconds.cast("string"), F.lit(".123"))).alias("from_epoch"),
        temporal.from_epoch_millis(seconds * 1000 + 5).alias("from_millis"),
        temporal.parse_event_time("props").alias("from_junk"),
    )
    return parsed.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in parsed.columns[1:]])


def _payloads(spark, d) -> DataFrame:
    """A keyed series message per event: daily, weekly or an error."""
    kind, value = F.col("event_type"), F.col("value")
    low = F.when(kind == "click", "n/a").otherwise((value - 1).cast("string"))
    metrics = F.create_map(
        F.lit("1. open"), value.cast("string"),
        F.lit("2. high"), (value + 1).cast("string"),
        F.lit("3. low"), low,
        F.lit("4. close"), value.cast("string"),
        F.lit("5. volume"), F.col("event_id").cast("string"),
    )
    name = F.when(kind == "view", "Weekly Time Series").otherwise("Time Series (Daily)")
    series = F.to_json(F.create_map(name, F.create_map(F.date_format("ts", "yyyy-MM-dd"), metrics)))
    failed = F.to_json(F.create_map(F.lit("Error Message"), F.lit("no such symbol")))
    payload = F.when(kind == "error", failed).otherwise(series)
    return I.table(spark, d, "events").select(kind.alias("symbol"), payload.alias("payload"))


@query
def keyed_json_flatten(spark, d):
    flat = flatten_keyed_series(_payloads(spark, d))
    return flat.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query
def ledger_rows(spark, d):
    """Customers and their orders as ledger files of one JSON object each, read back in splits of a few kilobytes."""
    order = F.struct(
        "o_orderkey",
        F.col("o_orderpriority").alias("offense"),
        F.pmod("o_orderkey", F.lit(7)).cast("int").alias("points"),
        F.concat(F.lit('"'), "o_orderstatus", F.lit('\\}, {')).alias("content"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("timestamp"),
    )
    placed = I.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.transform(F.array_sort(F.collect_list(order)), lambda o: o.dropFields("o_orderkey")).alias("history")
    )
    people = I.table(spark, d, "customer").join(placed, "c_custkey")
    value = F.to_json(F.struct(F.col("c_name").alias("name"), F.size("history").alias("behavior_score"), "history"))
    entry = F.concat(F.lit('"'), F.col("c_custkey").cast("string"), F.lit('":'), value)
    # A file holds some thousand customers, however many there are.
    files = F.floor(F.col("c_custkey") / I.LEDGER_ROWS).alias("file")
    whole = people.groupBy(files).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ",\n"), F.lit("}")).alias("value"))
    path = scratch_path(spark, "ledger")
    whole.write.partitionBy("file").text(path)
    rows = read_large_ledger(spark, path, split_bytes=I.LEDGER_SPLIT)
    points = F.aggregate("history", F.lit(0).cast("bigint"), lambda a, e: a + e.points)
    return rows.select(
        "user_id", "name", "behavior_score", F.size("history").alias("n_entries"), points.alias("points"),
        F.array_join(F.col("history.offense"), ",").alias("offenses"), F.get("history.content", F.lit(0)).alias("content"),
        F.array_max("history.timestamp").alias("last"),
    )


@query
def alert_json(spark, d):
    fields = "transaction_id string, user_id bigint, amount double, is_fraud_alert boolean, fraud_score double"
    return decode_json(fraud.alert_json(I.alerts(spark, d)), fields)


# --- transactions ------------------------------------------------------------


@query
def user_window_features(spark, d):
    features = fraud.user_window_features(I.transactions(spark, d), I.WINDOW_S, I.SLIDE_S)
    return features.select(
        "user_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "txn_count", r6("avg_amount"),
    )


@query
def fraud_features_default(spark, d):
    """Ten-minute windows every five minutes: on a boundary the window that ends there counts too."""
    return rounded(fraud.fraud_features(I.coarse_transactions(spark, d)), "avg_amount")


@query
def fraud_features(spark, d):
    return rounded(I.features(spark, d), "avg_amount")


@query
def fraud_alerts(spark, d):
    return rounded(I.alerts(spark, d), "avg_amount")


@query
def fraud_alerts_once(spark, d):
    best = fraud.one_alert_per_transaction(I.alerts(spark, d))
    return best.select("transaction_id", "user_id", "amount", "is_fraud_alert", "fraud_score")


@query
def latest_alerts(spark, d):
    return rounded(fraud.latest_alerts(I.alerts(spark, d)), "avg_amount")


# --- prices and posts --------------------------------------------------------


@query
def time_bucket(spark, d):
    return I.table(spark, d, "events").select("event_id", temporal.bucket_seconds("ts", 10).alias("bucket"))


@query
def hype_pairs(spark, d):
    pairs = hype.hype_pairs(I.prices(spark, d), I.social(spark, d), I.BUCKET_S)
    return rounded(pairs, "avg_price", "hype_score")


def _hype(spark, d) -> DataFrame:
    return hype.hype_meter(I.prices(spark, d), I.social(spark, d), I.BUCKET_S)


@query
def hype_meter(spark, d):
    return rounded(_hype(spark, d), "avg_price", "hype_score")


@query
def hype_interval_join(spark, d):
    """Each price with the posts shortly before and after it: the interval alone is the condition."""
    bounds = [timedelta(seconds=x) for x in (I.BEFORE_S, I.AFTER_S)]
    pairs = intervals.interval_join(*I.interval_sides(spark, d), "price_time", "post_time", *bounds)
    return pairs.select("price_id", "post_id", "price", "sentiment_score")


@query
def latest_hype(spark, d):
    return rounded(hype.latest_hype(_hype(spark, d)), "avg_price", "hype_score")


@query
def current_metric(spark, d):
    now = hype.current_metric(_hype(spark, d))
    return now.select("time", numeric.dollars("avg_price").alias("price"), r6("hype_score"))


# --- bars --------------------------------------------------------------------


def _sma(n: int, **bounds: int) -> Query:
    def run(spark, d):
        return rounded(timeseries.moving_average(I.bars(spark, d), n, **bounds), f"sma_{n}")

    return run


QUERIES["sma_20"] = _sma(20)
QUERIES["sma_50"] = _sma(50)


@query
def daily_return(spark, d):
    return rounded(timeseries.daily_return(I.bars(spark, d)), "daily_return")


@query
def recent_bars(spark, d):
    return rounded(timeseries.recent_bars(I.bars(spark, d)), "sma_50")


@query
def series_payload(spark, d):
    payload = timeseries.series_payload(I.bars(spark, d))
    return payload.select(
        "symbol",
        F.array_join("dates", ",").alias("dates"),
        _numbers("closes", "%.2f"),
        _numbers("sma_prices", "%.4f"),
    )


def _numbers(column: str, pattern: str) -> Column:
    """An array of numbers as one text, nulls spelled out."""
    shown = F.transform(column, lambda x: F.when(x.isNull(), "null").otherwise(F.format_string(pattern, x)))
    return F.array_join(shown, ",").alias(column)


@query
def requested_bars(spark, d):
    """Symbols as a user types them; regions have no bars."""
    bars = I.bars(spark, d).withColumn("symbol", F.upper("symbol"))
    typed = I.table(spark, d, "events").filter(F.col("event_type").isin("view", "purchase"))
    asked = typed.select(F.col("event_type").alias("symbol")).distinct().unionByName(
        I.table(spark, d, "region").select(F.lower("r_name").alias("symbol"))
    ).unionByName(I.table(spark, d, "region").select(F.lit("").alias("symbol")))
    return timeseries.bars_for(bars, asked).select("symbol", "bar_id", "close")


@query
def unknown_symbols(spark, d):
    """Regions are asked for besides the real symbols; they have no bars."""
    bars = I.bars(spark, d)
    asked = bars.select("symbol").distinct().unionByName(
        I.table(spark, d, "region").select(F.col("r_name").alias("symbol"))
    ).unionByName(I.table(spark, d, "region").select(F.lit("").alias("symbol")))
    return timeseries.unknown_symbols(asked, bars)


# --- profile of labelled comments --------------------------------------------


@query
def table_profile(spark, d):
    return profiling.table_profile(I.comments(spark, d))


@query
def preview_rows(spark, d):
    return profiling.preview(I.comments(spark, d), ["row_id", "body", "rule", "rule_violation"], "row_id")


@query
def distinct_rules(spark, d):
    return profiling.distinct_count(I.comments(spark, d), "rule")


@query
def value_counts(spark, d):
    return profiling.value_counts(I.comments(spark, d), "rule")


@query
def class_balance(spark, d):
    return profiling.class_balance(I.labelled(spark, d), "rule_violation")


@query
def imbalance_ratio(spark, d):
    return profiling.imbalance_ratio(I.labelled(spark, d), "rule_violation")


@query
def violation_rate(spark, d):
    return rounded(profiling.violation_rate(I.comments(spark, d), "rule", "rule_violation"), "violation_rate")


@query
def text_lengths(spark, d):
    lengths = moderation.text_lengths(I.comments(spark, d))
    return lengths.select("row_id", "body_length", "body_word_count")


def _lengths(spark, d) -> DataFrame:
    return I.comments(spark, d).select("rule_violation", F.char_length("body").alias("body_length"))


@query
def length_describe(spark, d):
    stats = profiling.describe(_lengths(spark, d), "body_length")
    return rounded(stats, "mean", "std", "p25", "p50", "p75")


@query
def price_describe(spark, d):
    """A continuous column: nearly as many distinct values as rows."""
    stats = profiling.describe(I.table(spark, d, "orders"), "o_totalprice")
    return rounded(stats, "mean", "std", "p25", "p50", "p75")


@query
def value_box(spark, d):
    box = profiling.box_statistics(I.table(spark, d, "events"), "value", "event_type")
    return rounded(box, "q1", "median", "q3")


@query
def value_quantiles(spark, d):
    """Many ranks at once, per user."""
    q = quantiles.quantiles(I.table(spark, d, "events"), "value", (0.0, 0.01, 0.5, 0.9, 0.99, 1.0), by=("user_id",))
    named = [F.round(F.col("q")[i], 6).alias(name) for i, name in enumerate(("low", "p1", "p50", "p90", "p99", "high"))]
    return q.select("user_id", "n", *named)


@query
def length_histogram(spark, d):
    return profiling.histogram(_lengths(spark, d), "body_length", "rule_violation")


@query
def length_box(spark, d):
    box = profiling.box_statistics(_lengths(spark, d), "body_length", "rule_violation")
    return rounded(box, "q1", "median", "q3")


# --- texts -------------------------------------------------------------------


@query
def clean_html(spark, d):
    return I.table(spark, d, "pages").select("page_id", text.clean_text("html").alias("cleaned"))


@query
def redact_links(spark, d):
    return I.table(spark, d, "documents").select("doc_id", text.redact_links("text").alias("redacted"))


@query
def leet_normalize(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", text.normalize("text").alias("normalized"))
    return docs.withColumn("squeezed", text.squeeze("normalized"))


@query
def keyword_hits(spark, d):
    hits = chat.keyword_hits(I.table(spark, d, "documents"))
    return hits.select("doc_id", "token_hit", "squeezed_hit", "hit")


@query
def spam_hits(spark, d):
    return I.table(spark, d, "documents").select("doc_id", text.phrase_hit("text", I.PHRASES).alias("spam"))


@query
def phrase_table_hits(spark, d):
    """Phrases from a table, all runs of three words of the benchmark, anywhere in the documents."""
    said = F.split(F.lower("text"), " ")
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - 2), lambda i: F.array_join(F.slice("w", i, 3), " "))
    items = I.table(spark, d, "benchmark").select(said.alias("w")).filter(F.size("w") >= 3)
    docs = I.table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    found = phrases.find_phrases(docs, "doc_id", "text", items.select(F.explode(runs).alias("phrase")))
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_found"), F.min("phrase").alias("first_found"))


@query
def word_table_hits(spark, d):
    """Tokens on a list that is a table: all words of the benchmark."""
    listed = I.table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    docs = I.table(spark, d, "documents")
    found = phrases.with_listed_words(docs, "doc_id", F.split(F.lower("text"), " "), listed)
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_found"), F.min("word").alias("first_found"))


@query
def extract_urls(spark, d):
    both = F.concat_ws(" ", "url", "html")
    return I.table(spark, d, "pages").select("page_id", F.explode(text.extract_urls(both)).alias("found"))


@query
def url_host(spark, d):
    return I.table(spark, d, "pages").select("page_id", text.url_host("url").alias("host"))


@query
def normalize_domain(spark, d):
    typed = F.concat(F.lit("  "), F.upper("url"), F.lit("\t"))
    return I.table(spark, d, "pages").select("page_id", text.normalize_domain(typed).alias("domain"))


@query
def allow_list(spark, d):
    entries = I.table(spark, d, "pages").select(F.col("url").alias("domain"))
    return chat.add_domain(I.allowed_domains(spark, d), entries)


@query
def untrusted_urls(spark, d):
    urls = I.table(spark, d, "pages").select("page_id", "url")
    return chat.untrusted_urls(urls, "url", I.allowed_domains(spark, d))


@query
def malicious_links(spark, d):
    return I.bad_links(spark, d)


@query
def truncate_tokens(spark, d):
    kept = encoding.truncate(text.lower_tokens("text"))
    docs = I.table(spark, d, "documents").select("doc_id", kept.alias("t"))
    return docs.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query
def encode_tokens(spark, d):
    encoded = encoding.encode_tokens(I.comments(spark, d).select("row_id", "body"), "body")
    return encoded.select(
        "row_id",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_used"),
    )


@query
def sentiment_model_score(spark, d):
    """The same posts scored by a Python model over Arrow batches."""
    model = scoring.model_sentiment(scoring.WordListModel(I.POSITIVE, I.NEGATIVE))
    return I.posts(spark, d, model).select("event_id", "sentiment_score")


@query
def sentiment_score(spark, d):
    return I.posts(spark, d).select("event_id", "sentiment_score")


@query
def toxicity_scores(spark, d):
    scores = scoring.lexicon_toxicity()(F.col("text"))
    return I.table(spark, d, "documents").select("doc_id", F.explode(scores).alias("category", "score"))


@query
def text_audit(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", "text")
    return chat.text_audit(docs).drop("text")


# --- labelled comments: prompt, split, predictions ---------------------------


def _prompts(spark, d, **options) -> DataFrame:
    comments = I.comments(spark, d)
    full = moderation.with_examples(comments, comments)
    return full.select("row_id", moderation.fewshot_prompt("</s>", clean_examples=False, **options).alias("prompt"))


@query
def fewshot_prompt(spark, d):
    return _prompts(spark, d)


@query
def url_flag_prompt(spark, d):
    return _prompts(spark, d, flag_links=True)


@query
def stratified_split(spark, d):
    return moderation.stratified_split(I.labelled(spark, d), "row_id", "rule_violation")


@query
def split_summary(spark, d):
    split = moderation.stratified_split(I.labelled(spark, d), "row_id", "rule_violation")
    return rounded(moderation.split_summary(split, "rule_violation"), "violation_rate")


@query
def softmax_prob(spark, d):
    x = (F.col("prob_violation") - 0.5) * 4.0
    logits = I.predictions(spark, d).select("row_id", F.array(-x, x).alias("logits"))
    scored = moderation.predictions_from_logits(logits)
    return rounded(scored.select("row_id", "prob_violation"), "prob_violation")


@query
def prediction_join(spark, d):
    return moderation.join_predictions(I.comments(spark, d), I.predictions(spark, d))


@query
def error_types(spark, d):
    return I.errors(spark, d)


@query
def error_distribution(spark, d):
    return profiling.class_balance(I.errors(spark, d), "error_type")


def _top_errors(spark, d, kind: str) -> DataFrame:
    top = moderation.top_errors(I.errors(spark, d), I.comments(spark, d), kind, 5)
    return top.select("row_id", "rule", "prob_violation", "body")


@query
def top_false_positives(spark, d):
    return _top_errors(spark, d, V.FALSE_POSITIVE)


@query
def top_false_negatives(spark, d):
    return _top_errors(spark, d, V.FALSE_NEGATIVE)


@query
def auc(spark, d):
    return rounded(moderation.auc(I.predictions(spark, d)), "auc")


@query
def evaluation(spark, d):
    return rounded(moderation.evaluation(I.predictions(spark, d)), "accuracy", "auc")


@query
def action_routing(spark, d):
    return moderation.route_actions(I.predictions(spark, d)).select("row_id", "action")


@query
def uncertainty_band(spark, d):
    return moderation.uncertain(I.predictions(spark, d))


@query
def prediction_records(spark, d):
    joined = moderation.join_predictions(I.comments(spark, d).drop("body"), I.predictions(spark, d))
    records = joined.select("row_id", moderation.prediction_record().alias("record"))
    fields = "violation_predicted boolean, rule string, confidence_score double"
    return decode_json(records, fields, column="record", keep=("row_id",))


@query
def hybrid_scores(spark, d):
    joined = moderation.join_predictions(I.comments(spark, d), I.predictions(spark, d))
    scored = joined.withColumn("link_score", text.has_link("body").cast("double"))
    score = moderation.hybrid_score(("src1", "src2"), "link_score", "prob_violation")
    return scored.select("row_id", "rule", score.alias("score"))


# --- chat --------------------------------------------------------------------


@query
def moderation_verdict(spark, d):
    return I.verdicts(spark, d).drop("content")


@query
def offence_points(spark, d):
    return I.offences(spark, d).select("message_id", "seq", "user_id", "offense", "points", "colour")


@query
def behavior_score(spark, d):
    scored = I.scored_offences(spark, d)
    return scored.select("user_id", "message_id", "seq", "points", "score")


@query
def user_stats(spark, d):
    return behavior.user_stats(I.scored_offences(spark, d))


@query
def recent_history(spark, d):
    log = I.offence_log(spark, d)
    stats = behavior.user_stats(behavior.behavior_score(log.drop("content")))
    recent = behavior.recent_history(log, stats)
    return recent.select("user_id", "rank", F.col("behavior_score").alias("total_score"), "title", "content")


@query
def offender_ledger(spark, d):
    return behavior.offender_ledger(I.scored_offences(spark, d))


@query
def history_pages(spark, d, **bounds):
    pages = behavior.history_pages(I.offence_log(spark, d), page_rows=10, **bounds)
    return pages.select(
        "user_id",
        "page",
        F.size("history").alias("n_entries"),
        F.array_join(F.col("history.offense"), ",").alias("offenses"),
    )


@query
def history_pages_bytes(spark, d, **bounds):
    pages = behavior.history_pages_by_bytes(I.offence_log(spark, d), page_bytes=I.PAGE_BYTES, **bounds)
    return pages.select(
        "user_id",
        "first_position",
        "n_bytes",
        F.size("history").alias("n_entries"),
        F.array_join(F.col("history.offense"), ",").alias("offenses"),
    )


# The same with keys that are cut into chunks: no size may change a result.
QUERIES["behavior_score_split"] = lambda spark, d: behavior.behavior_score(
    I.offence_log(spark, d).drop("content"), max_rows_per_key=I.SPLIT_OFFENCES
).select("user_id", "message_id", "seq", "points", "score")
QUERIES["sma_20_split"] = _sma(20, max_rows_per_key=I.SPLIT_BARS)
QUERIES["daily_return_split"] = lambda spark, d: rounded(
    timeseries.daily_return(I.bars(spark, d), max_rows_per_key=I.SPLIT_BARS), "daily_return"
)
QUERIES["history_pages_bytes_split"] = lambda spark, d: history_pages_bytes(spark, d, max_rows_per_key=I.SPLIT_OFFENCES)
QUERIES["history_pages_split"] = lambda spark, d: history_pages(spark, d, max_rows_per_key=I.SPLIT_OFFENCES)


# --- models ------------------------------------------------------------------


@query
def training_union(spark, d):
    """Transactions with their window features, and big orders as outliers."""
    normal = I.features(spark, d).select(
        F.lit("normal").alias("kind"), "amount", F.col("txn_count").cast("double").alias("txn_count"), r6("avg_amount")
    )
    outliers = (
        I.table(spark, d, "orders")
        .groupBy("o_custkey")
        .agg(
            F.max("o_totalprice").alias("amount"),
            F.count(F.lit(1)).cast("double").alias("txn_count"),
            F.round(F.avg("o_totalprice"), 6).alias("avg_amount"),
        )
        .select(F.lit("outlier").alias("kind"), "amount", "txn_count", "avg_amount")
    )
    return anomaly.training_union(normal, outliers)


@query
def isolation_forest_scores(spark, d):
    key = F.concat_ws("@", "transaction_id", "window_start").alias("row_key")
    rows = pin(I.features(spark, d).select(key, "amount", "txn_count", r6("avg_amount")))
    return anomaly.fit_and_score(rows, "row_key")[1]


@query
def moderation_model_scores(spark, d):
    # The split is made on ids and labels; texts meet it once and are stored clean, as training reads them several times.
    split = moderation.stratified_split(I.labelled(spark, d), "row_id", "rule_violation")
    texts = I.table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), text.clean_text("text").alias("model_input"))
    rows = pin(texts.join(split, "row_id"))
    model = classifier.build_pipeline().fit(rows.filter("split = 'train'"))
    scored = classifier.predict(model, rows.filter("split = 'val'"))
    return scored.select("row_id", F.col("rule_violation").alias("true_label"), "prob_violation")


@query
def moderation_model_evaluation(spark, d):
    """The fitted model on the rows that were held out: its scores are stored, then judged like any others."""
    return moderation.evaluation(pin(moderation_model_scores(spark, d)))


QUERIES.update(stream_queries.QUERIES)
