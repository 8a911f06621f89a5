"""Chat messages: link, slur, spam and toxicity checks, one verdict each.

A message frame has message_id (unique), user_id, name, ts, text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.functions.numeric import map_get
from tidewatch.functions.text import (
    contains_any,
    extract_urls,
    is_trusted,
    keyword_hit,
    normalize,
    normalize_domain,
    phrase_hit,
    possible_urls,
    squeeze,
    token_hit,
    url_host,
)
from tidewatch.operators.scoring import Scorer, lexicon_toxicity

CODE_ORDER = (V.MALICIOUS_LINK, V.ZERO_TOLERANCE, V.SPAM, V.TOXICITY)


def keyword_hits(
    messages: DataFrame, word_list: Sequence[str] = V.TRIGGER_WORDS, text: str = "text"
) -> DataFrame:
    """Normalised text, token hit, squeezed substring hit and their union."""
    texts = messages.withColumn("normalized", normalize(text)).withColumn("squeezed", squeeze("normalized"))
    return texts.withColumn("token_hit", token_hit("normalized", word_list)).withColumns(
        {
            "squeezed_hit": contains_any(F.col("squeezed"), word_list),
            "hit": keyword_hit("normalized", "squeezed", word_list),
        }
    ).drop("squeezed")


def untrusted_urls(urls: DataFrame, url: str = "url", domains: DataFrame | None = None) -> DataFrame:
    """URLs whose host is not on the allow-list; unparsable ones stay.

    Without a ``domains(domain)`` table the built-in list applies.
    """
    if domains is None:
        return urls.filter(~is_trusted(url))
    hosted = urls.withColumn("_host", url_host(url))
    allowed = domains.select(F.col("domain").alias("_host")).distinct()
    return hosted.join(allowed, "_host", "left_anti").drop("_host")


def add_domain(domains: DataFrame, entries: DataFrame) -> DataFrame:
    """The allow-list with more entries, brought to host form, each once."""
    added = entries.select(normalize_domain("domain").alias("domain")).filter("domain <> ''")
    return domains.select("domain").unionByName(added).distinct()


def message_urls(messages: DataFrame) -> DataFrame:
    """(message_id, url): distinct links per message."""
    links = F.explode(F.array_distinct(extract_urls("text"))).alias("url")
    return messages.select("message_id", links).filter("url <> ''")


def malicious_links(
    urls: DataFrame, threats: DataFrame, domains: DataFrame | None = None
) -> DataFrame:
    """Messages with a confirmed bad link: their links and threats, in order.

    ``urls(message_id, url)`` meets ``threats(url, malicious, threats)``, which
    holds each URL once. Messages are many and verdicts unique, so a URL that
    everybody posts is split by AQE, or not moved at all with a small table.
    """
    bad = threats.filter("malicious").select("url", "threats")
    suspicious = untrusted_urls(urls, "url", domains)
    kinds = F.array_sort(F.array_distinct(F.flatten(F.collect_set("threats"))))
    return (
        suspicious.join(bad, "url")
        .groupBy("message_id")
        .agg(F.count_distinct("url").alias("n_malicious"), F.array_join(kinds, ", ").alias("threats"))
    )


def toxic(scores, thresholds: Mapping[str, float] = V.TOXICITY_THRESHOLDS) -> Column:
    """Any category above its threshold; a missing score counts as 0."""
    checks = [map_get(scores, c, 0.0) > t for c, t in thresholds.items()]
    verdict = checks[0]
    for check in checks[1:]:
        verdict = verdict | check
    return verdict


def moderation_verdict(
    messages: DataFrame,
    malicious: DataFrame,
    scorer: Scorer | None = None,
    zero_tolerance: Sequence[str] = V.ZERO_TOLERANCE_WORDS,
    triggers: Sequence[str] = V.TRIGGER_WORDS,
    phrases: Sequence[str] = V.SPAM_PHRASES,
    order: Sequence[str] = CODE_ORDER,
    mode: str = "substring",
) -> DataFrame:
    """One verdict per message, the first check that matches in ``order``.

    The text checks are native expressions in one projection. The scorer sees
    a text only if the message gets that far, null otherwise. Before the join
    with the link verdicts the text is dropped from all rows that can no longer
    become an offence; those are nearly all.
    """
    scorer = scorer or lexicon_toxicity()
    normalized, squeezed = F.col("_normalized"), F.col("_squeezed")
    texts = messages.withColumn("_normalized", normalize("text")).withColumn("_squeezed", squeeze(normalized))
    checked = texts.withColumns(
        {
            "_zero": keyword_hit(normalized, squeezed, zero_tolerance, mode),
            "_spam": phrase_hit("text", phrases),
            "_trigger": keyword_hit(normalized, squeezed, triggers, mode),
            "_links": possible_urls("text"),
        }
    )
    open_case = F.col("_trigger")
    for name, column in ((V.ZERO_TOLERANCE, "_zero"), (V.SPAM, "_spam")):
        if order.index(name) < order.index(V.TOXICITY):
            open_case = open_case & ~F.col(column)
    asked = F.when(open_case, normalized)
    scored = checked.withColumn("_scores", scorer(asked)).withColumn(
        "_toxic", F.col("_trigger") & F.coalesce(toxic("_scores"), F.lit(False))
    )
    relevant = F.col("_zero") | F.col("_spam") | F.col("_toxic") | F.col("_links")
    narrow = scored.select(
        "message_id",
        "user_id",
        "name",
        "ts",
        "_zero",
        "_spam",
        "_toxic",
        F.when(relevant, F.col("text")).alias("content"),
    )
    bad = malicious.select("message_id", F.lit(True).alias("_malicious"), "threats")
    conditions = {
        V.MALICIOUS_LINK: F.coalesce(F.col("_malicious"), F.lit(False)),
        V.ZERO_TOLERANCE: F.col("_zero"),
        V.SPAM: F.col("_spam"),
        V.TOXICITY: F.col("_toxic"),
    }
    first, *rest = order
    verdict = F.when(conditions[first], first)
    for name in rest:
        verdict = verdict.when(conditions[name], name)
    return (
        narrow.join(bad, "message_id", "left")
        .withColumn("offense", verdict)
        .select("message_id", "user_id", "name", "ts", "offense", "threats", "content")
    )


def text_audit(
    texts: DataFrame,
    text: str = "text",
    scorer: Scorer | None = None,
    triggers: Sequence[str] = V.TRIGGER_WORDS,
    categories: Sequence[str] = V.AUDIT_CATEGORIES,
    flag_above: float = V.AUDIT_FLAG_THRESHOLD,
) -> DataFrame:
    """Normalised text, trigger and, per category, score text and flag."""
    scorer = scorer or lexicon_toxicity()
    audited = texts.withColumn("normalized", normalize(text)).withColumn(
        "_scores", scorer(F.col("normalized"))
    )
    columns = {"fast_trigger": keyword_hit("normalized", squeeze("normalized"), triggers)}
    for category in categories:
        score = map_get("_scores", category, 0.0)
        columns[f"{category}_score"] = F.format_string("%.4f", score)
        columns[f"{category}_flag"] = score > flag_above
    return audited.withColumns(columns).drop("_scores")
