"""Labelled comments: prompts, split, predictions, error analysis.

A comment frame has row_id (unique), body, rule, rule_violation (0/1) and
optionally positive_example_1/2 and negative_example_1/2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import fixed_values as V
from tidewatch.functions.numeric import positive_probability
from tidewatch.functions.text import clean_text, has_link, redact_links, word_count

EXAMPLES = ("positive_example_1", "positive_example_2", "negative_example_1", "negative_example_2")


def text_lengths(comments: DataFrame, text: str = "body") -> DataFrame:
    return comments.withColumns(
        {f"{text}_length": F.char_length(text), f"{text}_word_count": word_count(text)}
    )


def with_examples(comments: DataFrame, labelled: DataFrame) -> DataFrame:
    """Give every comment two positive and two negative examples of its rule.

    The examples are the first and last labelled comment of the rule and label
    by row id. Their ids are found first, by combinable aggregates over ids
    alone; only these texts are then fetched, and cleaned once per rule.
    """
    violating = F.col("rule_violation") == 1
    wanted = {
        "positive_example_1": F.min(F.when(violating, F.col("row_id"))),
        "positive_example_2": F.max(F.when(violating, F.col("row_id"))),
        "negative_example_1": F.min(F.when(~violating, F.col("row_id"))),
        "negative_example_2": F.max(F.when(~violating, F.col("row_id"))),
    }
    ids = labelled.groupBy("rule").agg(*[c.alias(name) for name, c in wanted.items()])
    slots = F.explode(F.array(*[F.struct(F.lit(n).alias("slot"), F.col(n).alias("row_id")) for n in EXAMPLES]))
    chosen = ids.select("rule", slots.alias("s")).select("rule", "s.slot", "s.row_id").filter("row_id IS NOT NULL")
    texts = labelled.select("rule", "row_id", "body").join(chosen, ["rule", "row_id"])
    examples = texts.groupBy("rule").agg(
        *[clean_text(F.max(F.when(F.col("slot") == name, F.col("body")))).alias(name) for name in EXAMPLES]
    )
    return comments.join(examples, "rule", "left")


def fewshot_prompt(
    separator: str = V.SEPARATOR_PLACEHOLDER, flag_links: bool = False, clean_examples: bool = True
) -> Column:
    """The model input of a comment: body, rule and examples, each part cleaned.

    ``clean_examples=False`` is for examples that were cleaned before.
    """

    def part(name: str) -> Column:
        raw = name in EXAMPLES and not clean_examples
        return F.coalesce(F.col(name) if raw else clean_text(name), F.lit(""))

    def pair(title: str, first: str, second: str) -> Column:
        return F.concat(F.lit(title), part(first), F.lit(" | "), part(second))

    sections = [
        F.concat(F.lit(V.PROMPT_COMMENT), part("body")),
        F.concat(F.lit(V.PROMPT_RULE), part("rule")),
        pair(V.PROMPT_POSITIVE, *EXAMPLES[:2]),
        pair(V.PROMPT_NEGATIVE, *EXAMPLES[2:]),
    ]
    if flag_links:
        sections.append(F.concat(F.lit(V.PROMPT_LINK_FLAG), has_link("body").cast("string")))
    prompt = F.concat_ws(f" {V.SEPARATOR_PLACEHOLDER} ", *sections)
    return F.replace(prompt, F.lit(V.SEPARATOR_PLACEHOLDER), F.lit(separator))


def _validation_counts(sizes: DataFrame, test_size: float) -> DataFrame:
    """Adds ``need``: shares of ``ceil(test_size * total)``, largest remainder first.

    ``sizes`` has one row (_label, n) per class.
    """
    total = sizes.agg(F.sum("n")).scalar()
    wanted = F.ceil(F.lit(test_size) * total)
    share = wanted * F.col("n") / total
    shares = sizes.select(
        (F.floor(share) - share).alias("_rest"),
        F.col("_label").cast("string").alias("_name"),
        "_label",
        F.floor(share).alias("_floor"),
    )
    # Classes are ranked in ranges side by side; a range then adds the sizes of those before it, one row per range.
    ranged = shares.repartitionByRange("_rest", "_name").withColumn("_range", F.spark_partition_id())
    lists = ranged.groupBy("_range").agg(
        F.sort_array(F.collect_list(F.struct("_rest", "_name", "_label", "_floor"))).alias("_rows"),
        F.sum("_floor").alias("_floors"),
    )
    ranges = Window.orderBy("_range")
    before = F.sum(F.size("_rows")).over(ranges.rowsBetween(Window.unboundedPreceding, -1))
    floors = F.sum("_floors").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = lists.select(F.coalesce(before, F.lit(0)).alias("_before"), (wanted - floors).alias("_spare"), "_rows")
    ranked = ranked.select("_before", "_spare", F.posexplode("_rows").alias("_at", "_row"))
    one_more = (F.col("_before") + F.col("_at") < F.col("_spare")).cast("bigint")
    return ranked.select("_row._label", (F.col("_row._floor") + one_more).cast("bigint").alias("need"))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_size: float = 0.2,
    seed: int = 42,
    prefix_len: int = 4,
    levels: int = 2,
) -> DataFrame:
    """Add ``split`` ("train" / "val", null for a null label) with exact class shares.

    Rows of a class are ordered by ``md5(key:seed)`` and the first ones become
    the validation set. The cut hash of each class is found by histograms over
    hash prefixes: each level narrows the cut to one of 16^prefix_len parts of
    the part before, so a class with most of the rows is never sorted; only the
    rows of the last part are ranked. Any number of classes; nothing runs
    before the result is used.
    """
    code = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    rows = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("_label"), code.alias("_code"))
    need = _validation_counts(rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")), test_size)
    for level in range(1, levels + 1):
        prefix = F.substring("_code", 1, prefix_len * level)
        histogram = rows.groupBy("_label", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("_label").orderBy("_prefix"))
        edge = (
            histogram.withColumn("upto", upto)
            .join(need, "_label")
            .withColumn("need", F.col("need") - (F.col("upto") - F.col("n")))
            .filter((F.col("need") > 0) & (F.col("need") <= F.col("n")))
        )
        need = edge.select("_label", "need")
        parts = edge.select("_label", "_prefix")
        rows = rows.withColumn("_prefix", prefix).join(parts, ["_label", "_prefix"], "left_semi").drop("_prefix")
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_label").orderBy("_code")))
    cuts = ranked.join(need, "_label").filter(F.col("_rank") == F.col("need"))
    cuts = cuts.select(F.col("_label").alias("_class"), F.col("_code").alias("_cut"))
    joined = df.join(cuts, F.col(label) == F.col("_class"), "left")
    split = F.when(code <= F.col("_cut"), "val").when(F.col(label).isNotNull(), "train")
    return joined.withColumn("split", split).drop("_class", "_cut")


def split_summary(split: DataFrame, label: str) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("violation_rate")
    )


def predictions_from_logits(df: DataFrame, logits: str = "logits") -> DataFrame:
    return df.withColumn("prob_violation", positive_probability(logits))


def join_predictions(comments: DataFrame, predictions: DataFrame) -> DataFrame:
    """Predictions (row_id, true_label, prob_violation) with their comments."""
    return predictions.join(comments, "row_id")


def with_error_type(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add predicted_label (``prob >= threshold``) and error_type."""
    predicted, true = F.col("predicted_label"), F.col("true_label")
    return df.withColumn(
        "predicted_label", (F.col("prob_violation") >= threshold).cast("int")
    ).withColumn(
        "error_type",
        F.when(true == predicted, V.CORRECT)
        .when((true == 0) & (predicted == 1), V.FALSE_POSITIVE)
        .otherwise(V.FALSE_NEGATIVE),
    )


def evaluation(predictions: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row: AUC, rows, accuracy, and how many errors of each kind, of stored scores.

    ``predictions`` has row_id, true_label (0/1) and prob_violation; the model
    behind them does not matter. Rows without a label or a score do not count.
    """
    known = with_error_type(predictions.filter("true_label IS NOT NULL AND prob_violation IS NOT NULL"), threshold)
    kind = F.col("error_type")
    counts = known.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((kind == V.CORRECT).cast("double")).alias("accuracy"),
        F.count_if(kind == V.FALSE_POSITIVE).alias("false_positives"),
        F.count_if(kind == V.FALSE_NEGATIVE).alias("false_negatives"),
    )
    return counts.withColumn("auc", auc(predictions).scalar())


def top_errors(errors: DataFrame, comments: DataFrame, error_type: str, k: int = 3) -> DataFrame:
    """Most confident false positives, or least confident false negatives.

    The cut is made on the narrow prediction rows. The comments are then
    filtered by the ``k`` rows found, and links redacted in those only.
    """
    prob = F.col("prob_violation")
    order = prob.desc() if error_type == V.FALSE_POSITIVE else prob.asc()
    top = errors.filter(F.col("error_type") == error_type).orderBy(order, "row_id").limit(k)
    shown = comments.join(F.broadcast(top), "row_id")
    return shown.withColumn("body", redact_links("body")).orderBy(order, "row_id")


def auc(df: DataFrame, label: str = "true_label", score: str = "prob_violation") -> DataFrame:
    """Area under the ROC curve over all thresholds, ties averaged; one row.

    Labels above 0.5 are positive. Null unless both classes are present. Rows
    without a label or a score do not count. Nothing runs before the result is
    used: rows are combined per score, the scores are range-partitioned, and
    every range counts the pairs it wins by itself; what the ranges below add is
    one number per range. Counts are whole numbers until the last division.
    """
    rows = df.select((F.col(label).cast("double") > 0.5).cast("long").alias("p"), F.col(score).cast("double").alias("s")).dropna()
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scores = rows.groupBy("s").agg(F.sum("p").alias("p"), (F.count(F.lit(1)) - F.sum("p")).alias("n"))
    ranged = scores.repartitionByRange("s").withColumn("range", F.spark_partition_id())
    below = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = ranged.withColumn("below", below)
    # Twice the pairs that are won, a tie being half a pair.
    ranges = ranged.groupBy("range").agg(
        F.sum(whole("p") * (2 * F.col("below") + F.col("n")).cast("decimal(19,0)")).alias("twice"),
        F.sum("p").alias("p"),
        F.sum("n").alias("n"),
    )
    # One row per range: as many as there are partitions.
    earlier = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.withColumn("twice", F.col("twice") + 2 * whole("p") * F.coalesce(earlier, F.lit(0)).cast("decimal(18,0)"))
    won, pairs = F.sum("twice").cast("double"), 2.0 * F.sum("p").cast("double") * F.sum("n").cast("double")
    return ranges.agg(F.when(pairs > 0, won / pairs).alias("auc"))


def route_actions(df: DataFrame, auto_above: float = 0.95, threshold: float = 0.5) -> DataFrame:
    """Act automatically only on very sure predictions, review the other hits."""
    prob = F.col("prob_violation")
    return df.withColumn(
        "action",
        F.when(prob > auto_above, "auto_remove").when(prob >= threshold, "review").otherwise("keep"),
    )


def uncertain(df: DataFrame, low: float = 0.4, high: float = 0.6) -> DataFrame:
    """Rows to label again: the model is unsure."""
    return df.filter(F.col("prob_violation").between(low, high))


def prediction_record(threshold: float = 0.5) -> Column:
    """JSON answer of a prediction."""
    return F.to_json(
        F.struct(
            (F.col("prob_violation") >= threshold).alias("violation_predicted"),
            F.col("rule"),
            F.round("prob_violation", 4).alias("confidence_score"),
        )
    )


def hybrid_score(special_rules: Sequence[str], special: str, general: str) -> Column:
    """Use a simple model's score for some rules and the general one elsewhere."""
    return F.when(F.col("rule").isin(*special_rules), F.col(special)).otherwise(F.col(general))
