"""K-d tree partitioning of documents into shards of near equal bytes.

A node is split at the weighted median of its widest metadata dimension. Medians
are found from histograms of byte counts over key prefixes, refined until the
remaining bucket is a small part of a shard; only histograms of a fixed size
reach the driver. All columns are native expressions; texts are read once and
never move.

A key is (dimension value, hash of the text), so equal texts stay on one side of
every cut. Only a group of equal texts heavier than the tolerance may be cut,
by a hash of its rows, as one group can hold more bytes than a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.session import pin

#: Bits of a dimension value, of the text hash and of the row hash.
VALUE_BITS, TEXT_BITS, ROW_BITS = 28, 34, 40
KEY_BITS = VALUE_BITS + TEXT_BITS
HISTOGRAM_BITS = 12
#: A cut may miss the exact median by this part of the bytes of a shard.
TOLERANCE = 0.002


@dataclass
class Cut:
    """Rows with (key, row hash) below the bound go left."""

    dimension: str
    key: int
    row: int

    def left(self) -> Column:
        key = F.col(self.dimension)
        return (key < self.key) | ((key == self.key) & (F.col("_row") < self.row))


def scaled(value: Column, low: float, high: float) -> Column:
    """A number as an integer of VALUE_BITS bits; nulls and NaN count as lowest."""
    top = (1 << VALUE_BITS) - 1
    part = (value.cast("double") - F.lit(low)) / F.lit(max(high - low, 1e-300))
    part = F.coalesce(F.nanvl(part, F.lit(0.0)), F.lit(0.0))
    return F.least(F.greatest((part * top).cast("long"), F.lit(0).cast("long")), F.lit(top).cast("long"))


def _median_cut(rows: DataFrame, dimension: str, share: float, slack: float) -> Cut:
    """The cut of a node's rows whose left side has ``share`` of the bytes."""
    total = rows.agg(F.sum("_size")).first()[0] or 0
    goal, below = total * share, 0
    prefix, known, column, width = 0, 0, dimension, KEY_BITS
    fixed = None
    here = rows
    while True:
        step = min(HISTOGRAM_BITS, width - known)
        shift = width - known - step
        bucket = F.shiftrightunsigned(F.col(column), shift)
        found = here.groupBy(bucket.alias("b")).agg(F.sum("_size").alias("w")).collect()
        weights = sorted((r.b, r.w) for r in found)
        last = None
        for b, w in weights:
            last = (b, w)
            if below + w >= goal:
                break
            below += w
        if last is None:
            return Cut(dimension, 0, 0)
        b, w = last
        if below + w <= goal:  # everything seen so far belongs to the left
            b, w = b + 1, 0
        if w <= slack or (shift == 0 and fixed is not None):
            after = goal - below > w / 2
            edge = (b + after) << shift
            return Cut(dimension, edge, 0) if fixed is None else Cut(dimension, fixed, edge)
        known, prefix = known + step, b
        here = here.filter(bucket == prefix)
        if shift == 0:  # one group of equal texts is heavier than the slack: cut inside
            fixed, column, width, known = prefix, "_row", ROW_BITS, 0


def _widest(rows: DataFrame, dimensions: list[str]) -> str:
    """The dimension with the largest weighted standard deviation of its value."""
    sums = []
    for d in dimensions:
        value = F.shiftrightunsigned(F.col(d), TEXT_BITS).cast("double") / float(1 << VALUE_BITS)
        size = F.col("_size").cast("double")
        sums += [F.sum(size * value).alias(f"{d}_1"), F.sum(size * value * value).alias(f"{d}_2")]
    r = rows.agg(F.sum(F.col("_size").cast("double")).alias("w"), *sums).first()
    if not r.w:
        return dimensions[0]
    spread = {d: r[f"{d}_2"] / r.w - (r[f"{d}_1"] / r.w) ** 2 for d in dimensions}
    return max(dimensions, key=lambda d: (round(spread[d], 9), -dimensions.index(d)))


def kd_shards(
    docs: DataFrame, shards: int = 8, text: str = "text", metadata: tuple[str, ...] = ("n_chars", "lang", "source")
) -> DataFrame:
    """Rows as (doc_id, size, text_crc32, shard, slot), and no texts.

    ``size`` is the UTF-8 bytes of the text plus 1; null text has no bytes.
    Dimensions: the size (its logarithm) and each ``metadata`` column that
    exists; numbers by value, others by a hash, null lowest. Metadata of equal
    texts may differ; the values of the group's smallest row hold for all of it.
    Slots count the rows of a shard from 0 without gaps. Repeated rows are rows
    of their own. An empty table gives no rows.
    """
    present = [c for c in metadata if c in docs.columns]
    kinds = dict(docs.dtypes)

    def coordinate(c: str) -> Column:
        number = kinds[c] in ("tinyint", "smallint", "int", "bigint", "float", "double") or kinds[c].startswith("decimal")
        if number:
            return F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0)))
        return F.crc32(F.col(c).cast("string").cast("binary")).cast("double")

    said = F.col(text)
    narrow = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(said), F.lit(0)) + 1).cast("long").alias("_size"),
        F.crc32(F.coalesce(said, F.lit("")).cast("binary")).cast("long").alias("_crc"),
        F.xxhash64(said).alias("_text"),
        *[coordinate(c).alias(f"_m{k}") for k, c in enumerate(present)],
    ).withColumn("_at", F.monotonically_increasing_id())
    # Written once: row numbers and sizes are the same in every later pass.
    narrow = pin(narrow)
    names = ["_log", *[f"_m{k}" for k in range(len(present))]]
    if present:
        # One value per group of equal texts, by a combinable minimum.
        firsts = narrow.groupBy("_text", "_size").agg(*[F.min(c).alias(c) for c in names[1:]])
        narrow = narrow.drop(*names[1:]).join(firsts, ["_text", "_size"])
    narrow = narrow.withColumn("_log", F.log1p(F.col("_size").cast("double")))
    ranges = narrow.agg(*[f(c).alias(f"{c}_{s}") for c in names for f, s in ((F.min, "a"), (F.max, "b"))]).first()
    tail = F.shiftrightunsigned(F.col("_text"), 64 - TEXT_BITS)
    keyed = pin(
        narrow.select(
            "doc_id",
            "_size",
            "_crc",
            "_at",
            F.shiftrightunsigned(F.xxhash64("_at"), 64 - ROW_BITS).alias("_row"),
            *[
                (F.shiftleft(scaled(F.col(c), ranges[f"{c}_a"] or 0.0, ranges[f"{c}_b"] or 0.0), TEXT_BITS) + tail).alias(c)
                for c in names
            ],
        )
    )
    total = keyed.agg(F.sum("_size")).first()[0] or 0
    slack = TOLERANCE * total / max(shards, 1)

    def tree(rows: DataFrame, first: int, count: int) -> Column:
        if count == 1:
            return F.lit(first)
        half = count // 2
        cut = _median_cut(rows, _widest(rows, names), half / count, slack)
        left = cut.left()
        return F.when(left, tree(rows.filter(left), first, half)).otherwise(
            tree(rows.filter(~left), first + half, count - half)
        )

    placed = keyed.select("doc_id", "_size", "_crc", "_at", tree(keyed, 0, shards).cast("int").alias("shard"))
    # Rows of a shard are numbered per part of the stored table, parts by a running count.
    placed = placed.withColumn("_part", F.shiftrightunsigned("_at", 33))
    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy("shard", "_part").orderBy("_at")
    return (
        placed.withColumn("_k", F.row_number().over(inner) - 1)
        .join(offsets, ["shard", "_part"])
        .select(
            "doc_id",
            F.col("_size").alias("size"),
            F.col("_crc").alias("text_crc32"),
            "shard",
            (F.col("_k") + F.col("_offset")).cast("long").alias("slot"),
        )
    )


def op3_kd_sharding(spark, sf_dir: str) -> DataFrame:
    found = kd_shards(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
