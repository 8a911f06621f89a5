"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model.

The model is trained on the trusted texts, all of them. Its tokens are bytes,
each as it is, so no text of any script has an unknown token. N-gram counts are
combined per batch and summed by Spark over shards of n-grams; the counts of
each order come from those of the next longer one, and are joined shard by
shard to the totals of their contexts, which gives every n-gram its discounted
share and every context the weight of the shorter one. These count tables stay
tables, as large as the trusted texts make them.

Documents are dealt to chunks of bounded size. The distinct n-grams of a chunk
are joined shard by shard to the count tables of every order, and the
probabilities found go back to the chunk, where its texts add them up.
Perplexities are cut at quantiles of the trusted texts of each language.

``train`` and ``cross_entropy`` hold a small model instead, over bytes folded
into 64 classes, as one dense array per task; the query does not use them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import fresh, learning_row, row_blocks, table, text_bytes
from tidewatch.session import pin, unpin

ORDER = 4
SYMBOLS = 64
BITS = 6
#: Quantiles of the trusted texts of a language; below the low one a text is too repetitive.
LOW, HIGH = 0.002, 0.998
#: The median counts like so many symbols, as the mean over a short text says little.
PRIOR = 120
#: A language with fewer trusted texts is cut at the quantiles of all trusted texts.
LEAST_TEXTS = 50
#: Cross entropies are compared in steps of this size (nats per symbol).
STEP = 0.001
BREAK = 54
#: Bytes of an n-gram of the count tables, and bits of a byte.
LENGTH, BYTE_BITS = 4, 8
BYTE = np.arange(1 << BYTE_BITS, dtype=np.int64)
#: Bytes of text, about, that are scored together.
CHUNK_BYTES = 16 << 20
#: Bytes of text whose n-grams are numbers of 8 bytes at a time.
SPAN_BYTES = 2 << 20


def _alphabet() -> np.ndarray:
    out = np.full(256, 59)
    out[97:123] = np.arange(26)
    out[65:91] = 26 + np.arange(26)
    out[48:58] = 52
    out[[9, 11, 12, 13, 32]] = 53
    out[10] = BREAK
    out[[ord(c) for c in "."]] = 55
    out[[ord(c) for c in ",;:"]] = 56
    out[[ord(c) for c in "!?"]] = 57
    out[[ord(c) for c in "'\"()[]{}-_/"]] = 58
    high = np.arange(128, 256)
    out[128:] = np.where(high >= 0xC0, 60, 62) + (high & 1)
    return out


SYMBOL = _alphabet().astype(np.int32)


def ngrams(
    data: np.ndarray, offsets: np.ndarray, order: int = ORDER, symbols: np.ndarray = SYMBOL, bits: int = BITS
) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, as a number, and the row of each.

    ``symbols`` are those of the 256 bytes. A row begins after ``order - 1`` line breaks.
    """
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(data)) - offsets[:-1][row]
    symbol, pause = symbols[data], symbols[10]
    gram = np.zeros(len(data), symbols.dtype)
    for back in range(order - 1, -1, -1):
        one = np.full(len(data), pause, symbols.dtype)
        if back < len(data):
            one[back:] = symbol[: len(data) - back]
        gram = (gram << bits) | np.where(place >= back, one, pause)
    return gram, row


def _byte_ngrams(column: pa.Array, order: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, n-grams of bytes, row of each from 0) per block."""
    data, offsets = text_bytes(column)
    for a, b in row_blocks(offsets, SPAN_BYTES):
        yield a, b, *ngrams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], order, BYTE, BYTE_BITS)


def _counted(gram: np.ndarray) -> pa.RecordBatch:
    found, n = np.unique(gram, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in row_blocks(offsets):
            yield _counted(ngrams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0])


def _byte_counts(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, gram, _ in _byte_ngrams(batch.column("text"), order):
                yield _counted(gram)

    return run


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """What is taken from n-grams seen once, twice and more often."""
    if not ones or not twos:
        return 0.5, 0.5, 0.5
    y = ones / (ones + 2 * twos)
    d = [1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes if threes else 1.5]
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))


def order_tables(counts: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(gram, share) and (context, weight) of one order from its counts (gram, n)."""
    seen = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2, 3, 4)]
    d1, d2, d3 = discounts(*[x or 0 for x in counts.agg(*seen).first()])
    cut = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
    counts = counts.select("gram", F.shiftright("gram", bits).alias("context"), "n", cut.alias("d"))
    contexts = counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum("d").alias("d"))
    shares = counts.join(contexts.select("context", "total"), "context")
    return (
        shares.select("gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("share")),
        contexts.select("context", (F.col("d") / F.col("total")).alias("weight")),
    )


def count_tables(trusted: DataFrame, order: int = LENGTH) -> list[tuple[DataFrame, DataFrame]]:
    """``order_tables`` of the bytes of the column ``text``, for 1 to ``order`` bytes; all empty without text."""
    counts = trusted.select("text").mapInArrow(_byte_counts(order), "gram long, n long")
    counts = pin(counts.groupBy("gram").agg(F.sum("n").alias("n")))
    tables = []
    for k in range(order, 0, -1):
        tables.append(order_tables(counts, BYTE_BITS))
        # In how many ways an n-gram is continued to the left.
        shorter = counts.select(_last_bytes("gram", k - 1).alias("gram"))
        counts = pin(shorter.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))) if k > 1 else counts
    return tables[::-1]


def _last_bytes(gram: str, k: int) -> Column:
    return F.col(gram).bitwiseAND(F.lit((1 << (BYTE_BITS * k)) - 1).cast("long"))


def probabilities(wanted: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """gram and its probability ``p`` after its context, of the distinct n-grams ``wanted`` (gram).

    From the shortest order to the longest, each joined to its count tables by
    n-gram and by context; one that was never counted has what the shorter one has.
    """
    known = None
    for k, (shares, weights) in enumerate(tables, 1):
        asked = wanted.select(_last_bytes("gram", k).alias("gram")).distinct()
        found = asked.withColumn("context", F.shiftright("gram", BYTE_BITS)).join(shares, "gram", "left").join(weights, "context", "left")
        lower = F.lit(1 / len(BYTE))
        if known is not None:
            shorter = known.select(F.col("gram").alias("end"), F.col("p").alias("lower"))
            found, lower = found.withColumn("end", _last_bytes("gram", k - 1)).join(shorter, "end"), F.col("lower")
        p = F.coalesce(F.col("share"), F.lit(0.0)) + F.coalesce(F.col("weight"), F.lit(1.0)) * lower
        last, known = known, pin(found.select("gram", p.alias("p")))
        if last is not None:
            unpin(last)
    return known


def _distinct_of(order: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        parts = [np.unique(gram) for _, _, gram, _ in _byte_ngrams(rows.column("text"), order)]
        grams = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        chunk = pa.array(np.full(len(grams), key[0].as_py()), pa.int32())
        return pa.Table.from_arrays([chunk, pa.array(grams, pa.int64())], ["chunk", "gram"])

    return run


def _added_up(order: int):
    def run(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        grams, p = found.column("gram").to_numpy(), found.column("p").to_numpy()
        by = np.argsort(grams)
        grams, logs = grams[by], np.log(p[by])
        total, sizes = np.zeros(rows.num_rows), np.zeros(rows.num_rows, np.int64)
        for a, b, gram, row in _byte_ngrams(rows.column("text"), order):
            sizes[a:b] = np.bincount(row, minlength=b - a)
            if len(gram):
                total[a:b] = np.bincount(row, logs[np.searchsorted(grams, gram)], minlength=b - a)
        entropy = pa.array(-total / np.maximum(sizes, 1), mask=sizes == 0)
        kept = rows.drop_columns(["chunk", "text"])
        return kept.append_column("symbols", pa.array(sizes)).append_column("entropy", entropy)

    return run


def joined_entropy(docs: DataFrame, tables: list[tuple[DataFrame, DataFrame]], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, lang, ``symbols`` (bytes) and ``entropy`` (nats per byte) of every row of ``docs``, pinned.

    ``entropy`` is null for empty and null texts. Rows are dealt to chunks of
    about ``chunk_bytes`` by a hash of id and text; the distinct n-grams of a
    chunk move, and its texts, once for these and once to be scored.
    """
    order = len(tables)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-size // chunk_bytes) or 1)).cast("int").alias("chunk")
    dealt = docs.select(chunk, "doc_id", "lang", "text")
    pairs = pin(dealt.select("chunk", "text").groupBy("chunk").applyInArrow(_distinct_of(order), "chunk int, gram long"))
    known = probabilities(pin(pairs.select("gram").distinct()), tables)
    found = pairs.join(known, "gram").select("chunk", "gram", "p")
    fields = [docs.schema["doc_id"], docs.schema["lang"], T.StructField("symbols", T.LongType()), T.StructField("entropy", T.DoubleType())]
    both = dealt.groupBy("chunk").cogroup(found.groupBy("chunk"))
    scored = pin(both.applyInArrow(_added_up(order), T.StructType(fields)))
    unpin(pairs, known)
    return scored


class Model:
    """Log-probability of every n-gram, filled in from the tables of each order."""

    def __init__(self, tables: list[tuple[np.ndarray, ...]]):
        self.tables = tables
        self.dense: np.ndarray | None = None

    def __getstate__(self):
        return {"tables": self.tables, "dense": None}

    def logs(self) -> np.ndarray:
        """Built once per worker from the seen n-grams: at most SYMBOLS**ORDER numbers."""
        if self.dense is None:
            p = np.full((1, SYMBOLS), 1 / SYMBOLS, np.float32)
            for k, (grams, shares, contexts, weights) in enumerate(self.tables, 1):
                weight = np.ones(SYMBOLS ** (k - 1), np.float32)
                weight[contexts] = weights
                # The context without its first symbol repeats with that period.
                longer = np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS if k > 1 else 1, 1))
                longer *= weight[:, None]
                longer.ravel()[grams] += shares.astype(np.float32)
                p = longer
            self.dense = np.log(p, out=p).ravel()
        return self.dense


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that every label calls good, of rows that may be learned from."""
    known = labels.filter(F.col("quality").isNotNull() & learning_row(F.col("doc_id")))
    worst = known.groupBy("doc_id").agg(F.min("quality").alias("q"))
    # They grow with the corpus: never a broadcast.
    return worst.filter("q = 1").select("doc_id").hint("merge")


def train(trusted: DataFrame, order: int = ORDER) -> Model:
    """The model of the column ``text`` of all rows; without text every symbol is equally likely."""
    counts = trusted.select("text").mapInArrow(_counts, "gram long, n long")
    counts = pin(counts.groupBy("gram").agg(F.sum("n").alias("n")))
    tables = []
    for k in range(order, 0, -1):
        shares, weights = order_tables(counts)
        s, w = shares.toPandas(), weights.toPandas()  # at most SYMBOLS**k rows
        tables.append((s["gram"].to_numpy(np.int64), s["share"].to_numpy(float), w["context"].to_numpy(np.int64), w["weight"].to_numpy(float)))
        # In how many ways an n-gram is continued to the left.
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (BITS * (k - 1))) - 1))
        counts = counts.select(shorter.alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return Model(tables[::-1])


def _scores(shared, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        logs = model.logs()
        for batch in batches:
            data, offsets = text_bytes(batch.column(text))
            sizes = np.diff(offsets)
            total = np.zeros(batch.num_rows)
            for a, b in row_blocks(offsets):
                gram, row = ngrams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                total[a:b] = np.bincount(row, logs[gram], minlength=b - a)
            entropy = pa.array(-total / np.maximum(sizes, 1), mask=sizes == 0)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes), entropy], [*batch.schema.names, *names])

    return run


def cross_entropy(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, list[str]]:
    """Rows with their number of symbols and nats per symbol (null for empty and null texts)."""
    names = fresh(docs.columns, "symbols", "entropy")
    fields = [T.StructField(names[0], T.LongType()), T.StructField(names[1], T.DoubleType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scores(shared, text, names), T.StructType([*docs.schema.fields, *fields])), names


def quantile_steps(counts: list[tuple[int, int]], part: float) -> int:
    """The step below or at which ``part`` of the counted values lie."""
    counts = sorted(counts)
    total = sum(n for _, n in counts)
    for (step, _), upto in zip(counts, itertools.accumulate(n for _, n in counts)):
        if upto >= part * total:
            return step
    return 0


def _grouped(rows) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {}
    for r in rows:
        out.setdefault(r.lang, []).append((r.step, r["count"]))
    everything: dict[int, int] = {}
    for pairs in out.values():
        for step, n in pairs:
            everything[step] = everything.get(step, 0) + n
    few = [lang for lang, pairs in out.items() if sum(n for _, n in pairs) < LEAST_TEXTS]
    for lang in few:
        del out[lang]
    out[""] = list(everything.items())
    return out


def _case(lang: Column, values: dict[str, float]) -> Column:
    out = F.lit(float(values[""]))
    for name, value in values.items():
        if name:
            out = F.when(lang == name, float(value)).otherwise(out)
    return out


def judge(scored: DataFrame, trusted: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Adds ``adjusted``, ``least``, ``most`` and ``kept`` to doc_id, lang, symbols, entropy.

    Histograms of the trusted texts give each language's median and quantiles;
    languages are counted, so they are few. Texts without symbols are not kept.
    Without a trusted text nothing is known, and all other texts are kept.
    """
    lang = F.coalesce(F.col("lang"), F.lit(""))

    def steps(value: Column) -> dict[str, list[tuple[int, int]]]:
        good = base.join(trusted, "doc_id", "left_semi").filter("entropy IS NOT NULL")
        step = F.round(value / STEP).cast("int").alias("step")
        return _grouped(good.select(lang.alias("lang"), step).groupBy("lang", "step").count().collect())

    base = scored
    middle = {k: quantile_steps(v, 0.5) * STEP for k, v in steps(F.col("entropy")).items()}
    n = F.col("symbols")
    adjusted = (n * F.col("entropy") + PRIOR * _case(lang, middle)) / (n + PRIOR)
    base = scored.withColumn("adjusted", adjusted)
    found = steps(F.col("adjusted"))
    if not found[""]:
        kept = F.col("entropy").isNotNull()
        return base.withColumns({"least": F.lit(0.0), "most": F.lit(float("inf")), "kept": kept})
    least = {k: (quantile_steps(v, low) - 1) * STEP for k, v in found.items()}
    most = {k: (quantile_steps(v, high) + 1) * STEP for k, v in found.items()}
    base = base.withColumns({"least": _case(lang, least), "most": _case(lang, most)})
    return base.withColumn("kept", F.coalesce(F.col("adjusted").between(F.col("least"), F.col("most")), F.lit(False)))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, lang): symbols, perplexity and whether it is kept.

    Rows whose id is labelled good throughout are trusted. A null language is
    one of its own. Repeated rows have the same result each; an empty table
    gives none.
    """
    trusted = trusted_ids(labels)
    texts = docs.select("doc_id", "text").join(trusted, "doc_id", "left_semi")
    return judge(joined_entropy(docs.select("doc_id", "lang", "text"), count_tables(texts)), trusted)


def op10_quality(spark, sf_dir: str) -> DataFrame:
    """Perplexity is per byte; thresholds are on the adjusted cross entropy in nats."""
    found = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        "symbols",
        F.round(F.exp("entropy"), 6).alias("perplexity"),
        F.round("adjusted", 6).alias("adjusted_entropy"),
        F.col("least").alias("least_entropy"),
        F.col("most").alias("most_entropy"),
        "kept",
    )
