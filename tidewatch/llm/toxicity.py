"""Toxicity from the nearest labelled examples by TF-IDF cosine.

A bounded sample of labelled texts is the evidence. Terms (words and the first
letters of words) that toxic examples hold clearly more often than others span
the vector space; each example is a TF-IDF vector of unit length there. The
index lists the examples in blocks with the largest weight per term and block:
a query visits blocks in the order of their bound and stops when no other block
can hold a nearer example, so the neighbours are the exact ones. Their votes,
weighted by similarity and by how much of its class the sample holds, are
mapped to a probability by isotonic regression on examples left out in turn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import IS_WORD, LOWER, fresh, held_out, learning_row, row_blocks, span_hashes, table, text_bytes, word_spans

#: Labelled texts of each class that are taken (about as many, by a hash of the id).
EXAMPLES_PER_CLASS = 10_000
#: A term counts as evidence with so many toxic examples, this ratio of rates and this z value.
LEAST_EXAMPLES, LEAST_RATIO, LEAST_Z = 3, 10.0, 2.5
#: Terms of the space, the strongest first: the size of what is broadcast is bounded by it.
MOST_TERMS = 4096
STEM = 5
BLOCK = 64
NEIGHBOURS = 25
#: Left-out examples that the calibration is fitted on.
CALIBRATION = 1500


def term_hashes(column_data: np.ndarray, offsets: np.ndarray):
    """Hashes and rows of all terms: each word, and the head of each longer word."""
    low = LOWER[column_data]
    starts, ends, row = word_spans(low, offsets, IS_WORD)
    words = span_hashes(low, starts, ends)
    long = ends - starts > STEM
    heads = span_hashes(low, starts[long], starts[long] + STEM) ^ np.uint64(0x5DEECE66D)
    return np.concatenate([words, heads]), np.concatenate([row, row[long]])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: term, number of toxic and of other examples that hold it."""
    for batch in batches:
        toxic = batch.column("toxic").to_numpy().astype(np.int64)
        data, offsets = text_bytes(batch.column("text"))
        for a, b in row_blocks(offsets):
            terms, row = term_hashes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            order = np.lexsort((row, terms))
            terms, row = terms[order], row[order]
            new = np.ones(len(terms), bool)
            new[1:] = (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])
            unique, inverse = np.unique(terms[new], return_inverse=True)
            ones = np.bincount(inverse, toxic[a:b][row[new]], minlength=len(unique)).astype(np.int64)
            every = np.bincount(inverse, minlength=len(unique))
            yield pa.RecordBatch.from_arrays(
                [pa.array(unique.view(np.int64)), pa.array(ones), pa.array(every - ones)], ["term", "ones", "zeros"]
            )


class Vectors:
    """Query vectors over a sorted vocabulary."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray):
        order = np.argsort(terms)
        self.terms, self.idf = terms[order], idf[order]

    def of(self, data: np.ndarray, offsets: np.ndarray):
        """(row, term number, weight) of a block, sorted by row, unit length per row."""
        terms, row = term_hashes(data, offsets)
        if not len(self.terms) or not len(terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        key, counts = np.unique(row[known] * len(self.terms) + at[known], return_counts=True)
        row, term = key // len(self.terms), key % len(self.terms)
        weight = (1 + np.log(counts)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight, minlength=len(offsets)))
        return row, term, weight / norm[row]


def _vectors(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space: Vectors = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            blobs = []
            for first, end in row_blocks(offsets):
                row, term, weight = space.of(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                cuts = np.searchsorted(row, np.arange(end - first + 1))
                blobs += [term[a:b].astype("<i4").tobytes() + np.round(weight[a:b], 9).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(blobs, pa.binary())], ["doc_id", "toxic", "vector"]
            )

    return run


class BlockMaxIndex:
    """Examples with equal vectors are one entry; entries come in blocks of BLOCK."""

    def __init__(self, space: Vectors, rows: list, rate: tuple[float, float]):
        self.space = space
        entries: dict[bytes, list] = {}
        for blob, ones, zeros, least in rows:
            entries[bytes(blob)] = [ones, zeros, least]
        none = entries.pop(b"", [0, 0, None])
        # Votes count for the part of their class that was not taken into the sample.
        self.weights = rate
        base = none[0] * rate[0] + none[1] * rate[1]
        self.silent = (none[0] * rate[0] + 0.02) / (base + 1.0) if rows else 0.0
        vectors = []
        for blob, counts in entries.items():
            n = len(blob) // 12
            vectors.append((np.frombuffer(blob, "<i4", n), np.frombuffer(blob, "<f8", n, 4 * n), counts, blob))
        # Entries whose heaviest terms agree stand together, so block bounds are tight.
        vectors.sort(key=lambda v: (int(v[0][np.argmax(v[1])]), v[3]))
        self.ones = np.array([v[2][0] for v in vectors], float) * rate[0]
        self.zeros = np.array([v[2][1] for v in vectors], float) * rate[1]
        self.ids = [v[2][2] for v in vectors]
        self.own = {v[3]: k for k, v in enumerate(vectors)}
        self.blobs = [v[3] for v in vectors]
        self.cuts = np.cumsum([0] + [len(v[0]) for v in vectors])
        self.term = np.concatenate([v[0] for v in vectors]) if vectors else np.zeros(0, np.int64)
        self.value = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        blocks = -(-len(vectors) // BLOCK)
        self.most = np.zeros((max(len(space.terms), 1), max(blocks, 1)))
        block = np.repeat(np.arange(len(vectors)) // BLOCK, np.diff(self.cuts))
        np.maximum.at(self.most, (self.term, block), self.value)
        self.steps, self.levels = np.zeros(0), np.zeros(0)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int = NEIGHBOURS):
        """Entries and similarities of the k nearest (and of all as near as the last)."""
        bound = weight @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        query = np.zeros(len(self.most))
        query[term] = weight
        entries, sims = np.zeros(0, np.int64), np.zeros(0)
        last = 0.0
        for b in order:
            if bound[b] <= 0 or bound[b] < last - 1e-12:
                break
            first, end = b * BLOCK, min((b + 1) * BLOCK, len(self.ids))
            a, z = self.cuts[first], self.cuts[end]
            found = np.add.reduceat(self.value[a:z] * query[self.term[a:z]], self.cuts[first:end] - a)
            some = found > 0
            entries = np.concatenate([entries, np.flatnonzero(some) + first])
            sims = np.concatenate([sims, found[some]])
            if len(sims) >= k:
                last = np.partition(sims, len(sims) - k)[len(sims) - k]
        near = sims >= last - 1e-12
        entries, sims = entries[near], sims[near]
        order = np.lexsort((entries, -np.round(sims, 9)))
        return entries[order], sims[order]

    def vote(self, entries, sims, without: tuple[int, float, float] | None = None) -> float:
        """Share of toxic votes, each with the square of its similarity."""
        ones, zeros = self.ones[entries], self.zeros[entries]
        if without is not None:
            own = entries == without[0]
            ones, zeros = ones - own * without[1], zeros - own * without[2]
        w = sims * sims
        toxic, clean = float(w @ ones), float(w @ zeros)
        return (toxic + 0.5 * self.silent) / (toxic + clean + 0.5)

    def calibrate(self) -> None:
        """Isotonic map from votes to rates, by pooling neighbours that are out of order."""
        pick = range(0, len(self.ids), max(1, -(-len(self.ids) // CALIBRATION)))
        points = []
        for k in pick:
            a, z = self.cuts[k], self.cuts[k + 1]
            entries, sims = self.nearest(self.term[a:z], self.value[a:z])
            for count, label, one, zero in ((self.ones[k], 1.0, self.weights[0], 0.0), (self.zeros[k], 0.0, 0.0, self.weights[1])):
                if count > 0:
                    points.append((self.vote(entries, sims, (k, one, zero)), label, count))
        pools: list[list[float]] = []
        for v, y, w in sorted(points):
            pools.append([v, y * w, w])
            while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
                v_, a_, b_ = pools.pop()
                pools[-1] = [pools[-1][0], pools[-1][1] + a_, pools[-1][2] + b_]
        self.steps = np.array([p[0] for p in pools])
        self.levels = np.array([(p[1] + 0.02) / (p[2] + 0.04) for p in pools])

    def probability(self, vote: float) -> float:
        if not len(self.steps):
            return min(max(vote, 0.0), 1.0)
        return float(self.levels[max(np.searchsorted(self.steps, vote, "right") - 1, 0)])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES_PER_CLASS) -> BlockMaxIndex:
    """The index of a sample of the labelled texts, about ``per_class`` of each class.

    A document labelled both ways is toxic; labels other than 0 and 1 and null
    ids are left out; so are rows that are held out from learning.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col("toxic").isin(0, 1) & learning_row(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    steps = 1 << 20
    part = {c: math.ceil(min(1.0, per_class / max(sizes.get(c, 0), 1)) * steps) for c in (0, 1)}
    limit = F.when(F.col("toxic") == 1, part[1]).otherwise(part[0])
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("example")), F.lit(steps)) < limit)
    # Bounded by per_class, whatever the size of the corpus.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    taken = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    ones, zeros = taken.get(1, 0), taken.get(0, 0)
    rate = (sizes.get(1, 0) / max(ones, 1), sizes.get(0, 0) / max(zeros, 1))
    counts = texts.select("text", "toxic").mapInArrow(_term_counts, "term long, ones long, zeros long")
    counts = counts.groupBy("term").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    p1, p0 = (F.col("ones") + 0.5) / (ones + 1.0), (F.col("zeros") + 0.5) / (zeros + 1.0)
    z = (p1 - p0) / F.sqrt(p1 / (ones + 1.0) + p0 / (zeros + 1.0))
    strong = counts.filter((F.col("ones") >= LEAST_EXAMPLES) & (p1 > p0 * LEAST_RATIO)).withColumn("z", z)
    strong = strong.filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(MOST_TERMS)
    rows = strong.collect()
    terms = np.array([r.term for r in rows], np.int64).view(np.uint64)
    df = np.array([r.ones * rate[0] + r.zeros * rate[1] for r in rows])
    idf = np.log((sum(sizes.values()) + 1) / (df + 1)) + 1 if len(rows) else df
    space = Vectors(terms, idf)
    shared = spark.sparkContext.broadcast(space)
    vectors = texts.select("doc_id", "toxic", "text").mapInArrow(
        _vectors(shared), T.StructType([docs.schema["doc_id"], T.StructField("toxic", T.IntegerType()), T.StructField("vector", T.BinaryType())])
    )
    entries = vectors.groupBy("vector").agg(
        F.sum("toxic"), F.sum(1 - F.col("toxic")), F.min("doc_id").cast("string")
    )
    index = BlockMaxIndex(space, [tuple(r) for r in entries.collect()], rate)
    index.calibrate()
    return index


def _scores(shared, text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: BlockMaxIndex = shared.value
        seen: dict[bytes, tuple] = {}
        for batch in batches:
            n = batch.num_rows
            score, sim = np.full(n, index.silent), np.zeros(n)
            ids: list[str | None] = [None] * n
            data, offsets = text_bytes(batch.column(text))
            for a, b in row_blocks(offsets):
                row, term, weight = index.space.of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if not len(row):
                    continue
                new = np.flatnonzero(np.diff(row, prepend=-1))
                for i, j in zip(new, np.append(new[1:], len(row))):
                    key = term[i:j].astype("<i4").tobytes() + np.round(weight[i:j], 9).tobytes()
                    if key not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        entries, sims = index.nearest(term[i:j], weight[i:j])
                        p = index.probability(index.vote(entries, sims)) if len(entries) else index.silent
                        seen[key] = (p, sims[0] if len(sims) else 0.0, index.ids[entries[0]] if len(entries) else None)
                    at = a + row[i]
                    score[at], sim[at], ids[at] = seen[key]
            out = [pa.array(np.clip(score, 0.0, 1.0)), pa.array(np.round(sim, 9)), pa.array(ids, pa.string())]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, *out], [*batch.schema.names, *names])

    return run


def toxicity_scores(docs: DataFrame, index: BlockMaxIndex, text: str = "text") -> tuple[DataFrame, list[str]]:
    """Rows of ``docs`` with score, similarity and id of the nearest example, and the names of these.

    Null, empty and term-free texts get the rate of examples without terms;
    their nearest example is null. Without any labelled example every score is 0.
    """
    names = fresh(docs.columns, "score", "nearest_similarity", "nearest_id")
    fields = [T.StructField(c, k) for c, k in zip(names, (T.DoubleType(), T.DoubleType(), T.StringType()))]
    shared = docs.sparkSession.sparkContext.broadcast(index)
    return docs.mapInArrow(_scores(shared, text, names), T.StructType([*docs.schema.fields, *fields])), names


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more."""
    scored, names = toxicity_scores(docs, fit(docs, labels))
    return scored.filter(F.col(f"`{names[0]}`") < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored, (score, sim, near) = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(score).alias("score"),
        (F.col(score) >= 0.5).cast("int").alias("predicted"),
        F.col(sim).alias("nearest_similarity"),
        F.col(near).alias("nearest_id"),
    )
