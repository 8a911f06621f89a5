"""Benchmark decontamination with suffix arrays over shards of the training texts.

Each block of documents is a shard. Its words become numbers of the benchmark's
vocabulary (0 for all others, which no benchmark text can match), and a suffix
array orders the places where a match can begin. Every benchmark suffix is
searched in it by bisection, word by word; places that agree over a whole window
are joined along their diagonal to the longest verbatim matches.

Nothing moves between tasks. The benchmark is broadcast in blocks of bounded
size, each in a pass of its own, so any benchmark is searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import fresh, hashed_words, list_array, mix, powers, table, text_bytes, word_blocks

WINDOW = 10
#: Benchmark text of one broadcast; a larger benchmark takes several passes.
BROADCAST_BYTES = 16 << 20

MATCH = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.StringType()),
            T.StructField("item_start", T.LongType()),
            T.StructField("doc_start", T.LongType()),
            T.StructField("length", T.LongType()),
        ]
    )
)


class Targets:
    """The suffixes of a block of benchmark items, as numbers of their vocabulary."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        names = [name for name, _ in items]
        data, offsets = text_bytes(pa.array([text for _, text in items], pa.large_string()))
        words, row = hashed_words(data, offsets)
        self.vocabulary = np.unique(words)
        self.ids = np.searchsorted(self.vocabulary, words).astype(np.int64) + 1
        self.word_item = row
        counts = np.bincount(row, minlength=len(items)).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        place = np.arange(len(words)) - firsts[row]
        need = np.minimum(counts, window)[row]
        whole = place + need <= counts[row]
        # Suffixes too short for a window of their item can never be a hit.
        self.suffix = np.flatnonzero(whole)
        self.need = need[whole]
        self.item = row[whole]
        self.place = place[whole]
        self.names = np.array(names, object)
        self.least = int(self.need.min()) if len(self.need) else 0


def suffix_array(ids: np.ndarray, row: np.ndarray, begin: np.ndarray, depth: int, top: int):
    """The places ``begin`` in order of the ``depth`` words that follow each."""
    bits = max(int(top).bit_length(), 1)
    per = max(63 // bits, 1)
    keys = []
    for k in range(0, depth, per):
        key = np.zeros(len(begin), np.int64)
        for j in range(k, k + per):
            key = (key << bits) | word_at(ids, row, begin, j)
        keys.append(key)
    return begin[np.lexsort(keys[::-1])]


def word_at(ids: np.ndarray, row: np.ndarray, begin: np.ndarray, step: int) -> np.ndarray:
    """The word ``step`` words after each place, 0 beyond the end of its row."""
    at = np.minimum(begin + step, len(ids) - 1)
    return np.where((begin + step < len(ids)) & (row[at] == row[begin]), ids[at], 0)


def narrowed(ids, row, order, low, high, step, wanted):
    """Bisect each range of the suffix array to the suffixes with ``wanted`` at ``step``."""

    def bound(after_equal: bool) -> np.ndarray:
        lo, hi = low.copy(), high.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            word = word_at(ids, row, order[np.minimum(mid, len(order) - 1)], step)
            right = (word <= wanted) if after_equal else (word < wanted)
            lo = np.where(open_ & right, mid + 1, lo)
            hi = np.where(open_ & ~right, mid, hi)
        return lo

    return bound(False), bound(True)


def shard_matches(words: np.ndarray, row: np.ndarray, targets: Targets, window: int):
    """Row, item, start in the item, start in the block and length of the longest matches."""
    none = [np.zeros(0, np.int64)] * 5
    if not len(words) or not len(targets.suffix):
        return none
    found = np.minimum(np.searchsorted(targets.vocabulary, words), len(targets.vocabulary) - 1)
    ids = np.where(targets.vocabulary[found] == words, found + 1, 0).astype(np.int64)
    begin = np.flatnonzero(ids)
    for step in range(1, min(targets.least, window)):
        begin = begin[word_at(ids, row, begin, step) > 0]
    if not len(begin):
        return none
    order = suffix_array(ids, row, begin, window, len(targets.vocabulary))
    active = np.arange(len(targets.suffix))
    low, high = np.zeros(len(active), np.int64), np.full(len(active), len(order), np.int64)
    done = []
    for step in range(window):
        wanted = targets.ids[targets.suffix[active] + step]
        low, high = narrowed(ids, row, order, low, high, step, wanted)
        some = low < high
        active, low, high = active[some], low[some], high[some]
        ready = targets.need[active] == step + 1
        done.append((active[ready], low[ready], high[ready]))
        active, low, high = active[~ready], low[~ready], high[~ready]
        if not len(active):
            break
    hit = np.concatenate([d[0] for d in done])
    lows, highs = (np.concatenate([d[i] for d in done]) for i in (1, 2))
    which, place = left_maximal(targets, hit, lows, highs, ids, row, order)
    if not len(place):
        return none
    item, start = targets.item[which], targets.place[which]
    length = common_length(targets, which, ids, row, place)
    by = np.lexsort((place - start, place, row[place]))
    return [x[by] for x in (row[place], item, start, place, length)]


def left_maximal(targets: Targets, hit, lows, highs, ids, row, order):
    """Item suffixes and places of their windows at which a match begins.

    A match goes on to the left where the words before both are equal; such
    pairs are never made. So a text and an item of one repeated word have as many
    pairs as words, not as many as their product.
    """
    before_item = np.where(targets.place[hit] > 0, targets.ids[targets.suffix[hit] - 1], -1)
    places = order[: int(highs.max(initial=0))]
    before_doc = np.where((places > 0) & (row[places - 1] == row[places]), ids[places - 1], -2)
    # Places of each window by the word before them.
    ranges, of = np.unique(np.stack([lows, highs], axis=1), axis=0, return_inverse=True)
    of = of.ravel()
    sizes = ranges[:, 1] - ranges[:, 0]
    group = np.repeat(np.arange(len(ranges)), sizes)
    flat = np.repeat(ranges[:, 0] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    by = np.lexsort((before_doc[flat], group))
    flat, key = flat[by], group[by] * (len(targets.vocabulary) + 4) + before_doc[flat[by]] + 2
    wanted = of * (len(targets.vocabulary) + 4) + before_item + 2
    first = np.concatenate([[0], np.cumsum(sizes)])
    same_from, same_to = np.searchsorted(key, wanted), np.searchsorted(key, wanted, "right")
    # For each suffix, the places of its window without those that have the same word before.
    spans = [(first[of], same_from), (same_to, first[of + 1])]
    whose, at = [], []
    for low, high in spans:
        n = high - low
        whose.append(np.repeat(np.arange(len(hit)), n))
        at.append(np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum()))
    return hit[np.concatenate(whose)], places[flat[np.concatenate(at)]]


def common_length(targets: Targets, which, ids, row, place) -> np.ndarray:
    """How many words item suffixes and places have in common, by bisection over hashes of runs."""
    item_end = np.searchsorted(targets.word_item, targets.item[which], "right")
    low = targets.need[which].astype(np.int64)
    begin = targets.suffix[which]
    high = np.minimum(item_end - begin, np.searchsorted(row, row[place], "right") - place)
    up, down = powers(max(len(ids), len(targets.ids)) + 1)

    def sums(numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(mix(numbers.astype(np.uint64) + np.uint64(0x9E3779B9)) * up[: len(numbers)], out=out[1:])
        return out

    in_items, in_docs = sums(targets.ids), sums(ids)
    while (open_ := low < high).any():
        middle = (low + high + 1) >> 1
        one = (in_items[begin + middle] - in_items[begin]) * down[begin]
        two = (in_docs[place + middle] - in_docs[place]) * down[place]
        equal = one == two
        low, high = np.where(open_ & equal, middle, low), np.where(open_ & ~equal, middle - 1, high)
    return low


def _search(targets_in, window: int, text: str, count: str, matches: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        targets = targets_in.value
        for batch in batches:
            n = batch.num_rows
            words_of = np.zeros(n, np.int64)
            hits = np.zeros(n, np.int64)
            parts = []
            for a, b, words, row in word_blocks(batch.column(text)):
                counts = np.bincount(row, minlength=b - a)
                words_of[a:b] = counts
                owner, item, start, place, length = shard_matches(words, row, targets, window)
                firsts = np.cumsum(counts) - counts
                hits[a:b] = np.bincount(owner, minlength=b - a)
                parts.append((targets.names[item], start, place - firsts[owner], length))
            joined = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(4)]
            values = pa.StructArray.from_arrays(
                [pa.array(joined[0], pa.string())] + [pa.array(x.astype(np.int64)) for x in joined[1:]],
                ["item_id", "item_start", "doc_start", "length"],
            )
            lists = list_array(values, hits)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            names = list(batch.schema.names)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(words_of), lists], [*names, count, matches])

    return run


def benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, str, str]:
    """Rows of ``docs`` with their word count and longest verbatim benchmark matches.

    Returns the frame and the names of its two new columns (``n_words`` and
    ``matches``, with underscores in front where the names are taken). A match
    is at least ``window`` words long, or is a whole item of fewer words; items
    and rows without words match nothing. Null text is empty; repeated rows each
    get their own result; empty tables give no rows or no matches; a null item
    id is the item "".
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("said")
    )
    size = items.agg(F.sum(F.coalesce(F.octet_length("said"), F.lit(0)))).first()[0] or 0
    blocks = -(-size // broadcast_bytes) or 1
    count, found = fresh(docs.columns, "n_words", "matches")
    out = docs
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("name", "said"), F.lit(blocks)) == k)
        targets = Targets([tuple(r) for r in part.orderBy("name", "said").collect()], window)
        count_k, found_k = fresh(out.columns, "n_words", "matches")
        schema = T.StructType([*out.schema.fields, T.StructField(count_k, T.LongType()), T.StructField(found_k, MATCH)])
        shared = spark.sparkContext.broadcast(targets)
        out = out.mapInArrow(_search(shared, window, text, count_k, found_k), schema)
        if k:
            out = out.withColumn(found, F.concat(found, found_k)).drop(count_k, found_k)
    return out, count, found


def hit_words(matches: str):
    """How many words of a document lie inside at least one match (native)."""
    runs = F.array_sort(F.transform(matches, lambda m: F.struct(m.doc_start.alias("a"), (m.doc_start + m.length).alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def add(state, run):
        new = F.greatest(run.b - F.greatest(run.a, state.upto), F.lit(0).cast("long"))
        return F.struct((state.n + new).alias("n"), F.greatest(state.upto, run.b).alias("upto"))

    return F.aggregate(runs, start, add, lambda s: s.n)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest match."""
    found, count, matches = benchmark_matches(docs.select("doc_id", "text"), benchmark, window)
    items = F.array_sort(F.array_distinct(F.transform(matches, lambda m: m.item_id)))
    hit = hit_words(matches)
    return found.select(
        "doc_id",
        F.col(count).alias("n_words"),
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(matches) > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform(matches, lambda m: m.length)), F.lit(0).cast("long")).alias("longest_match"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a benchmark match, with their own columns only."""
    found, _, matches = benchmark_matches(docs, benchmark, window)
    return found.filter(F.size(matches) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS l, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(s) WHERE len(w) > 0),
lens AS (SELECT DISTINCT l FROM bw),
dw AS (
  SELECT doc_id, p, l, array_to_string(w[p : p + l - 1], ' ') AS win
  FROM d, lens, unnest(range(1, greatest(len(w) - l + 2, 1))) AS t(p)),
hit AS (SELECT doc_id, item_id, p, l FROM dw JOIN bw USING (l, win)),
words AS (SELECT doc_id, count(DISTINCT q) AS n FROM hit, unnest(range(p, p + l)) AS t(q) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS s
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id),
runs AS (
  SELECT doc_id, item_id, max(n + l - 1) AS n FROM (
    SELECT doc_id, item_id, l, count(*) AS n FROM (
      SELECT h.doc_id, h.item_id, h.p, h.l, s.s - h.p AS diag,
        h.p - row_number() OVER (PARTITION BY h.doc_id, h.item_id, s.s - h.p ORDER BY h.p) AS island
      FROM hit h JOIN (SELECT item_id, s, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
        FROM b, unnest(range(1, greatest(len(w) - 8, 2))) AS t(s) WHERE len(w) > 0) s
      ON h.item_id = s.item_id JOIN dw ON dw.doc_id = h.doc_id AND dw.p = h.p AND dw.l = h.l AND dw.win = s.win)
    GROUP BY doc_id, item_id, l, diag, island) GROUP BY doc_id, item_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit,
  coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
  words.n IS NOT NULL AS contaminated,
  coalesce((SELECT max(n) FROM runs WHERE runs.doc_id = d.doc_id), 0)::BIGINT AS longest_match
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
