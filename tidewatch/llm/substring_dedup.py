"""Repeated passages, found by FM-indexes over shards of the corpus and removed.

A window is a run of 20 words. Its anchor is the least hash among its runs of
six words, so equal windows have equal anchors wherever they stand, and windows
that follow each other mostly share one: a segment is the stretch of windows, at
most fifteen, that share a standing anchor. Segments are the documents as the
shards see them.

1. Anchors are counted over all documents. A window whose anchor occurs once
   occurs once; all other segments are candidates.
2. Candidate segments are combined (a task hands on equal ones once, with their
   first place) and dealt to shards by anchor. Anchors of many segments are dealt
   window by window, by the content of the window, so no anchor makes a shard
   large.
3. Each shard builds an FM-index of its segments: suffix array, Burrows-Wheeler
   transform, wavelet matrix of packed bits with counts. Every segment is
   streamed through it: backward search from the end of each window, one word
   at a time, until the interval holds the whole window or one suffix only. The
   least place in the interval is where the window occurs first.
4. Those first windows are reported as intervals. All other windows of candidate
   segments are repeats; their words go.

Places are numbers in the order (doc_id, position), so "earlier" is "less".
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import IS_DARK, mix, powers, row_blocks, span_hashes, table, text_bytes, word_spans
from tidewatch.session import pin, unpin

WINDOW, ANCHOR = 20, 6
MOST_WINDOWS = WINDOW - ANCHOR + 1
#: Segments of one anchor from which its windows are dealt one by one.
HOT = 4096
SHARD_WORDS = 400_000
BLOCK = 2 << 20
PLACE_BITS = 40


# --- documents in order ------------------------------------------------------


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = TaskContext.get().partitionId() << PLACE_BITS
    for batch in batches:
        steps = batch.column(1).to_numpy()
        ends = at + np.cumsum(steps)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends - steps)], names=["row", "place"])
        at = int(ends[-1]) if len(ends) else at


def places(base: DataFrame) -> DataFrame:
    """(row, place): places rise with doc_id, and leave room for a number of each word. No text moves."""
    order = ["doc_id", "h", "row"]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    narrow = base.select("row", size.alias("size"), "doc_id", F.xxhash64("text").alias("h"))
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "size")
    return pin(ranged.mapInArrow(_placed, "row long, place long"))


# --- windows and their anchors -----------------------------------------------


def words_of(column: pa.Array):
    """(first row, last row + 1, bytes, offsets, word starts, word ends, rows of the words) per block."""
    data, offsets = text_bytes(column)
    for a, b in row_blocks(offsets, BLOCK):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        yield a, b, part, cuts, *word_spans(part, cuts, IS_DARK)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    n = max(len(words) - size + 1, 0)
    return mix((sums[size : size + n] - sums[:n]) * down[:n])


def segments(words: np.ndarray, rows: np.ndarray):
    """(anchor, first window, number of windows) of each segment; windows are numbered by their first word."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    least = run_hashes(words, ANCHOR)
    at = np.arange(len(least))  # where the least stands, the leftmost of equal ones
    reach = 1
    while reach < MOST_WINDOWS:
        step = min(reach, MOST_WINDOWS - reach)
        right = least[step:] < least[:-step]
        at = np.where(right, at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        reach += step
    starts = np.flatnonzero(rows[:n] == rows[WINDOW - 1 :])
    least, at = least[starts], at[starts]
    # One standing anchor, one segment: no two windows of a segment are equal.
    new = np.ones(len(starts), bool)
    new[1:] = at[1:] != at[:-1]
    cut = np.flatnonzero(new)
    return least[cut], starts[cut], np.diff(np.append(cut, len(starts)))


def _first_words(rows: np.ndarray, n_rows: int) -> np.ndarray:
    return np.searchsorted(rows, np.arange(n_rows))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = batch.column(0).to_numpy()
        for a, b, data, _, starts, ends, rows in words_of(batch.column(1)):
            anchors, first, n = segments(span_hashes(data, starts, ends), rows)
            row = rows[first]
            span = (first - _first_words(rows, b - a)[row]) * 16 + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.view(np.int64)), pa.array(key[a:b][row]), pa.array(span)], names=["anchor", "row", "span"]
            )


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, kept: np.ndarray, n_rows: int):
    """The kept words, one space between those of a row; and for each byte of ``data`` how many come before it."""
    n_kept = np.bincount(rows[kept], minlength=n_rows)
    last = np.zeros(len(starts), bool)
    last[np.flatnonzero(kept)[np.cumsum(n_kept)[n_kept > 0] - 1]] = True
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    stay = np.cumsum(edge[: len(data)], dtype=np.int8).astype(bool)
    # The byte after a word, where another follows in its row, becomes the space.
    gaps = ends[kept & ~last]
    stay[gaps] = True
    out = data.copy()
    out[gaps] = 32
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stay, out=before[1:])
    return out[stay], before


# --- candidate segments with their words -------------------------------------


class _Seen:
    """Hashes that a task has handed on, with the least place of each."""

    def __init__(self):
        self.hashes, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def fresh(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which of these are new or stand earlier than before, one for each hash."""
        order = np.lexsort((at, hashes))
        first = np.ones(len(order), bool)
        first[1:] = hashes[order][1:] != hashes[order][:-1]
        keep = order[first]
        found = np.searchsorted(self.hashes, hashes[keep])
        known = found < len(self.hashes)
        known[known] = self.hashes[found[known]] == hashes[keep][known]
        known[known] = self.at[found[known]] <= at[keep][known]
        keep = keep[~known]
        all_hashes, all_at = np.concatenate([self.hashes, hashes[keep]]), np.concatenate([self.at, at[keep]])
        order = np.lexsort((all_at, all_hashes))
        first = np.ones(len(order), bool)
        first[1:] = all_hashes[order][1:] != all_hashes[order][:-1]
        self.hashes, self.at = all_hashes[order][first], all_at[order][first]
        return keep


def _candidates(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            place, marks = batch.column(0).to_numpy(), batch.column(2)
            cuts, flat = marks.offsets.to_numpy(), marks.flatten().to_numpy()
            cuts = cuts - cuts[0]
            for a, b, data, _, starts, ends, rows in words_of(batch.column(1)):
                own = flat[cuts[a] : cuts[b]]
                if not len(own):
                    continue
                words = span_hashes(data, starts, ends)
                row = np.repeat(np.arange(b - a), np.diff(cuts[a : b + 1]))
                hot, n, begin = own & 1, (own >> 1) & 15, own >> 5
                first = begin + _first_words(rows, b - a)[row]
                at = place[a:b][row] + begin
                # Windows of hot anchors one by one, other segments whole.
                each = np.where(hot == 1, n, 1)
                inner = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                first, at, row = np.repeat(first, each) + inner, np.repeat(at, each) + inner, np.repeat(row, each)
                hot = np.repeat(hot, each)
                length = np.where(hot == 1, WINDOW, np.repeat(n, each) + WINDOW - 1)
                up, down = powers(len(words) + 1)
                sums = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(words * up[: len(words)], out=sums[1:])
                hashes = mix((sums[first + length] - sums[first]) * down[first] + length.astype(np.uint64))
                runs = run_hashes(words, ANCHOR)
                anchor = runs[first]
                for k in range(1, MOST_WINDOWS):  # the least of any window of the segment is its anchor
                    anchor = np.minimum(anchor, runs[first + k])
                shard = np.where(hot == 1, hashes, mix(anchor)) % np.uint64(shards)
                keep = seen.fresh(hashes, at)
                text, before = spaced(data, starts, ends, rows, np.ones(len(starts), bool), b - a)
                left, right = before[starts[first[keep]]], before[ends[first[keep] + length[keep] - 1]]
                offsets = np.zeros(len(keep) + 1, np.int64)
                np.cumsum(right - left, out=offsets[1:])
                index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - left, right - left)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(text[index])]
                codes = pa.LargeStringArray.from_buffers(len(keep), buffers[1], buffers[2])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[keep].astype(np.int64)),
                        codes.cast(pa.string()),
                        pa.array(at[keep]),
                        pa.array(place[a:b][row[keep]]),
                    ],
                    names=["shard", "code", "at", "place"],
                )

    return run


# --- the index of a shard ----------------------------------------------------


class Bits:
    """Packed bits that tell how many ones stand before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(64 - len(bits) % 64, bool)), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int32, out=self.before[1:])

    def ones(self, upto: np.ndarray) -> np.ndarray:
        word = upto >> 6
        mask = (np.uint64(1) << (upto & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class FMIndex:
    """Compressed full-text index of many sequences over numbers from 1; they are searched, never kept."""

    def __init__(self, sequences: np.ndarray, lengths: np.ndarray):
        n, ends = len(sequences) + len(lengths), np.cumsum(lengths) + np.arange(len(lengths))
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = sequences
        self.starts = ends - lengths
        self.suffixes = self._sorted(text, ends)
        transform = text[self.suffixes - 1]
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.levels: list[tuple[int, Bits, int]] = []
        for level in reversed(range(int(text.max(initial=0)).bit_length())):
            bits = (transform >> level) & 1 == 1
            self.levels.append((level, Bits(bits), int(len(bits) - bits.sum())))
            transform = np.concatenate([transform[~bits], transform[bits]])
        symbols = np.arange(len(counts))
        self.base = self._walk(symbols, np.zeros(len(symbols), np.int64))
        self.text = text

    @staticmethod
    def _sorted(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The suffix array by doubling; the end marks of the sequences differ, each sorting before all words."""
        rank = text + len(ends)
        rank[ends] = np.arange(len(ends))
        size, reach = int(rank.max(initial=0)) + 2, 1
        while True:
            shifted = np.zeros(len(rank), np.int64)
            shifted[: len(rank) - reach] = rank[reach:] + 1
            key = rank * size + shifted
            order = np.argsort(key)
            key = key[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            rank = np.empty(len(order), np.int64)
            rank[order] = np.cumsum(new) - 1
            if new.all():
                return order
            size, reach = len(order) + 2, 2 * reach

    def _walk(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        for level, bits, zeros in self.levels:
            ones = bits.ones(upto)
            upto = np.where((symbol >> level) & 1 == 1, zeros + ones, upto - ones)
        return upto

    def before(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before a position."""
        return self._walk(symbol, upto) - self.base[symbol]

    def search(self, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of runs of the indexed text itself, up to ``length`` words.

        Backward search of the run at each position ``first``: the interval of
        suffixes that begin with it. A run stops as soon as its interval holds
        one suffix: it is its only occurrence, and its interval has width 1.
        """
        last = self.text[first + length - 1]
        low, high = self.first[last], self.first[last + 1]
        for step in range(length - 2, -1, -1):
            live = np.flatnonzero(high - low > 1)
            if not len(live):
                break
            symbol = self.text[first[live] + step]
            both = self.before(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
            low[live] = self.first[symbol] + both[: len(live)]
            high[live] = self.first[symbol] + both[len(live) :]
        return low, high


def first_windows(codes: pa.Array, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window in it) of every window that occurs nowhere earlier in the shard.

    ``codes`` are different texts of words with one space between them.
    """
    data, offsets = text_bytes(codes)
    starts, ends, rows = word_spans(data, offsets, IS_DARK)
    lengths = np.bincount(rows, minlength=len(at))
    _, names = np.unique(span_hashes(data, starts, ends), return_inverse=True)
    index = FMIndex(names.astype(np.int64) + 1, lengths)
    windows = lengths - WINDOW + 1
    segment = np.repeat(np.arange(len(at)), windows)
    inner = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
    low, high = index.search(index.starts[segment] + inner, WINDOW)
    # The place of every suffix, in the order of the suffixes.
    where = np.repeat(at - index.starts, lengths + 1) + np.arange(len(index.text))
    where = np.append(where[index.suffixes], np.iinfo(np.int64).max)
    own = at[segment] + inner
    shared = np.flatnonzero(high - low > 1)
    first = np.ones(len(segment), bool)
    if len(shared):
        lows, which = np.unique(low[shared], return_inverse=True)
        highs = np.zeros(len(lows), np.int64)
        highs[which] = high[shared]
        least = np.minimum.reduceat(where, np.stack([lows, highs], axis=1).ravel())[::2]
        first[shared] = own[shared] == least[which]
    return segment[first], inner[first]


def _first_runs(shard: pa.Table) -> pa.Table:
    """The first windows of a shard, as runs in the documents they stand in."""
    shard = shard.take(pa.compute.sort_indices(shard, [("at", "ascending")]))
    codes = shard.column("code").combine_chunks().dictionary_encode()
    if isinstance(codes, pa.ChunkedArray):
        codes = codes.combine_chunks()
    _, keep = np.unique(codes.indices.to_numpy(), return_index=True)  # the first of equal ones
    at, place = shard.column("at").to_numpy()[keep], shard.column("place").to_numpy()[keep]
    segment, inner = first_windows(codes.dictionary, at)
    new = np.ones(len(segment), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (inner[1:] != inner[:-1] + 1)
    begun = np.flatnonzero(new)
    n = np.diff(np.append(begun, len(segment)))
    row = segment[begun]
    return pa.table({"place": place[row], "span": (at[row] - place[row] + inner[begun]) * 16 + n})


# --- what stays --------------------------------------------------------------


def _spans(column: pa.Array, a: int, b: int, first_word: np.ndarray):
    """Windows (numbered in the block) that the spans of rows a to b hold."""
    cuts = column.offsets.to_numpy()
    flat = column.flatten().to_numpy()
    own, counts = flat[cuts[a] - cuts[0] : cuts[b] - cuts[0]], np.diff(cuts[a : b + 1])
    begin, n = (own >> 4) + np.repeat(first_word, counts), own & 15
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets, starts, ends, rows in words_of(batch.column(1)):
            first_word = _first_words(rows, b - a)
            repeat = np.zeros(len(starts) + 1, np.int64)
            repeat[_spans(batch.column(2), a, b, first_word)] = 1
            repeat[_spans(batch.column(3), a, b, first_word)] = 0
            at = np.flatnonzero(repeat)
            covered = np.zeros(len(starts) + 1, np.int64)
            covered[at] += 1
            covered[at + WINDOW] -= 1
            kept = np.cumsum(covered)[: len(starts)] == 0
            n_words = np.bincount(rows, minlength=b - a)
            n_kept = np.bincount(rows[kept], minlength=b - a)
            text, before = spaced(data, starts, ends, rows, kept, b - a)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array(n_words),
                    pa.array(n_words - n_kept),
                    pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(before[offsets]), pa.py_buffer(text)).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )


def dedup_substrings(docs: DataFrame, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document; kept is its text without repeated passages.

    Removed is each word that a window of 20 words covers whose words also stand
    earlier: in a smaller doc_id, or before it in the same text (overlapping
    itself or not). Kept words are joined by one space. Null and empty texts
    have no words, texts of fewer than 20 no window. Null ids come before all
    others; rows of equal ids are ordered by a hash of their text, equal rows in
    any order, and count as different documents, so all but one of equal rows
    lose all words. Long texts are read whole. An empty table gives no rows.
    """
    # Rows get numbers that stay: the table is read again and again.
    base = pin(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), compression="zstd")
    texts = base.select("row", "text")
    anchors = pin(texts.mapInArrow(_anchors, "anchor long, row long, span long"))
    # Stored, so that the join is one of two plain sides and the rows of an anchor that many share are split.
    counts = pin(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
    spans = anchors.join(counts, "anchor").select("row", (F.col("span") * 2 + (F.col("c") > hot).cast("long")).alias("mark"))
    marks = spans.groupBy("row").agg(F.collect_list("mark").alias("marks"))
    marks = pin(marks.join(places(base), "row"))
    unpin(anchors, counts)
    segments_ = marks.agg(F.sum(F.size("marks"))).first()[0] or 0
    shards = max(1, math.ceil(segments_ * (WINDOW + MOST_WINDOWS // 2) / shard_words))
    found = texts.join(marks, "row").select("place", "text", "marks")
    found = found.mapInArrow(_candidates(shards), "shard long, code string, at long, place long")
    kept = pin(found.groupBy("shard").applyInArrow(_first_runs, "place long, span long"))
    kept = kept.groupBy("place").agg(F.collect_list("span").alias("firsts"))
    none = F.array().cast("array<bigint>")
    marks = marks.join(kept, "place", "left").select(
        "row", F.transform("marks", lambda m: F.shiftright(m, 1)).alias("marks"), F.coalesce("firsts", none).alias("firsts")
    )
    marked = base.join(marks, "row", "left").select(
        "doc_id", "text", F.coalesce("marks", none).alias("marks"), F.coalesce("firsts", none).alias("firsts")
    )
    kind = dict(docs.dtypes)["doc_id"]
    return marked.mapInArrow(_cleaned, f"doc_id {kind}, n_words long, n_removed long, kept string")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
r AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS k FROM p)
  WHERE k > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept, count(*) AS n FROM x ANTI JOIN c ON x.doc_id = c.doc_id AND x.i = c.i
  GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
