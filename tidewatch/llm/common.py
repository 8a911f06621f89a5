"""Shared pieces: tables, words as native arrays, word hashes on Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def word_array(text: Column) -> Column:
    """Words of digits, letters a-z and characters beyond ASCII, lower-cased."""
    return F.array_remove(F.split(lower_ascii(text), NOT_WORD), "")


def fresh(taken: Sequence[str], *names: str) -> list[str]:
    """Names that clash with none of ``taken`` (case does not distinguish)."""
    used = {c.lower() for c in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def learning_row(doc_id: Column) -> Column:
    """True for rows that models may learn from; a null id is never one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# --- words of an Arrow text column as numbers --------------------------------

_byte = np.arange(256)
LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
#: Bytes of words: digits, letters, and all bytes of characters beyond ASCII.
IS_WORD = ((_byte >= 48) & (_byte <= 57)) | ((LOWER >= 97) & (LOWER <= 122)) | (_byte >= 128)
#: Bytes that separate words by white space only.
IS_DARK = ~((_byte == 32) | ((_byte >= 9) & (_byte <= 13)))
_VALUE = np.random.default_rng(20_177).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64, for i below ``n``.

    Workers live on between tasks: those for a block stay with them, those for a longer text do not.
    """
    if _powers and len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, (1 << 20) + 1)
    both = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    if size <= BLOCK_BYTES + 1:
        _powers[:] = both
    return both[0], both[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]], cuts - cuts[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes each (or one longer row)."""
    rows, a = len(offsets) - 1, 0
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), rows)
        yield a, b
        a = b


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = IS_WORD):
    """Start, end and row of every word; no word reaches over the end of a row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    member = inside[data]
    before = np.zeros(len(data), bool)
    before[1:] = member[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    after = np.zeros(len(data), bool)
    after[:-1] = member[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    after[tails] = False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same in every block."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def hashed_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = IS_WORD):
    """Hash and row of every word of a block, A-Z lower-cased."""
    low = LOWER[data]
    starts, ends, row = word_spans(low, offsets, inside)
    return span_hashes(low, starts, ends), row


def word_blocks(column: pa.Array, inside: np.ndarray = IS_WORD, limit: int = BLOCK_BYTES):
    """(first row, last row + 1, word hashes, row of each word from 0) per block."""
    data, offsets = text_bytes(column)
    for a, b in row_blocks(offsets, limit):
        part = data[offsets[a] : offsets[b]]
        yield a, b, *hashed_words(part, offsets[a : b + 1] - offsets[a], inside)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int):
    """Hash and row of each run of ``size`` words; a row of fewer words is one run."""
    counts = np.bincount(rows, minlength=n_rows)
    salts = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    n = len(words) - size + 1
    full = np.zeros(max(n, 0), np.uint64)
    for j in range(size if n > 0 else 0):
        full += words[j : j + n] * salts[j]
    keep = rows[:n] == rows[size - 1 :] if n > 0 else np.zeros(0, bool)
    hashes, owner = mix(full[keep]), rows[:n][keep] if n > 0 else rows[:0]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        first = np.searchsorted(rows, short)
        tail = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            here = counts[short] > j
            at = np.minimum(first + j, len(words) - 1)
            tail += np.where(here, words[at] * salts[j], np.uint64(0))
        # The length keeps short rows apart from full runs.
        tail = mix(tail + counts[short].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        hashes, owner = np.concatenate([hashes, tail]), np.concatenate([owner, short])
    return hashes, owner


def sums_by_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Wrapping 64-bit sums of ``values`` per row (``rows`` sorted)."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    cuts = np.searchsorted(rows, np.arange(n_rows + 1))
    return sums[cuts[1:]] - sums[cuts[:-1]]


def row_counts(member: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each row belong to ``member`` (a table of 256 flags)."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for a, b in row_blocks(offsets, 1 << 20):
        sums = np.zeros(int(offsets[b] - offsets[a]) + 1, np.int64)
        np.cumsum(member[data[offsets[a] : offsets[b]]], out=sums[1:])
        cuts = offsets[a : b + 1] - offsets[a]
        out[a:b] = sums[cuts[1:]] - sums[cuts[:-1]]
    return out


def list_array(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Lists of consecutive runs of ``values``, ``counts`` long."""
    cuts = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=cuts[1:])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and where each group begins and ends in them.

    The batches must be sorted by ``keys`` (integers); a group may go on in the
    next batch.
    """

    def cut(batches_: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
        table_ = pa.Table.from_batches(batches_)
        key = np.stack([table_.column(c).to_numpy() for c in keys], axis=1)
        at = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        return table_, np.concatenate([[0], at, [len(key)]])

    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        same = (key == key[-1]).all(axis=1)
        begin = 0 if same.all() else batch.num_rows - int(np.argmin(same[::-1]))
        if begin:
            yield cut([*waiting, batch.slice(0, begin)])
            waiting = [batch.slice(begin)]
        elif last is not None and (key[0] != last).any():
            yield cut(waiting)
            waiting = [batch]
        else:
            waiting.append(batch)
        last = key[-1]
    if waiting:
        yield cut(waiting)
