"""Packing of token ids into sequences along a space-filling curve.

Each document's ids are counted into a hashed vector, which random signs project
to a few dimensions; the Hilbert key of the point orders the documents, so that
neighbours on the curve use similar tokens. The tokenised documents are written
once, range-sorted by (key, document) and packed in that order, each range by
itself: documents follow one another and are cut where a sequence is full.
Only the last sequence of a range can be short.

Ranges are bounded by (key, hash of the row), so that a group of equal texts,
which share one key, is spread over as many ranges as it needs.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import mix, row_blocks, table, text_bytes
from tidewatch.session import pin

SEQUENCE = 2048
END = 1
DIMENSIONS, KEY_BITS = 3, 16
#: Ids of one range; at most this many ranges, which are then larger.
RANGE_IDS, MOST_RANGES = 8 << 20, 20_000
#: How byte-level pre-tokenizers cut a text (fixed value, part of the vocabulary's definition).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_signs() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printing bytes stand for themselves, the others follow from 256 on in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by a tokenizer file of the tokenizers library.

    A plain byte-level BPE whose ids follow the order of its merges has the same
    ids as ranked pairs, which tiktoken finds four times as fast; every other
    file goes to the tokenizers library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        plain = not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip"))
        self.ranked = (
            model.get("type") == "BPE"
            and not spec.get("normalizer")
            and cut.get("type") == "ByteLevel"
            and not cut.get("add_prefix_space")
            and cut.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and plain
            and self._in_order(model)
        )
        self.size = len(model["vocab"]) + len(special)
        if self.ranked:
            import tiktoken

            sign = byte_signs()
            ranks = {bytes(sign[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
            self.ranks = tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        else:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(path)

    @staticmethod
    def _in_order(model: dict) -> bool:
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        return all(a < b for a, b in zip(made, made[1:]))

    def ids(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.ranked:
            return [self.ranks.encode_to_numpy(t or "", allowed_special="all") for t in texts]
        out = []
        for k in range(0, len(texts), 64):
            part = [t or "" for t in texts[k : k + 64]]
            out += [np.array(e.ids, np.uint32) for e in self.whole.encode_batch_fast(part, add_special_tokens=False)]
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process: reading the file is not repeated for every task."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of points with coordinates of ``bits`` bits.

    One bit of each coordinate at a time from the top: the cell within the
    current cube gives the next digits (in Gray order), and the lower bits are
    turned into the frame of that cell.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dims):
            high = (x[d] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            x[d] ^= swap
        q >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def signs(size: int) -> np.ndarray:
    """Random signs of each id, one column per dimension."""
    ids = np.arange(size, dtype=np.uint64)
    salts = [np.uint64((d + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for d in range(DIMENSIONS)]
    return np.stack([np.where(mix(ids + s) >> np.uint64(63), 1.0, -1.0) for s in salts], axis=1)


def curve_keys(ids: np.ndarray, counts: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Hilbert key of the hashed id vector of each row; rows without ids are in the middle."""
    n = len(counts)
    row = np.repeat(np.arange(n), counts)
    point = np.zeros((n, DIMENSIONS), np.int64)
    for d in range(DIMENSIONS):
        mean = np.bincount(row, sign[ids, d], minlength=n) / np.maximum(counts, 1)
        point[:, d] = ((mean + 1) / 2 * ((1 << KEY_BITS) - 1)).astype(np.int64)
    return hilbert_key(point, KEY_BITS)


def _tokenised(path: str | None, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = path
        if place is None:
            import public_tokenizers

            place = public_tokenizers.path("byte_bpe_50k.json")
        words = encoder(place)
        # Two bytes an id where the vocabulary allows it.
        kind = np.dtype("<u2" if words.size <= 1 << 16 else "<u4")
        sign = signs(words.size)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in row_blocks(offsets):
                found = words.ids(batch.column("text").slice(a, b - a).to_pylist())
                counts = np.array([len(x) for x in found], np.int64)
                ids = np.concatenate(found)
                keys = curve_keys(ids, counts, sign)
                cuts = np.cumsum(counts)
                full = np.insert(ids, cuts, end).astype(kind)
                bounds = np.zeros(len(counts) + 1, np.int64)
                np.cumsum((counts + 1) * kind.itemsize, out=bounds[1:])
                blobs = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(full)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("tie").slice(a, b - a),
                        pa.array(keys),
                        pa.array(counts + 1),
                        blobs.cast(pa.binary()),
                    ],
                    ["doc_id", "tie", "key", "n", "ids"],
                )

    return run


def _packed(sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        # Numbers of a range's sequences follow its own number.
        base = (context.partitionId() if context else 0) << 36
        done = 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            if not len(n):
                continue
            blobs = batch.column("ids").cast(pa.large_binary())
            cuts = np.frombuffer(blobs.buffers()[1], np.int64)[blobs.offset : blobs.offset + len(n) + 1]
            data = np.frombuffer(blobs.buffers()[2], np.uint8)[cuts[0] : cuts[-1]]
            kind = "<u2" if cuts[-1] - cuts[0] == 2 * int(n.sum()) else "<u4"
            raw = memoryview(np.frombuffer(data, kind).astype("<u4")).cast("B")
            begin = done + np.cumsum(n) - n
            first, last = begin // sequence, (begin + n - 1) // sequence
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            number = first[row] + np.arange(len(row)) - (np.cumsum(pieces) - pieces)[row]
            start = np.maximum(number * sequence, begin[row])
            end = np.minimum((number + 1) * sequence, (begin + n)[row])
            at = start - done
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + end - start).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(start - begin[row]),
                    pa.array(end - start),
                    pa.array(crc, pa.int64()),
                    pa.array(n[row].astype(np.int64)),
                    pa.array(base + number),
                    pa.array(start - number * sequence),
                    batch.column("key").take(pa.array(row)),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "curve_key"],
            )
            done = int(begin[-1] + n[-1])

    return run


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end: int = END,
    sequence: int = SEQUENCE,
    range_ids: int = RANGE_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, curve_key.

    ``tokenizer`` names a file of the tokenizers library (by default the public
    byte-level BPE of 50,257 ids). Null and empty texts are the id ``end``
    alone. Repeated rows are packed each. An empty table gives no pieces.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("tie"),
        F.col(text).cast("string").alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    tokens = pin(rows.mapInArrow(_tokenised(tokenizer, end), f"doc_id {kind}, tie long, key long, n long, ids binary"))
    total = tokens.agg(F.sum("n")).first()[0] or 0
    ranges = min(max(math.ceil(total / range_ids), 1), MOST_RANGES)
    ordered = tokens.repartitionByRange(ranges, "key", "tie").sortWithinPartitions("key", "tie")
    return ordered.mapInArrow(
        _packed(sequence),
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
        " offset long, curve_key long",
    )


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
