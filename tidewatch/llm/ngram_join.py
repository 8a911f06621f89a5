"""Jaccard self-join of shingle sets over count vectors.

Shingles are hashed into groups; the counts of a document's groups are its
point. The groups are cut into blocks of coordinates, one tree over the points
per block. Sets of Jaccard similarity t differ in at most (|A|+|B|)(1-t)/(1+t)
shingles; with more blocks than that, two such sets have blocks with the very
same counts, so in at least one tree they lie in the same leaf, and a leaf is a
key of a shuffle. Pairs of a leaf are bounded by the summed minima of coarse
coordinates, and survivors are compared shingle by shingle.

Nothing is lost: the number of blocks exceeds the largest difference by the
number of light blocks that may be left out of the index (see ``Classes``).
Documents with equal sets share one point. A set is first compared to the most
central member of its leaves, one centre after the other while they are apart; only members of components that are still apart are
compared with each other, in tiles of bounded size, and only pairs that the
bound lets through become rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import IS_DARK, list_array, mix, shingle_hashes, sums_by_row, table, whole_groups, word_blocks
from tidewatch.llm.components import components
from tidewatch.session import pin, unpin

WORDS = 5
#: Two sets link when DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 80, 100
COARSE = 256
#: Largest count of a coordinate; a coordinate that reaches it bounds nothing.
FULL = 255
#: Members of one side of a tile of a leaf.
TILE = 1024
#: A block with fewer shingles is light; a class takes the largest number that its spare blocks cover.
LIGHT = (3, 2, 1)
GROWTH = 1.2
#: Leaves a task packs into rows at a time, and leaves of a part of the key space.
PACKED, PART_LEAVES = 2_000_000, 4_000_000
#: Bytes of a leaf's key within its part. Leaves that fall together only add pairs to verify.
KEY_BYTES = 6


class Classes:
    """Classes of set sizes, each with its own number of blocks.

    A set is indexed in its own class and, if a larger partner may be in the
    next one, there too. ``spare`` blocks of a class are beyond the largest
    difference d plus one, so that at least spare + 1 blocks of a linked pair
    are equal. A set with at most ``spare`` light blocks leaves them out: one of
    the equal blocks is then not light. A set with more is indexed by all.
    """

    def __init__(self, numerator: int, denominator: int):
        self.numerator, self.denominator = numerator, denominator
        starts = [1, 2]
        while starts[-1] < 1 << 40:
            # The partners of a class reach into the next one, never beyond it.
            reach = (starts[-1] - 1) * denominator // numerator + 1
            starts.append(max(starts[-1] + 1, reach, int(starts[-1] * GROWTH)))
        self.starts = np.array(starts, np.int64)
        most = 2 * (self.starts[1:] - 1) * (denominator - numerator) // (denominator + numerator)
        self.spare = np.where(most >= 4, 3 + most // 20, 0)
        self.blocks = most + 1 + self.spare
        # Shingles in a block of the smallest sets of the class, and how many blocks then hold few.
        mean = self.starts[:-1] * numerator / denominator / self.blocks
        below = [np.exp(-mean), np.exp(-mean) * (1 + mean), np.exp(-mean) * (1 + mean + mean**2 / 2)]
        self.light = np.select([self.blocks * below[k - 1] <= self.spare / 2 for k in LIGHT], LIGHT, 1)

    def of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each size, and whether the next class is needed too."""
        own = np.searchsorted(self.starts, n, "right") - 1
        partner = n * self.denominator // self.numerator
        return own, partner >= self.starts[own + 1]


def distinct_shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int):
    """Distinct shingle hashes of each row, sorted by (row, hash)."""
    hashes, owner = shingle_hashes(words, rows, n_rows, size)
    shift = max(int(n_rows).bit_length(), 1)
    key = (owner.astype(np.uint64) << np.uint64(64 - shift)) | (hashes >> np.uint64(shift))
    order = np.argsort(key)
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
    return hashes, owner


def set_id(hashes: np.ndarray, owner: np.ndarray, n_rows: int) -> np.ndarray:
    counts = np.bincount(owner, minlength=n_rows).astype(np.uint64)
    return mix(sums_by_row(mix(hashes + np.uint64(0x51ED270B)), owner, n_rows) + counts).view(np.int64)


def leaf_keys(hashes, owner, sizes, classes: Classes):
    """Row and key of every leaf that the sets of a block of rows lie in."""
    own, also = classes.of(np.maximum(sizes, 1))
    rows_out, keys_out = [], []
    group = hashes >> np.uint64(24)
    value = mix(group * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    low = (value & np.uint64(0xFFFFFFFF)).astype(np.float64)
    high = (value >> np.uint64(32)).astype(np.float64)
    for take, kind in ((sizes > 0, own), ((sizes > 0) & also, own + 1)):
        blocks = np.where(take, classes.blocks[kind], 0)
        firsts = np.cumsum(blocks) - blocks
        inside = take[owner]
        who = owner[inside]
        slot = firsts[who] + (group[inside] % blocks[who].astype(np.uint64)).astype(np.int64)
        total = int(blocks.sum())
        filled = np.bincount(slot, minlength=total)
        a = np.bincount(slot, low[inside], minlength=total).astype(np.uint64)
        b = np.bincount(slot, high[inside], minlength=total).astype(np.uint64)
        row = np.repeat(np.arange(len(sizes)), blocks)
        number = np.arange(total) - firsts[row]
        light = filled < classes.light[kind[row]]
        few = np.bincount(row[light], minlength=len(sizes)) <= classes.spare[kind]
        use = ~(light & few[row])
        place = mix(number[use].astype(np.uint64) + (kind[row[use]].astype(np.uint64) << np.uint64(40)))
        keys_out.append(mix(mix(a[use] + place) + b[use] * np.uint64(0xD1B54A32D192ED03)).view(np.int64))
        rows_out.append(row[use])
    rows = np.concatenate(rows_out)
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate(keys_out)[order]


def _ids(hashes, owner, sizes, row_key) -> np.ndarray:
    """Id of each row's set; rows without shingles are sets of their own."""
    lone = mix(row_key.astype(np.int64).view(np.uint64) + np.uint64(0xABCD)).view(np.int64)
    return np.where(sizes > 0, set_id(hashes, owner, len(sizes)), lone)


def _points(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, row_key = batch.column("text"), batch.column("row_key").to_numpy()
            for a, b, words, rows in word_blocks(text, IS_DARK):
                n = b - a
                hashes, owner = distinct_shingles(words, rows, n, size)
                sizes = np.bincount(owner, minlength=n)
                ids = _ids(hashes, owner, sizes, row_key[a:b])
                coarse = (owner * COARSE + (hashes & np.uint64(COARSE - 1)).astype(np.int64)) if len(owner) else owner
                point = np.minimum(np.bincount(coarse, minlength=n * COARSE), FULL).astype(np.uint8)
                cuts = np.arange(n + 1, dtype=np.int32) * COARSE
                points = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(point)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, n),
                        batch.column("row_key").slice(a, n),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(ids),
                        points,
                    ],
                    ["doc_id", "row_key", "n", "id", "point"],
                )

    return run


def pack_leaves(leaf: np.ndarray, ids: np.ndarray, parts: int) -> pa.RecordBatch:
    """One row per part: the ids that have leaves there, how many, and the keys of these leaves."""
    value = leaf.view(np.uint64)
    part = ((value >> np.uint64(8 * KEY_BYTES)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((ids, part))
    part, ids, value = part[order], ids[order], value[order]
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (ids[1:] != ids[:-1])
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(part))).astype("<i4")
    keys = value.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
    names, sizes = np.unique(part, return_index=True)
    sizes = np.diff(np.append(sizes, len(part)))
    runs = np.bincount(np.searchsorted(names, part[heads]), minlength=len(names))

    def packed(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
        cuts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(lengths), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(values))]
        )

    return pa.RecordBatch.from_arrays(
        [
            pa.array(names),
            packed(ids[heads].astype("<i8"), runs * 8),
            packed(counts, runs * 4),
            packed(keys, sizes * KEY_BYTES),
        ],
        ["part", "ids", "counts", "keys"],
    )


def shared_leaves(part: int, ids: list[bytes], counts: list[bytes], keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, id) of the leaves of a part that two ids or more have, each once."""
    who = np.repeat(np.frombuffer(b"".join(ids), "<i8"), np.frombuffer(b"".join(counts), "<i4"))
    wide = np.zeros((len(who), 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, KEY_BYTES)
    leaf = wide.view("<i8").ravel()
    order = np.argsort(leaf, kind="stable")
    leaf = leaf[order]
    same = leaf[1:] == leaf[:-1]
    several = np.zeros(len(leaf), bool)
    several[1:] = same
    several[:-1] |= same
    leaf, who = leaf[several], who[order[several]]
    order = np.lexsort((who, leaf))
    leaf, who = leaf[order], who[order]
    new = np.ones(len(leaf), bool)
    new[1:] = (leaf[1:] != leaf[:-1]) | (who[1:] != who[:-1])
    leaf, who = leaf[new], who[new]
    # Leaves that only copies of one set have are not shared.
    _, at, times = np.unique(leaf, return_inverse=True, return_counts=True)
    some = times[at] > 1
    return leaf[some] | (np.int64(part) << np.int64(8 * KEY_BYTES)), who[some]


def _packed(size: int, numerator: int, denominator: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(numerator, denominator)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n_waiting = 0
        for batch in batches:
            row_key = batch.column("row_key").to_numpy()
            for a, b, words, rows in word_blocks(batch.column("text"), IS_DARK):
                n = b - a
                hashes, owner = distinct_shingles(words, rows, n, size)
                sizes = np.bincount(owner, minlength=n)
                ids = _ids(hashes, owner, sizes, row_key[a:b])
                # Copies within the block have the same leaves: listed once.
                first = np.zeros(n, bool)
                first[np.unique(ids, return_index=True)[1]] = True
                mine = first[owner]
                leaf_row, leaf = leaf_keys(hashes[mine], owner[mine], np.where(first, sizes, 0), classes)
                waiting.append((leaf, ids[leaf_row]))
                n_waiting += len(leaf)
                if n_waiting >= PACKED:
                    yield pack_leaves(*(np.concatenate(x) for x in zip(*waiting)), parts)
                    waiting, n_waiting = [], 0
        if n_waiting:
            yield pack_leaves(*(np.concatenate(x) for x in zip(*waiting)), parts)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(leaf, id) of shared leaves; the batches are sorted by part."""
    for table_, bounds in whole_groups(batches, ("part",)):
        for a, b in zip(bounds[:-1], bounds[1:]):
            group = table_.slice(a, b - a)
            columns = (group.column(c).to_pylist() for c in ("ids", "counts", "keys"))
            leaf, who = shared_leaves(group.column("part")[0].as_py(), *columns)
            for k in range(0, len(leaf), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[k : k + (1 << 16)]), pa.array(who[k : k + (1 << 16)])], ["leaf", "id"]
                )


def marks(hashes: np.ndarray) -> bytes:
    """A point as fine as the set is large, of counts cut to one bit: two coordinates or more for each shingle."""
    width = 1 << max(8, int(2 * len(hashes) - 1).bit_length()) if len(hashes) else 256
    flags = np.zeros(width, bool)
    flags[((hashes >> np.uint64(9)) & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def most_shared(na: int, nb: int, a: bytes, b: bytes) -> int:
    """How many shingles two sets can share by their marks.

    The wider point is folded to the width of the other. A coordinate that both
    have stands for one shared shingle, and for one more for each that fell
    together with another in the set that has fewer of these.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    count = lambda z: int(np.bitwise_count(z).sum(dtype=np.int64))
    return count(x & y) + min(na - count(x), nb - count(y))


def _marked(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_pylist(), batch.column("nb").to_pylist()
            ok = [
                most_shared(n, m, x, y) * (numerator + denominator) >= (n + m) * numerator
                for n, m, x, y in zip(na, nb, batch.column("xa").to_pylist(), batch.column("xb").to_pylist())
            ]
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(ok, pa.bool_()))

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words, rows in word_blocks(batch.column("text"), IS_DARK):
                hashes, owner = distinct_shingles(words, rows, b - a, size)
                counts = np.bincount(owner, minlength=b - a)
                sets = list_array(pa.array(hashes.view(np.int64)), counts)
                cuts = np.concatenate([[0], np.cumsum(counts)])
                bits = [marks(hashes[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(a, b - a), pa.array(set_id(hashes, owner, b - a)), sets, pa.array(bits, pa.binary())],
                    ["id", "own_id", "items", "bits"],
                )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Binary points as a matrix of counts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    blob = b"".join(column.to_pylist())
    return np.frombuffer(blob, np.uint8).reshape(-1, COARSE)


def may_link(na, nb, pa_, pb, numerator: int, denominator: int) -> np.ndarray:
    """Whether sizes and summed coordinate minima of pairs allow a link."""
    least = np.minimum(pa_, pb)
    shared = least.sum(axis=1, dtype=np.int64)
    possible = shared * (numerator + denominator) >= (na + nb) * numerator
    near = np.minimum(na, nb) * denominator >= np.maximum(na, nb) * numerator
    return near & (possible | (least == FULL).any(axis=1))


def _bounds(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            ok = may_link(na, nb, _matrix(batch.column("pa")), _matrix(batch.column("pb")), numerator, denominator)
            yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(ok))

    return run


def _bounded(pairs: DataFrame, points: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """Pairs (a, b) whose summed coordinate minima allow a link, with the sizes."""
    pairs = pairs.join(points.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa")), "a")
    pairs = pairs.join(points.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("point").alias("pb")), "b")
    kept = pairs.select("a", "b", "na", "nb", "pa", "pb")
    return kept.mapInArrow(_bounds(numerator, denominator), "a long, b long, na long, nb long")


def tile_pairs(ids, roots, sizes, points, right, numerator: int, denominator: int):
    """Pairs of a tile that lie in different components and may link.

    ``right`` marks the members of the second side; a tile of a part with itself
    has none and pairs its members with each other.
    """
    order = np.argsort(sizes, kind="stable")
    one, two = order[~right[order]], order[right[order]]
    alone = not len(two)
    if alone:
        two = one
    out = []
    # Only members of a similar size are compared: a range, as both sides are sorted.
    low = np.searchsorted(sizes[two], -(-sizes[one] * numerator // denominator))
    high = np.searchsorted(sizes[two], sizes[one] * denominator // numerator, "right")
    for k, i in enumerate(one):
        begin = max(low[k], k + 1) if alone else low[k]
        other = two[begin : high[k]]
        other = other[roots[other] != roots[i]]
        if len(other):
            ok = may_link(sizes[i], sizes[other], points[i], points[other], numerator, denominator)
            other = other[ok]
            if len(other):
                out.append((np.full(len(other), i), other))
    if not out:
        return np.zeros((0, 4), np.int64)
    i, j = (np.concatenate([o[k] for o in out]) for k in (0, 1))
    swap = ids[i] > ids[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    return np.unique(np.stack([ids[i], ids[j], sizes[i], sizes[j]], axis=1), axis=0)


def _tiles(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in whole_groups(batches, ("leaf", "part1", "part2")):
            ids, roots, sizes = (part.column(c).to_numpy() for c in ("id", "root", "n"))
            right, points = part.column("right").to_numpy(), _matrix(part.column("point"))
            out = [
                tile_pairs(ids[a:b], roots[a:b], sizes[a:b], points[a:b], right[a:b], numerator, denominator)
                for a, b in zip(bounds[:-1], bounds[1:])
            ]
            found = np.unique(np.concatenate(out), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, k].copy()) for k in range(4)], ["a", "b", "na", "nb"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs that link; only those whose marks allow it move with their shingles."""
    pairs = pairs.join(sets.select(F.col("id").alias("a"), F.col("bits").alias("xa")), "a")
    pairs = pairs.join(sets.select(F.col("id").alias("b"), F.col("bits").alias("xb")), "b")
    pairs = pairs.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(_marked(numerator, denominator), "a long, b long, na long, nb long")
    pairs = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("ia")), "a")
    pairs = pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("ib")), "b")
    both = F.size(F.array_intersect("ia", "ib"))
    return pairs.filter(both * denominator >= (F.col("na") + F.col("nb") - both) * numerator).select("a", "b")


def _number(doc_id: Column) -> Column:
    return F.coalesce(doc_id.try_cast("long"), F.when(doc_id.isNotNull(), F.xxhash64(doc_id)))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components of ``roots`` (node, root)."""
    ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    placed = pairs.join(ra, "a", "left").join(rb, "b", "left")
    return placed.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _components(
    docs: DataFrame,
    words: int = WORDS,
    numerator: int = NUMERATOR,
    denominator: int = DENOMINATOR,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, list[DataFrame]]:
    """What ``jaccard_components`` returns, and the pinned tables it is read from."""
    keyed = docs.select(
        _number(F.col(doc_id)).alias("doc_id"),
        F.coalesce(_number(F.col(doc_id)), F.xxhash64(F.col(text))).alias("row_key"),
        F.col(text).cast("string").alias("text"),
    )
    entries = pin(keyed.mapInArrow(_points(words), "doc_id long, row_key long, n long, id long, point binary"))
    # Leaves are about (1 - t) / (1 + t) * 2 of the shingles, in one class or two.
    total = entries.agg(F.sum("n")).first()[0] or 0
    share = 4 * (denominator - numerator) / (denominator + numerator)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(math.ceil(total * share / PART_LEAVES), 2 * tasks), 1 << 15)
    packed = keyed.select("row_key", "text").mapInArrow(
        _packed(words, numerator, denominator, parts), "part long, ids binary, counts binary, keys binary"
    )
    packed = packed.repartition("part").sortWithinPartitions("part")
    shared = pin(packed.mapInArrow(_shared, "leaf long, id long"))
    # Leaves with the same members tell the same: one of them stays.
    tops = shared.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("id")).alias("x"), F.min("id").alias("lo")
    )
    kept = tops.groupBy("c", "x", "lo").agg(F.min("leaf").alias("leaf"))
    members = shared.join(kept.select("leaf", "c"), "leaf")
    # The member that meets most others, over all its leaves, is a leaf's centre.
    reach = members.groupBy("id").agg(F.sum("c").alias("reach"))
    ranked = pin(members.join(reach, "id"))
    unpin(shared)
    centre = ranked.groupBy("leaf").agg(F.max_by("id", "reach").alias("lo"))
    members = pin(ranked.drop("reach").join(centre, "leaf"))
    unpin(ranked)

    # These ids grow with the corpus: the joins are never to broadcast them.
    ids = members.select("id").distinct().hint("merge")
    chosen = entries.join(ids, "id", "left_semi").groupBy("id").agg(
        F.min("row_key").alias("row_key"), F.first("n").alias("n"), F.first("point").alias("point")
    )
    chosen = pin(chosen)
    texts = keyed.select("row_key", "text").join(chosen.select("row_key", "id").hint("merge"), "row_key")
    found = texts.select("id", "text").mapInArrow(_sets(words), "id long, own_id long, items array<long>, bits binary")
    sets = pin(found.filter("id = own_id").select("id", "items", "bits").dropDuplicates(["id"]))
    points = chosen.select("id", "n", "point")

    # First each set is compared to the one centre that it shares most leaves with, then to those of its other centres
    # that are still in another component: a set of a long text moves with few pairs, not with every leaf.
    shared = members.filter("id <> lo").groupBy("id", "lo").agg(F.count(F.lit(1)).alias("times"))
    star = pin(shared.groupBy("id").agg(F.max(F.struct("times", "lo")).alias("best")).join(shared, "id"))
    pair = [F.greatest("lo", "id").alias("a"), F.least("lo", "id").alias("b")]
    most = star.filter(F.col("lo") == F.col("best.lo")).select(*pair).distinct()
    nearest = pin(_verified(_bounded(most, points, numerator, denominator), sets, numerator, denominator))
    rest_of_star = _apart(star.filter(F.col("lo") != F.col("best.lo")).select(*pair).distinct(), components(nearest))
    others = pin(_verified(_bounded(rest_of_star, points, numerator, denominator), sets, numerator, denominator))
    first = nearest.union(others)
    roots = components(first)
    unpin(star)
    known = members.join(roots.withColumnRenamed("node", "id"), "id", "left")
    known = known.withColumn("root", F.coalesce("root", "id"))
    apart = known.groupBy("leaf").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2")
    rest = known.filter("id <> lo").join(apart.select("leaf"), "leaf", "left_semi").join(points, "id")
    parts = F.greatest(F.ceil(F.col("c") / TILE), F.lit(1)).cast("long")
    own = F.pmod(F.xxhash64("id"), parts)
    tiles = rest.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    tiles = tiles.select(
        "leaf",
        F.least("own", "with").alias("part1"),
        F.greatest("own", "with").alias("part2"),
        (F.col("own") > F.col("with")).alias("right"),
        "id",
        "root",
        "n",
        "point",
    )
    tiles = tiles.repartition("leaf", "part1", "part2").sortWithinPartitions("leaf", "part1", "part2")
    across = tiles.mapInArrow(_tiles(numerator, denominator), "a long, b long, na long, nb long").distinct()
    second = pin(_verified(across, sets, numerator, denominator))
    unpin(members, sets, chosen)
    if not second.isEmpty():
        roots = components(first.union(second))
    unpin(nearest, others, second)
    roots = roots.withColumnRenamed("node", "id")

    # The smallest doc_id of each set, then of each component.
    names = entries.groupBy("id").agg(F.min("doc_id").alias("name"))
    linked = roots.join(names, "id")
    best = linked.groupBy("root").agg(F.min("name").alias("best"))
    renamed = linked.join(best, "root").select("id", "best")
    names = names.join(renamed, "id", "left").select("id", F.coalesce("best", "name").alias("component_id"))
    found = entries.select("doc_id", F.col("n").alias("n_shingles"), "id").join(names, "id")
    return found.select("doc_id", "n_shingles", "component_id"), [entries]


def jaccard_components(docs: DataFrame, **rule) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Words are separated by white space, A-Z lower-cased. Rows with fewer words
    than a shingle are one shingle; null, empty and blank texts have none and
    are components of their own. ``component_id`` is the smallest doc_id that
    links reach; rows with a null id link like others but give no name unless
    the whole component has none (null then). Repeated rows are in one component.
    Ids that are no whole numbers are replaced by a hash of them. ``rule``:
    words, numerator, denominator, and the names doc_id and text.
    """
    return _components(docs, **rule)[0]


def one_per_component(docs: DataFrame, **rule: int) -> DataFrame:
    """Documents that name their component (rows with a null id stay); copies of such a row stay once."""
    found, pinned = _components(docs, **rule)
    lost = pin(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_lost")).distinct())
    unpin(*pinned)
    return docs.join(lost, _number(docs["doc_id"]) == lost["_lost"], "left_anti").select(*[docs[c] for c in docs.columns])


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, numerator=90, denominator=100)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 1, 2)),
    lambda i: array_to_string(w[i : i + 2], ' '))) AS items
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, len(items) AS n FROM s),
e AS (SELECT doc_id, unnest(items) AS g FROM s),
f AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
shared AS (SELECT e.doc_id, e.g FROM e JOIN f USING (g)),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM shared x JOIN shared y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * i >= 90 * (na.n + nb.n - i)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""
