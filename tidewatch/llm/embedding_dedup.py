"""Near duplicates among embeddings by a pivot-permutation index.

A bounded sample of vectors, none near another, are the pivots. A vector is described by its
nearest pivots in order and entered in the inverted list of each of them, per
label. Two vectors are candidates if they share enough of these pivots; a pair
is handled once, in the list of the first pivot it shares, and its cosine is
computed in double precision. Long lists are cut into tiles of bounded size.
Of the pairs only sums of links and edges that span what a tile connects become
rows, so a group of n copies never makes n squared of them. Equal vectors are
one entry from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, table, whole_groups
from tidewatch.llm.components import components
from tidewatch.session import pin

THRESHOLD = 0.93
#: Nearest pivots of a vector that it is listed under, and how many a pair must share.
NEAREST, SHARED = 10, 2
#: Pivots: PIVOT_FACTOR times the square root of the vectors, within PIVOT_BYTES.
PIVOT_FACTOR, PIVOT_BYTES = 4, 32 << 20
#: Pivots are at least so far apart: a group of near copies holds few of them.
PIVOT_COSINE = 0.8
#: Members of one side of a tile of a list.
TILE = 1024


def usable(vector: str, label: str) -> Column:
    """Rows that can link: a label, and a vector of finite numbers that is not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(label).isNotNull() & good & some, F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small numbers stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _listed(shared):
    """One row per vector and nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: np.ndarray = shared.value
        k = min(NEAREST, len(pivots))
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                part = batch.slice(begin, 4096)
                sims = unit(_matrix(part.column("vector"), pivots.shape[1])) @ pivots.T
                near = np.argsort(-np.round(sims, 12), axis=1, kind="stable")[:, :k]
                take = pa.array(np.repeat(np.arange(part.num_rows), k))
                order = pa.ListArray.from_arrays(
                    pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * k), pa.array(near.ravel().astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("group").take(take),
                        pa.array(near.ravel().astype(np.int64)),
                        part.column("cid").take(take),
                        part.column("copies").take(take),
                        part.column("vector").take(take),
                        order.take(take),
                    ],
                    ["group", "pivot", "cid", "copies", "vector", "near"],
                )

    return run


def tile_links(x, y, near_x, near_y, pivot: int, threshold: float, same: bool) -> np.ndarray:
    """Which pairs of two sides of a tile link and belong to this pivot's list."""
    names, flat = np.unique(np.concatenate([near_x.ravel(), near_y.ravel()]), return_inverse=True)
    hold = np.zeros((len(near_x) + len(near_y), len(names)), np.float32)
    hold[np.repeat(np.arange(len(hold)), near_x.shape[1]), flat] = 1
    a, b = hold[: len(near_x)], hold[len(near_x) :]
    before = names < pivot
    mine = (a @ b.T >= SHARED) & (a[:, before] @ b[:, before].T == 0)
    if same:
        np.fill_diagonal(mine, False)
    i, j = np.nonzero(mine)
    if not len(i):
        return mine
    cosine = np.empty(len(i))
    for k in range(0, len(i), 1 << 16):
        cosine[k : k + (1 << 16)] = np.einsum("ij,ij->i", x[i[k : k + (1 << 16)]], y[j[k : k + (1 << 16)]])
    mine[i, j] = cosine >= threshold
    return mine


def spanning(links: np.ndarray) -> np.ndarray:
    """For rows then columns of a link matrix, the smallest index that links reach."""
    n, m = links.shape
    left, right = np.arange(n), n + np.arange(m)
    top = n + m
    while True:
        new_right = np.minimum(right, np.where(links, left[:, None], top).min(axis=0, initial=top))
        new_left = np.minimum(left, np.where(links, new_right[None, :], top).min(axis=1, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return np.concatenate([left, right])
        left, right = new_left, new_right


def _tiles(dim: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in whole_groups(batches, ("group", "pivot", "part1", "part2")):
            ids, copies, pivots = (part.column(c).to_numpy() for c in ("cid", "copies", "pivot"))
            right, alone = part.column("right").to_numpy(), part.column("part1").to_numpy() == part.column("part2").to_numpy()
            vectors = unit(_matrix(part.column("vector"), dim))
            width = len(part.column("near")[0].as_py())
            near = part.column("near").combine_chunks().flatten().to_numpy().reshape(-1, width)
            out: list[tuple] = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                one = np.flatnonzero(~right[a:b]) + a
                two = np.flatnonzero(right[a:b]) + a
                # A tile of a part with itself; one whose other side is empty has no pairs.
                same = bool(alone[a])
                two = one if same else two
                if not len(one) or not len(two):
                    continue
                links = tile_links(vectors[one], vectors[two], near[one], near[two], int(pivots[a]), threshold, same)
                if not links.any():
                    continue
                reach = spanning(links)
                rows = one if same else np.concatenate([one, two])
                sums = links @ copies[two] if same else np.concatenate([links @ copies[two], links.T @ copies[one]])
                if same:
                    # Both sides are the same members.
                    reach = np.minimum(reach[: len(one)], reach[len(one) :] % len(one))
                    root = one[reach]
                else:
                    root = rows[reach]
                some = sums > 0
                out.append((ids[rows[some]], sums[some], ids[root[some]]))
            if out:
                node, n, root = (np.concatenate([o[k] for o in out]) for k in range(3))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n.astype(np.int64)), pa.array(root)], ["a", "n", "b"])

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors are compared within equal, non-null labels and equal lengths. Null
    and zero vectors and those with null or non-finite parts link with nothing.
    Repeated rows are copies that link with each other. A null id is kept when
    its component has no other name. An empty table gives no rows.
    """
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    ).withColumn("ok", usable("vector", "label"))
    # Negative zero equals zero.
    clean = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("vector", F.when(F.col("ok"), clean))
    rows = rows.withColumn("cid", F.when(F.col("ok"), F.xxhash64("label", "vector")))
    entries = pin(
        rows.filter("ok")
        .groupBy("cid", "label", "vector")
        .agg(F.min("vec_id").alias("name"), F.count(F.lit(1)).alias("copies"))
        .withColumn("dim", F.size("vector"))
        .withColumn("group", F.xxhash64("label", "dim"))
    )
    found = None
    sizes = {r.dim: r["count"] for r in entries.groupBy("dim").count().collect()}
    for dim, n in sorted(sizes.items()):
        part = entries.filter(F.col("dim") == dim)
        links = _links(part, dim, n, threshold)
        found = links if found is None else found.union(links)
    if found is None:
        links = entries.select(F.col("cid").alias("a"), F.col("copies").alias("n"), F.col("cid").alias("b")).limit(0)
    else:
        links = pin(found)
    roots = components(links.select("a", "b")).withColumnRenamed("node", "cid")
    sums = links.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    linked = entries.select("cid", "name", "copies").join(roots, "cid", "left").join(sums, "cid", "left")
    linked = linked.withColumn("root", F.coalesce("root", "cid"))
    best = linked.groupBy("root").agg(F.min("name").alias("component_id"))
    linked = linked.join(best, "root").select(
        "cid", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    alone = rows.filter("NOT ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    out = rows.filter("ok").select("vec_id", "cid").join(linked, "cid").select("vec_id", "n_links", "component_id")
    out = out.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def apart(vectors: np.ndarray, wanted: int, most: float = PIVOT_COSINE) -> np.ndarray:
    """The first ``wanted`` unit vectors whose cosine to all taken before them is below ``most``."""
    taken = np.zeros((0, vectors.shape[1]))
    for k in range(0, len(vectors), 256):
        block = vectors[k : k + 256]
        block = block[(block @ taken.T).max(axis=1, initial=-1.0) < most]
        near = block @ block.T >= most
        free = np.ones(len(block), bool)
        for i in range(len(block)):
            if free[i]:
                free[i + 1 :] &= ~near[i, i + 1 :]
        taken = np.concatenate([taken, block[free]])[:wanted]
        if len(taken) == wanted:
            break
    return taken


def pivots_of(part: DataFrame, dim: int, n: int) -> np.ndarray:
    """A sample of the vectors, by a hash of their content, in which no two are near each other.

    A dense group would otherwise take pivots in proportion to its size, and
    which of them are nearest to a member would be chance.
    """
    wanted = max(min(math.ceil(PIVOT_FACTOR * math.sqrt(n)), PIVOT_BYTES // (8 * dim)), 1)
    draw = F.pmod(F.xxhash64("cid", F.lit("pivot")), F.lit(1 << 30))
    near = part.select("vector", draw.alias("d")).filter(F.col("d") <= F.lit(min(6.0 * wanted / n, 1.0) * (1 << 30)))
    rows = near.orderBy("d").limit(3 * wanted).collect()
    if not rows:
        rows = part.select("vector").limit(wanted).collect()
    return apart(unit(np.array([r.vector for r in rows], float)), wanted)


def _links(part: DataFrame, dim: int, n: int, threshold: float) -> DataFrame:
    """(a, n, b): entries, what they link to in one tile (copies counted), and an entry they reach."""
    shared = part.sparkSession.sparkContext.broadcast(pivots_of(part, dim, n))
    listed = part.select("group", "cid", "copies", "vector").mapInArrow(
        _listed(shared), "group long, pivot long, cid long, copies long, vector array<double>, near array<int>"
    )
    listed = pin(listed)
    counts = listed.groupBy("group", "pivot").agg(F.count(F.lit(1)).alias("c"))
    parts = F.ceil(F.col("c") / TILE).cast("long")
    own = F.pmod(F.xxhash64("cid", F.lit("part")), parts)
    tiles = listed.join(counts, ["group", "pivot"]).withColumn("own", own)
    tiles = tiles.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    tiles = tiles.select(
        "group",
        "pivot",
        F.least("own", "with").alias("part1"),
        F.greatest("own", "with").alias("part2"),
        (F.col("own") > F.col("with")).alias("right"),
        "cid",
        "copies",
        "vector",
        "near",
    )
    keys = ["group", "pivot", "part1", "part2"]
    return tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_tiles(dim, threshold), "a long, n long, b long")


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
    AND list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a
"""
