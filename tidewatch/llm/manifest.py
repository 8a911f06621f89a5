"""Merkle manifest of a table of documents: leaves, proofs and their verification.

Every source is a tree over its leaves in the order of ``doc_id``; the roots of
the sources, in the order of the source, are the leaves of one more tree. Runs
of three consecutive nodes become one node, so 3**LEVELS consecutive leaves are
a superblock: a subtree that one task reduces without knowing the others.

Going up, superblocks are reduced to their roots, level by level; each table of
roots is a few thousand times smaller than the one before. Going down, the nodes
of a superblock are cogrouped with the one row of outer nodes that they need
(the siblings on the way from the superblock's root to the root of all). There
the local reduction is done again, its siblings are put before the outer ones,
and proofs are hashed and folded in the same call.

Nothing but counts reaches the driver, and a source with most rows is spread
over as many superblocks as it needs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import table
from tidewatch.session import pin

ARITY, LEVELS = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
OUTER = "tree long, pos long, lefts array<string>, rights array<string>, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(F.col(c)) for c in FIELDS[:-1]], _field(text)).cast("binary"), 256)


def tampered(doc_id: Column) -> Column:
    """Rows whose text loses its line breaks before the check; never those without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, changed): the leaf of each row, and that of the row as it is found later."""
    changed = F.when(tampered(F.col("doc_id")), F.translate("text", "\n", "")).otherwise(F.col("text"))
    return docs.select("source", "doc_id", _leaf(F.col("text")).alias("leaf"), _leaf(changed).alias("changed"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunk, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        place = [pa.array(np.full(n, chunk, np.int32)), pa.array(np.arange(at, at + n))]
        yield pa.RecordBatch.from_arrays([*place, *batch.columns], names=["chunk", "idx", *batch.schema.names])
        at += n


def placed(rows: DataFrame) -> DataFrame:
    """Leaves with their tree, their position in it and its size.

    Rows are range-partitioned by (source, doc_id, leaf), the last for equal
    ids; rows that are equal in all of this are told apart by a number, so a
    repeated row is no hot range. Trees are numbered in the order of sources.
    """
    order = ["source", "doc_id", "leaf", "tie"]
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order)
    kinds = dict(rows.dtypes)
    schema = f"chunk int, idx long, source {kinds['source']}, doc_id {kinds['doc_id']}, leaf string, changed string"
    ranged = pin(ranged.sortWithinPartitions(*order).drop("tie").mapInArrow(_numbered, schema))
    # One row per source and chunk: chunks and sources, not documents.
    runs = pin(ranged.groupBy("chunk", "source").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("c")))
    in_source = Window.partitionBy("source").orderBy("chunk")
    runs = runs.withColumn("upto", F.sum("c").over(in_source)).withColumn(
        "n", F.sum("c").over(Window.partitionBy("source"))
    )
    begun = runs.filter(F.col("upto") == F.col("c")).withColumn(
        "r", F.row_number().over(Window.partitionBy("chunk").orderBy("source"))
    )
    per_chunk = begun.groupBy("chunk").agg(F.count(F.lit(1)).alias("k"))
    earlier = per_chunk.select("chunk", (F.sum("k").over(Window.orderBy("chunk")) - F.col("k")).alias("earlier"))
    trees = begun.join(earlier, "chunk").select(
        F.col("source").alias("s"), (F.col("earlier") + F.col("r") - 1).cast("long").alias("tree")
    )
    runs = runs.join(trees, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("chunk").alias("in_chunk"), "s", "tree", "n", (F.col("upto") - F.col("c") - F.col("first")).alias("shift")
    )
    same = (F.col("chunk") == F.col("in_chunk")) & F.col("source").eqNullSafe(F.col("s"))
    return ranged.join(runs, same).select(
        "tree", (F.col("idx") + F.col("shift")).alias("pos"), "n", "doc_id", F.col("leaf").alias("node"), "changed"
    )


def ladder(nodes: list[str], n: int, levels: int) -> tuple[list[list[str]], str]:
    """The nodes of a superblock at each level below its root, and the root; ``n`` nodes are in the whole tree."""
    steps = []
    while n > 1 and len(steps) < levels:
        steps.append(nodes)
        nodes = [digest("".join(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
        n = -(-n // ARITY)
    return steps, nodes[0]


def siblings(steps: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """What stands left and right of node ``at`` in its run, level by level."""
    lefts, rights = [], []
    for nodes in steps:
        run = at - at % ARITY
        lefts.append("".join(nodes[run:at]))
        rights.append("".join(nodes[at + 1 : run + ARITY]))
        at //= ARITY
    return lefts, rights


def fold(node: str, lefts: list[str], rights: list[str]) -> str:
    for left, right in zip(lefts, rights):
        node = digest(left + node + right)
    return node


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """The roots of the superblocks; a tree of one node stays as it is."""
    width = ARITY**levels

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        _, root = ladder(rows["node"].tolist(), n, levels)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-n // width)], "node": [root]})

    blocks = nodes.select("tree", F.floor(F.col("pos") / width).cast("long").alias("block"), "pos", "n", "node")
    return blocks.groupBy("tree", "block").applyInPandas(reduce, "tree long, pos long, n long, node string")


def _climb(nodes: DataFrame, largest: int, levels: int) -> list[DataFrame]:
    """The given nodes, the roots of their superblocks, and so on until each tree is one node."""
    tables = [nodes]
    while largest > 1:
        tables.append(pin(_up(tables[-1], levels)))
        largest = -(-largest // ARITY**levels)
    return tables


def _cogrouped(nodes: DataFrame, outer: DataFrame, levels: int):
    width = ARITY**levels
    blocks = nodes.withColumn("block", F.floor(F.col("pos") / width).cast("long"))
    return blocks.groupBy("tree", "block").cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block"))


def _down(nodes: DataFrame, outer: DataFrame, levels: int) -> DataFrame:
    """Outer nodes of each node, from those of its superblock."""

    def join(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, top = rows.sort_values("pos"), above.iloc[0]
        steps, _ = ladder(rows["node"].tolist(), int(rows["n"].iloc[0]), levels)
        own = [siblings(steps, i) for i in range(len(rows))]
        return pd.DataFrame(
            {
                "tree": rows["tree"].to_numpy(),
                "pos": rows["pos"].to_numpy(),
                "lefts": [left + list(top["lefts"]) for left, _ in own],
                "rights": [right + list(top["rights"]) for _, right in own],
                "subroot": top["subroot"],
                "root": top["root"],
            }
        )

    return _cogrouped(nodes, outer, levels).applyInPandas(join, OUTER)


def _verified(nodes: DataFrame, outer: DataFrame, levels: int, schema: str) -> DataFrame:
    """The rows of the result: proofs hashed and folded from the changed leaves."""

    def check(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows, top = rows.sort_values("pos"), above.iloc[0]
        steps, _ = ladder(rows["node"].tolist(), int(rows["n"].iloc[0]), levels)
        out_left, out_right = list(top["lefts"]), list(top["rights"])
        beyond = "".join(a + b for a, b in zip(out_left, out_right))
        proofs, folded = [], []
        for i, leaf in enumerate(rows["changed"].tolist()):
            lefts, rights = siblings(steps, i)
            proofs.append(digest("".join(a + b for a, b in zip(lefts, rights)) + beyond))
            folded.append(fold(fold(leaf, lefts, rights), out_left, out_right))
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy(),
                "leaf": rows["node"].to_numpy(),
                "subroot": top["subroot"],
                "root": top["root"],
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": [x == top["root"] for x in folded],
            }
        )

    return _cogrouped(nodes, outer, levels).applyInPandas(check, schema)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    A leaf is the SHA-256 of doc_id, source, lang, n_chars and text, each as
    ``length in bytes:value`` or ``-`` for null; other columns do not count.
    Null sources are one tree, the first. Null ids come first in their source
    and are never tampered with. Rows with equal ids are ordered by their
    leaves; wholly equal rows take neighbouring places, each with its own proof.
    Empty and long texts are ordinary; a table of one row has its leaf as root
    and the hash of nothing as proof; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    nodes = pin(placed(leaves(docs.select(*FIELDS))).withColumn("doc_id", F.col("doc_id").cast("string")))
    largest, trees = nodes.agg(F.max("n"), F.max("tree") + 1).first()
    if largest is None:
        return docs.sparkSession.createDataFrame([], schema)
    climbed = _climb(nodes, largest, levels)
    roots = climbed[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(trees).alias("n"), "node")
    top = _climb(roots, trees, levels)
    none = F.array().cast("array<string>")
    outer = top[-1].select("tree", "pos", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    for level in reversed(top[:-1]):
        outer = _down(level, outer, levels)
    # A source's root knows its way to the root of all; from here on trees are sources.
    own = roots.select(F.col("pos").alias("tree"), "node")
    outer = outer.select(F.col("pos").alias("tree"), "lefts", "rights", "root").join(own, "tree")
    outer = outer.select("tree", F.lit(0).cast("long").alias("pos"), "lefts", "rights", F.col("node").alias("subroot"), "root")
    for level in reversed(climbed[1:-1]):
        outer = _down(level, outer, levels)
    out = _verified(climbed[0], outer, levels, schema.replace(kind, "string", 1))
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


_ENC = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in FIELDS[:-1]
)
_CRC = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))))"""
_TEXT = "CASE WHEN {t} IS NULL THEN '-' ELSE strlen({t}) || ':' || {t} END"


def _tree(name: str, base: str) -> str:
    return f"""{name} AS (
  {base}
  UNION ALL
  SELECT lvl + 1, src, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (max(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY lvl, src, pos // 3),
{name}_side AS (
  SELECT a.lvl, a.src, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS r
  FROM {name} a JOIN {name} b ON a.lvl = b.lvl AND a.src = b.src AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.lvl, a.src, a.pos)"""


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_ENC} || {_TEXT.format(t="text")}) AS leaf,
    sha256({_ENC} || {_TEXT.format(t="(CASE WHEN " + _CRC + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")}) AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS src
  FROM documents),
{_tree("t", "SELECT 0 AS lvl, src, pos, leaf AS node, n FROM d")},
{_tree("u", "SELECT 0 AS lvl, 0 AS src, src AS pos, node, (SELECT count(DISTINCT src) FROM d) AS n FROM t WHERE n = 1")},
f AS (
  SELECT doc_id, src, 0 AS lvl, pos, changed AS node, '' AS proof FROM d
  UNION ALL
  SELECT doc_id, f.src, f.lvl + 1, f.pos // 3, sha256(l || f.node || r), proof || l || r
  FROM f JOIN t_side s ON f.src = s.src AND f.lvl = s.lvl AND f.pos = s.pos),
g AS (
  SELECT doc_id, src, 0 AS lvl, src AS pos, node, proof
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl DESC) AS k FROM f) WHERE k = 1
  UNION ALL
  SELECT doc_id, g.src, g.lvl + 1, g.pos // 3, sha256(l || g.node || r), proof || l || r
  FROM g JOIN u_side s ON g.lvl = s.lvl AND g.pos = s.pos),
e AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY lvl DESC) AS k FROM g) WHERE k = 1)
SELECT doc_id, leaf, t.node AS subroot, u.node AS root, sha256(proof) AS proof_sha256, e.node AS folded_root,
  e.node = u.node AS verified
FROM d JOIN e USING (doc_id) JOIN t ON t.src = d.src AND t.n = 1 JOIN u ON u.n = 1
"""
