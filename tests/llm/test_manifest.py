"""The manifest against a plain tree in Python."""

import hashlib
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, none, plain_docs

from tidewatch.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def root_and_paths(nodes):
    """The root, and for each leaf its siblings as (left, right) per level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // 3 * 3 : k // 3 * 3 + 3]
            paths[i].append(("".join(run[: k % 3]), "".join(run[k % 3 + 1 :])))
        at = [k // 3 for k in at]
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def plain(docs):
    groups = {}
    for r in docs:
        groups.setdefault(r.source, []).append(r)
    trees = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        rows = sorted(groups[source], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees.append((rows, *root_and_paths([leaf(r, r.text) for r in rows])))
    root, tops = root_and_paths([t[1] for t in trees])
    out = []
    for (rows, subroot, paths), top in zip(trees, tops):
        for r, path in zip(rows, paths):
            text = r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for left, right in path + top:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + top))
            out.append((r.doc_id, leaf(r, r.text), subroot, root, proof, node, node == root))
    return out


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest_is_the_plain_tree(spark, levels):
    rng = random.Random(levels)
    docs = awkward(spark, ["a\nb", "a\n\n", "same", "same"] + [f"t {rng.random()}\n{i}" for i in range(150)])
    docs = docs.unionByName(docs.filter("doc_id between 100 and 110"))  # repeated rows
    got = [tuple(r) for r in manifest.manifest(docs, levels=levels).collect()]
    assert Counter(got) == Counter(plain(docs.collect()))
    assert {r[-1] for r in got} == {True, False}


def test_one_row_one_source_and_no_rows(spark):
    one = plain_docs(spark, ["x\ny"], first=7)
    assert [tuple(r) for r in manifest.manifest(one).collect()] == plain(one.collect())
    singles = awkward(spark).dropDuplicates(["source"])
    assert Counter(tuple(r) for r in manifest.manifest(singles).collect()) == Counter(plain(singles.collect()))
    empty = manifest.manifest(none(one))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x\n"), ("a", "y"), (None, "z")], "doc_id string, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars"
    )
    got = {r.doc_id: r for r in manifest.manifest(docs).collect()}
    assert set(got) == {"a", "b", None} and got["a"].root == got["b"].root
