"""The isolation forest against one grown and scored in plain Python by the same draws."""

import hashlib
import math
import random

import numpy as np
import pytest
from compare import connect

from tidewatch.operators import anomaly


def draw(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def mean_path(n):
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def plain_forest(rows, trees, sample, seed):
    """(tree, node) -> (feature, cut, size)."""
    share = lambda wanted, total: math.floor(min(1.0, wanted / max(total, 1)) * 4294967296.0)
    pool = [(k, x) for k, x in rows if draw(seed, "pool", k) < share(1.5 * trees * sample, len(rows))]
    each = share(1.5 * sample + 50, len(pool))
    sample = min(sample, len(rows))
    limit, nodes = math.ceil(math.log2(max(sample, 2))), {}
    for tree in range(trees):
        ranked = sorted((draw(seed, "tree", tree, k), k, x) for k, x in pool)
        todo = [(0, 0, [x for d, _, x in ranked if d < each][:sample])]
        while todo:
            node, depth, part = todo.pop()
            spans = [(i, min(c), max(c)) for i, c in enumerate(zip(*part)) if max(c) > min(c)]
            if depth == limit or not spans:
                nodes[tree, node] = (-1, 0.0, len(part))
                continue
            i, low, high = spans[draw(seed, tree, node, "feature") % len(spans)]
            cut = low + draw(seed, tree, node, "cut") / 4294967296.0 * (high - low)
            nodes[tree, node] = (i, cut, len(part))
            for side, child in ((1, [x for x in part if x[i] < cut]), (2, [x for x in part if x[i] >= cut])):
                if child:
                    todo.append((2 * node + side, depth + 1, child))
    return nodes, sample


def plain_score(x, nodes, trees, sample):
    total = 0.0
    for tree in range(trees):
        node, length = 0, 0
        while nodes.get((tree, node), (-1, 0, 0))[0] != -1:
            i, cut, _ = nodes[tree, node]
            node, length = 2 * node + 1 + (x[i] >= cut), length + 1
        total += length + mean_path(nodes.get((tree, node), (-1, 0, 0))[2])
    return round(2 ** (-total / (trees * (mean_path(sample) or 1.0))), 6)


def table(n, rng):
    rows = [(f"k{i}", [rng.gauss(0, 1), float(rng.randrange(4)), 2.0]) for i in range(n)]
    return rows + [("far", [40.0, 30.0, 2.0]), ("same", rows[0][1])]


@pytest.mark.parametrize(("n", "trees", "sample"), [(120, 12, 32), (40, 6, 256), (900, 4, 16)])
def test_forest_is_the_plain_forest(spark, n, trees, sample):
    rows = table(n, random.Random(n))
    df = spark.createDataFrame([(k, *x) for k, x in rows], "id string, a double, b double, c double")
    forest, scored = anomaly.fit_and_score(df, "id", ("a", "b", "c"), trees, sample, 0.1, seed=7)
    nodes, own = plain_forest(rows, trees, sample, 7)
    got = {(r.tree, r.node): (r.feature, r.cut, r.size) for r in forest.nodes.itertuples()}
    assert got == nodes and forest.sample == own
    want = {k: plain_score(x, nodes, trees, own) for k, x in rows}
    found = {r.id: r for r in scored.collect()}
    assert {k: r.anomaly_score for k, r in found.items()} == pytest.approx(want, abs=1.1e-6)
    cut = np.quantile(list(want.values()), 0.9)
    assert forest.cut == pytest.approx(cut, abs=2e-6)
    assert all(r.is_anomaly == (r.anomaly_score > forest.cut) for r in found.values())
    assert found["far"].anomaly_score == max(r.anomaly_score for r in found.values())
    again = {r.id: (r.anomaly_score, r.is_anomaly) for r in forest.score(df).collect()}
    assert again == {k: (r.anomaly_score, r.is_anomaly) for k, r in found.items()}


def test_draws_are_those_of_sql(spark):
    from pyspark.sql import functions as F

    got = spark.range(5).select(anomaly.draw(F.lit(42), F.lit("tree"), F.col("id"), F.lit("é")).alias("d")).collect()
    sql = "SELECT CAST('0x' || substr(md5(concat_ws('|', 42, 'tree', i, 'é')), 1, 8) AS BIGINT) FROM range(5) t(i) ORDER BY i"
    assert [r.d for r in got] == [r[0] for r in connect("/nowhere").execute(sql).fetchall()]
    assert [r.d for r in got] == [draw(42, "tree", i, "é") for i in range(5)]
