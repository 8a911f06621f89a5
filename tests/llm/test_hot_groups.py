"""Repeated words, repeated notices and dense groups: work and memory in proportion, results whole."""

import random
import resource
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import plain_docs

from tidewatch.llm import decontamination, embedding_dedup, licenses, line_dedup, ngram_join
from tidewatch.llm.common import word_blocks


def matches_of(text, items, window=10):
    targets = decontamination.Targets(items, window)
    out = []
    for _, _, words, row in word_blocks(pa.array([text]), limit=1 << 30):
        found = decontamination.shard_matches(words, row, targets, window)
        out += list(zip(*(x.tolist() for x in found)))
    return out


def plain_matches(text, items, window=10):
    """Every common run that cannot grow, of a window at least."""
    w, out = text.split(), []
    for i, (_, said) in enumerate(items):
        b = said.split()
        need = min(len(b), window)
        for s in range(len(b)):
            for p in range(len(w)):
                if s and p and b[s - 1] == w[p - 1]:
                    continue
                n = 0
                while s + n < len(b) and p + n < len(w) and b[s + n] == w[p + n]:
                    n += 1
                if n >= need:
                    out.append((0, i, s, p, n))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_longest_matches_of_few_different_words(seed):
    rng = random.Random(seed)
    make = lambda n, k: " ".join(rng.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(str(i), make(rng.choice([1, 4, 12, 30]), rng.choice([1, 2, 3]))) for i in range(5)]
    text = make(120, 2) + " zz " + items[2][1] + " " + make(40, 1)
    assert sorted(matches_of(text, items)) == sorted(plain_matches(text, items))


def test_a_megabyte_of_one_word_and_an_item_of_it():
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.time()
    found = matches_of("word " * 200_000, [("q", "word " * 1000)])
    assert len(found) == 200_000 - 9 + 1000 - 9 - 1 and max(f[4] for f in found) == 1000
    assert time.time() - began < 20
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_a_notice_repeated_thousands_of_times(spark):
    rows = {}
    began = time.time()
    for n in (50, 8000):
        docs = plain_docs(spark, ["gnu general public license version 2 under the mit license " * n])
        rows[n] = licenses.license_labels(docs).first()
    assert rows[8000].n_words == 80_000 and rows[8000].n_base == 8000 and rows[8000].labels == rows[50].labels
    assert time.time() - began < 60


def test_recall_in_a_dense_group_of_different_near_copies(spark):
    """A third of the vectors lie around one point, all different, most of them linked."""
    rng = np.random.default_rng(5)
    n, dim = 9000, 64
    base = rng.normal(size=dim)
    base /= np.linalg.norm(base)
    near = rng.normal(size=(n // 3, dim))
    near -= (near @ base)[:, None] * base
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    cosine = rng.uniform(0.955, 0.99, (n // 3, 1))
    dense = cosine * base + np.sqrt(1 - cosine**2) * near
    vectors = np.concatenate([dense, rng.normal(size=(n - len(dense), dim))])
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>, label int")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    found = np.array([got[i].n_links for i in range(n)])
    assert (found <= links).all()
    assert found.sum() >= 0.99 * links.sum()


def test_text_ids(spark):
    said = " ".join(f"w{i}" for i in range(60))
    lines = "".join(f"This is the line number {i} of a passage that is told again. " for i in range(8))
    docs = spark.createDataFrame([("x", said), ("y", said), ("z", lines), ("a", lines), (None, "q")], "doc_id string, text string")
    components = [r.component_id for r in ngram_join.jaccard_components(docs).collect()]
    assert len(set(components)) == 3
    assert ngram_join.one_per_component(docs).count() == 3
    assert line_dedup.dedup_lines(docs).count() in (3, 4)


def test_marks_bound_what_sets_share():
    rng = np.random.default_rng(8)
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
    for n, m, common in [(1, 1, 0), (1, 1, 1), (0, 5, 0), (300, 310, 290), (40, 9000, 40), (5000, 5600, 5000), (128, 129, 5)]:
        both = draw(common)
        a, b = np.concatenate([both, draw(n - common)]), np.concatenate([both, draw(m - common)])
        bound = ngram_join.most_shared(len(a), len(b), ngram_join.marks(a), ngram_join.marks(b))
        assert common <= bound <= min(n, m)
    # Large sets that share nothing are told apart.
    a, b = draw(7000), draw(7500)
    assert ngram_join.most_shared(7000, 7500, ngram_join.marks(a), ngram_join.marks(b)) < 0.7 * 7000
