"""Removal of repeated passages against the plain definition, and the index against plain search."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, none, plain_docs, sentence

from tidewatch.llm import substring_dedup as S


def plain(docs):
    """Documents in order: (doc_id, words, removed, kept)."""
    seen, out = set(), []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        out.append((doc_id, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def passages(rng, n_docs=60):
    shared = [sentence(rng, rng.randrange(18, 90), 60) for _ in range(6)]
    texts = []
    for _ in range(n_docs):
        parts = [sentence(rng, rng.randrange(0, 40), 50)]
        for _ in range(rng.randrange(3)):
            cut = rng.choice(shared).split(" ")
            a = rng.randrange(0, 5)
            parts += [" ".join(cut[a : len(cut) - rng.randrange(5)]), sentence(rng, rng.randrange(0, 12), 50)]
        texts.append("\n".join(parts))
    return texts


@pytest.mark.parametrize(("hot", "shard_words"), [(S.HOT, S.SHARD_WORDS), (2, 300)])
def test_removed_is_what_stands_earlier(spark, hot, shard_words):
    rng = random.Random(12)
    texts = passages(rng)
    texts += ["a " * 70, "\x0ba\t" * 30, "a b " * 40, texts[3], texts[3] + " end", "Ä ö " * 25, "x y " * 24]
    docs = plain_docs(spark, texts)
    got = [tuple(r) for r in S.dedup_substrings(docs, hot, shard_words).collect()]
    assert Counter(got) == Counter(plain(enumerate(texts)))
    assert sum(r[2] for r in got) > 500


def test_awkward_rows(spark):
    docs = awkward(spark, ["a " * 60, "a " * 19, sentence(random.Random(1), 80)])
    rows = docs.select("doc_id", "text").collect()
    # Equal ids: any order of their rows has the same counts here, as their texts are equal.
    want = plain(sorted(((r.doc_id, r.text) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None)))
    got = [tuple(r) for r in S.dedup_substrings(docs).collect()]
    assert Counter(got) == Counter(want)
    assert S.dedup_substrings(none(docs)).count() == 0


def test_text_ids(spark):
    rng = random.Random(4)
    same = sentence(rng, 40)
    docs = spark.createDataFrame([("b", same), ("a", same), (None, "x")], "doc_id string, text string")
    assert {r.doc_id: r.n_removed for r in S.dedup_substrings(docs).collect()} == {"a": 0, "b": 40, None: 0}


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(2)
    lengths = rng.integers(6, 30, 40)
    flat = rng.integers(1, 4, lengths.sum())
    index = S.FMIndex(flat, lengths)
    rows = np.split(flat, np.cumsum(lengths)[:-1])
    runs = [tuple(r[i : i + 6]) for r in rows for i in range(len(r) - 5)]
    first = np.concatenate([s + np.arange(len(r) - 5) for s, r in zip(index.starts, rows)])
    low, high = index.search(first, 6)
    counts = Counter(runs)
    for run, a, b in zip(runs, low, high):
        assert b - a == counts[run] or (counts[run] == 1 and b - a == 1)
        if counts[run] > 1:
            for p in index.suffixes[a:b]:
                assert tuple(index.text[p : p + 6]) == run


def test_bits_count_ones():
    bits = np.random.default_rng(3).random(1000) < 0.3
    found = S.Bits(bits).ones(np.arange(1001))
    assert (found == np.concatenate([[0], np.cumsum(bits)])).all()


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    words = rng.integers(1, 2**63, 300, dtype=np.uint64)
    twice = np.concatenate([words, words[:7], words])
    anchors, first, n = S.segments(twice, np.zeros(len(twice), np.int64))
    by_window = {int(f) + k: int(a) for a, f, c in zip(anchors, first, n) for k in range(c)}
    assert sorted(by_window) == list(range(len(twice) - 19))
    for i in range(281):
        assert by_window[i] == by_window[307 + i]
    assert n.max() <= S.MOST_WINDOWS
    short = S.segments(words[:19], np.zeros(19, np.int64))
    assert all(len(x) == 0 for x in short)


def test_first_windows_of_a_shard():
    rng = np.random.default_rng(6)
    segs = [rng.integers(1, 3, rng.integers(20, 31)).astype(np.uint64) for _ in range(200)]
    segs += segs[:20]
    at = rng.permutation(len(segs)) * 100
    segs, at = zip(*{s.tobytes(): (s, int(a)) for s, a in zip(segs, at)}.values())
    codes = pa.array([" ".join(map(str, s)) for s in segs])
    got = set(zip(*(x.tolist() for x in S.first_windows(codes, np.array(at)))))
    least = {}
    for k, s in enumerate(segs):
        for i in range(len(s) - 19):
            w = s[i : i + 20].tobytes()
            least[w] = min(least.get(w, (10**9, 0, 0)), (int(at[k]) + i, k, i))
    assert got == {(k, i) for _, k, i in least.values()}
