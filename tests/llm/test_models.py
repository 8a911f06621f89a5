"""Language, toxicity, quality, embeddings: against definitions, recall and held-out accuracy."""

import itertools
import math
import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import numpy as np
from conftest import SF_ORACLE
from helpers import awkward, none, plain_docs

from tidewatch.llm import embedding_dedup, language, quality, toxicity
from tidewatch.llm.common import learning_row


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    scores = rng.normal(0, 3, (40, 3)).astype(np.float32)
    counts = np.array([6, 1, 0, 7, 5])
    number = rng.integers(0, 40, counts.sum())
    got = language.viterbi(scores, number, counts, 2.0)
    begin = 0
    for n in counts:
        at = number[begin : begin + n]

        def value(path):
            return sum(scores[w, s] for w, s in zip(at, path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert math.isclose(value(got[begin : begin + n]), best, abs_tol=1e-3)
        begin += n


def test_language_held_out_accuracy_and_cases(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = language.op4_language_id(spark, SF_ORACLE).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    model = language.fit(docs)
    found, (lang, score, spans) = language.language_spans(awkward(spark), model)
    by_text = {r.text: r for r in found.collect()}
    for text in (None, "", " \n\t ", "— … 😀"):
        assert (by_text[text][lang], by_text[text][score]) == ("und", 0.0)
    assert all(sum(s.words for s in r[spans]) >= 0 and 0 <= r[score] <= 1 for r in by_text.values())
    nothing, (lang, _, _) = language.language_spans(awkward(spark), language.fit(none(docs)))
    assert {r[lang] for r in nothing.collect()} == {"und"}


def test_mixed_text_has_spans(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    model = language.fit(docs)
    part = {r.lang: r.text[:600] for r in docs.filter("lang IN ('en', 'de') AND length(text) > 1000").collect()}
    found, (_, _, spans) = language.language_spans(plain_docs(spark, [part["en"] + " " + part["de"]]), model)
    order = [s.lang for s in found.first()[spans]]
    assert order[0] == "en" and order[-1] == "de"


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(2)
    space = toxicity.Vectors(np.arange(40, dtype=np.uint64), np.ones(40))
    rows = []
    for k in range(500):
        term = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        value = rng.random(len(term)) + 0.1
        value /= np.sqrt((value**2).sum())
        rows.append((term.astype("<i4").tobytes() + value.tobytes(), int(k % 3 == 0), int(k % 3 > 0), str(k)))
    index = toxicity.BlockMaxIndex(space, rows, (1.0, 1.0))
    dense = np.zeros((len(index.ids), 40))
    for i in range(len(dense)):
        dense[i, index.term[index.cuts[i] : index.cuts[i + 1]]] = index.value[index.cuts[i] : index.cuts[i + 1]]
    for _ in range(50):
        term = np.sort(rng.choice(40, 4, replace=False))
        weight = np.full(4, 0.5)
        entries, sims = index.nearest(term, weight, 10)
        want = np.sort(dense[:, term] @ weight)[::-1]
        want = want[(want >= want[9] - 1e-12) & (want > 0)]
        assert np.allclose(np.sort(sims)[::-1], want)


def test_toxicity_held_out_and_cases(spark):
    sf = SF_ORACLE.replace("sf0.01", "sf0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.op6_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    bad, good = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert sum(r.predicted for r in good) <= 0.02 * len(good)
    index = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    docs = awkward(spark)
    found, (score, _, near) = toxicity.toxicity_scores(docs, index)
    silent = {r.text: (r[score], r[near]) for r in found.collect()}
    assert silent[None] == silent[""] == (index.silent, None)
    assert toxicity.without_toxic(docs, labels).columns == docs.columns
    empty, (score, _, _) = toxicity.toxicity_scores(docs, toxicity.fit(docs, none(labels)))
    assert {r[score] for r in empty.collect()} == {0.0}


def plain_kneser_ney(texts, order):
    """Probabilities by the textbook, over dictionaries."""
    grams = {}
    for t in texts:
        s = [quality.BREAK] * (order - 1) + [int(quality.SYMBOL[b]) for b in t.encode()]
        for i in range(len(s) - order + 1):
            g = tuple(s[i : i + order])
            grams[g] = grams.get(g, 0) + 1
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        c = {}
        for g in counts[k + 1]:
            c[g[1:]] = c.get(g[1:], 0) + 1
        counts[k] = c
    cuts = {k: quality.discounts(*[sum(v == n for v in c.values()) for n in (1, 2, 3, 4)]) for k, c in counts.items()}

    def p(g):
        k = len(g)
        if not k:
            return 1 / quality.SYMBOLS
        same = [v for x, v in counts[k].items() if x[:-1] == g[:-1]]
        if not same:
            return p(g[1:])
        d = lambda v: cuts[k][min(v, 3) - 1]
        n, total = counts[k].get(g, 0), sum(same)
        return ((n - d(n)) / total if n else 0) + sum(map(d, same)) / total * p(g[1:])

    return p


def test_model_equals_textbook(spark):
    texts = ["the cat sat on the mat.", "A cat, a hat!", "mats and 12 cats\nare flat", "thé à la carte"]
    model = quality.train(plain_docs(spark, texts))
    p = plain_kneser_ney(texts, quality.ORDER)
    rng = random.Random(3)
    logs = model.logs()
    some = "the cat zzz! é\nQ"
    s = [quality.BREAK] * (quality.ORDER - 1) + [int(quality.SYMBOL[b]) for b in some.encode()]
    for i in range(len(s) - quality.ORDER + 1):
        g = tuple(s[i : i + quality.ORDER])
        at = sum(x << (quality.BITS * (quality.ORDER - 1 - j)) for j, x in enumerate(g))
        assert math.isclose(math.exp(logs[at]), p(g), rel_tol=1e-4)
    whole = np.exp(logs.reshape(-1, quality.SYMBOLS)[rng.sample(range(64**3), 500)]).sum(axis=1)
    assert np.allclose(whole, 1, atol=1e-4)
    scored, (n, entropy) = quality.cross_entropy(awkward(spark, [some]), model)
    row = scored.filter("doc_id = 100").first()
    assert row[n] == len(some.encode())
    want = -sum(math.log(p(tuple(s[i : i + quality.ORDER]))) for i in range(len(s) - quality.ORDER + 1)) / row[n]
    assert math.isclose(row[entropy], want, rel_tol=1e-4)


def test_quality_keeps_good_texts(spark):
    sf = SF_ORACLE.replace("sf0.01", "sf0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.op10_quality(spark, sf).join(labels, "doc_id").filter(~learning_row(labels.doc_id)).collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.85 * len(bad)


def test_quality_cases(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (6, 1), (6, 0)], "doc_id bigint, quality int")
    for known in (labels, none(labels)):
        rows = quality.quality(docs, known).collect()
        assert len(rows) == docs.count()
        assert all(r.kept == False and r.entropy is None for r in rows if r.symbols == 0)  # noqa: E712
    assert all(r.kept for r in rows if r.symbols)
    assert quality.quality(none(docs), labels).count() == 0


def vectors(n=300, dim=32, seed=4):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(n // 6):
        base = rng.normal(size=dim)
        base /= np.linalg.norm(base)
        for _ in range(6):
            off = rng.normal(size=dim)
            off -= off @ base * base
            # Cosines to the base from just above to just below the threshold.
            c = rng.uniform(0.915, 0.999)
            rows.append((k, [float(x) for x in (c * base + math.sqrt(1 - c * c) * off / np.linalg.norm(off)) * 3.0], g % 3))
            k += 1
        rows.append((k, [float(x) for x in base], g % 3))
        k += 1
    odd = [[0.0] * dim, None, [float("nan")] * dim, [1.0, None] * (dim // 2), [float("inf")] + [0.0] * (dim - 1), [], [1.0, 2.0]]
    rows += [(k + i, v, 0) for i, v in enumerate(odd)]
    rows += [(1000, rows[0][1], None), (1001, rows[0][1], rows[0][2]), (1001, rows[0][1], rows[0][2]), (None, rows[7][1], rows[7][2])]
    return rows


def test_embedding_links_and_recall(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, cid string")
    good = [r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) and r[2] is not None for r in rows]

    def cosine(a, b):
        return float(np.dot(a, b) / math.sqrt(np.dot(a, a) * np.dot(b, b)))

    links = {
        i: [j for j in range(len(rows)) if j != i and good[i] and good[j] and rows[i][2] == rows[j][2]
            and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.93]
        for i in range(len(rows))
    }
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    total = sum(map(len, links.values()))
    assert total and sum(r.n_links for r in got) >= 0.9 * total
    want: dict = {}
    for i, r in enumerate(rows):
        want.setdefault(r[0], []).append(len(links[i]))
    assert all(r.n_links <= max(want[r.vec_id]) for r in got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert embedding_dedup.near_duplicates(none(df)).count() == 0


def test_embedding_tiles_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(vectors(120), "vec_id bigint, embedding array<double>, label int")
    once = sorted(map(str, embedding_dedup.near_duplicates(df).collect()))
    monkeypatch.setattr(embedding_dedup, "TILE", 5)
    assert sorted(map(str, embedding_dedup.near_duplicates(df).collect())) == once


def test_bytes_are_joined_to_their_count_tables(spark, monkeypatch):
    texts = ["the cat sat on the mat.", "кот сидит на ковре", "кошка и кот", "漢字と仮名", "thé à la carte"]
    odd = ["the cat zzz! é\nQ", "кот на столе", "漢字漢字", "\n"]
    docs = awkward(spark, odd)
    for chunk_bytes in (1 << 20, 2000):
        rows = quality.joined_entropy(docs, quality.count_tables(plain_docs(spark, texts)), chunk_bytes).collect()
        assert len(rows) == docs.count()
        got = {r.doc_id: r for r in rows}
        assert all(r.entropy is None for r in rows if r.symbols == 0)
        with monkeypatch.context() as patch:
            patch.setattr(quality, "SYMBOL", quality.BYTE)
            patch.setattr(quality, "SYMBOLS", 256)
            patch.setattr(quality, "BREAK", 10)
            p = plain_kneser_ney(texts, quality.LENGTH)
            for i, text in enumerate(odd):
                s = [10] * (quality.LENGTH - 1) + list(text.encode())
                want = -sum(math.log(p(tuple(s[j : j + quality.LENGTH]))) for j in range(len(text.encode())))
                assert got[100 + i].symbols == len(text.encode())
                assert math.isclose(got[100 + i].entropy, want / len(text.encode()), rel_tol=1e-9)
    nothing = quality.joined_entropy(docs, quality.count_tables(none(docs))).filter("symbols > 0").collect()
    assert nothing and all(math.isclose(r.entropy, math.log(256)) for r in nothing)


def test_quality_tells_letters_of_any_script_apart(spark):
    rng = random.Random(6)
    words = ["кот", "дом", "река", "поле", "ветер", "книга"]
    good = [" ".join(rng.choices(words, k=60)) for _ in range(40)]
    # Two letters on within one lead byte: the same classes of bytes, no such words.
    junk = "".join(chr(ord(c) + 2) if "а" <= c <= "н" else c for c in good[0])
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id bigint, quality int")
    rows = {r.doc_id: r for r in quality.quality(plain_docs(spark, [*good, junk]), labels).collect()}
    assert rows[40].entropy > rows[0].entropy + 1 and rows[0].kept and not rows[40].kept
