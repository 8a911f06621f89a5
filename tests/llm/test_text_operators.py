"""License scan, decontamination, line dedup and Jaccard join against plain definitions."""

import hashlib
import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, none, plain_docs, sentence, words

from pyspark.sql import functions as F

from tidewatch.llm import decontamination, licenses, line_dedup, ngram_join

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def test_license_places_equal_plain_search(spark):
    rng = random.Random(1)
    texts = []
    for i in range(60):
        parts = sentence(rng, 30).split()
        for phrase in rng.sample([*PHRASES, "mit license", "apache license", "the MIT  License", "CC-BY-NC"], 3):
            parts.insert(rng.randrange(len(parts)), phrase)
        texts.append(" ".join(parts))
    docs = awkward(spark, texts)
    got = sorted(map(str, licenses.license_labels(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()))
    want = []
    for r in docs.collect():
        w, starts, labels = words(r.text), [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
            starts += here
            labels |= {label} if here else set()
        row = (r.doc_id, len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        want.append("Row(doc_id={}, n_words={}, n_base={}, first_word={}, last_word={}, base_labels={!r})".format(*row))
    assert got == sorted(want)


def test_license_notices_allow_small_edits(spark):
    notice = licenses.NOTICES[0].text
    moved = notice.replace("to any person", "to each and any person")
    docs = plain_docs(spark, [f"x y {notice} z", moved, notice.replace("without restriction", "never"), "", None])
    rows = {r.doc_id: r for r in licenses.license_labels(docs).collect()}
    assert [rows[i].labels for i in range(5)] == ["mit", "mit", "", "", ""]
    assert all(0 <= r.score <= 1 for r in rows.values()) and rows[0].score == 1.0
    assert licenses.license_labels(none(docs)).count() == 0


def plain_contamination(text, items, window=10):
    w, hit, names, longest = words(text), set(), set(), 0
    for name, said in items:
        b = words(said)
        size = min(len(b), window)
        for s in range(len(b) - size + 1) if b else ():
            for p in range(len(w) - size + 1):
                if w[p : p + size] == b[s : s + size]:
                    names.add(str(name))
                    hit |= set(range(p, p + size))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def test_contamination_equals_plain_windows(spark):
    rng = random.Random(2)
    items = [(i, sentence(rng, rng.choice([3, 9, 10, 11, 25, 40]), 60)) for i in range(25)] + [(90, ""), (91, None), (92, "!!")]
    texts = []
    for _ in range(80):
        parts = sentence(rng, 40, 60).split()
        for _ in range(2):
            source = rng.choice(items[:25])[1].split()
            a = rng.randrange(len(source))
            parts[rng.randrange(len(parts)) : 0] = source[a : a + rng.randrange(1, 30)]
        texts.append(" ".join(parts).upper() if rng.random() < 0.3 else " ".join(parts))
    docs = awkward(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.contamination(docs, benchmark).drop("longest_match")
    want = sorted(str((r.doc_id, *plain_contamination(r.text, items))) for r in docs.collect())
    assert sorted(str(tuple(r)) for r in got.collect()) == want
    # The same in passes over a small part of the benchmark each.
    found, count, matches = decontamination.benchmark_matches(docs, benchmark, broadcast_bytes=1500)
    hits = found.select("doc_id", F.size(F.array_distinct(F.transform(matches, lambda m: m.item_id))).alias("n"))
    assert sorted(str(tuple(r)) for r in hits.collect()) == sorted(str((r.doc_id, r.n_items)) for r in got.collect())
    kept = decontamination.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == got.filter("NOT contaminated").count()
    assert decontamination.decontaminate(docs, none(benchmark)).count() == docs.count()
    assert decontamination.contamination(none(docs), benchmark).count() == 0


def test_longest_match_and_its_place(spark):
    item = " ".join(f"b{i}" for i in range(40))
    text = "x y " + " ".join(f"b{i}" for i in range(5, 30)) + " z"
    docs = plain_docs(spark, [text])
    found, _, matches = decontamination.benchmark_matches(docs, spark.createDataFrame([("q", item)], "item_id string, text string"))
    assert [tuple(m) for m in found.select(matches).first()[0]] == [("q", 5, 2, 25)]


def plain_components(docs, size=5, least=80):
    sets = {}
    for i, (key, text) in enumerate(docs):
        w = (text or "").translate({k: k + 32 for k in range(65, 91)})
        for c in "\t\n\x0b\x0c\r":
            w = w.replace(c, " ")
        w = [x for x in w.split(" ") if x]
        grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        sets[i] = grams
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= least * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, (key, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(key)
    names = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return sorted(str((key, len(sets[i]), names[find(i)])) for i, (key, _) in enumerate(docs))


def near_copies(rng, groups=6, copies=25, most=6):
    texts = []
    for g in range(groups):
        base = sentence(rng, rng.choice([12, 22, 60, 130, 400]), 10_000).split()
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randrange(most)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    return texts


def test_jaccard_components_equal_all_pairs(spark):
    texts = near_copies(random.Random(3)) + ["a", "a b", "A B", "a b c", "a b d"]
    docs = awkward(spark, texts)
    got = sorted(str(tuple(r)) for r in ngram_join.jaccard_components(docs).collect())
    assert got == plain_components([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    strict = ngram_join.jaccard_components(docs, words=3, numerator=90)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(str(tuple(r)) for r in strict.collect()) == plain_components(rows, 3, 90)
    kept = ngram_join.one_per_component(docs)
    assert kept.columns == docs.columns
    assert ngram_join.jaccard_components(none(docs)).count() == 0


def test_jaccard_tiles_give_the_same(spark, monkeypatch):
    texts = near_copies(random.Random(4), groups=1, copies=120, most=9)
    docs = plain_docs(spark, texts)
    want = plain_components([(i, t) for i, t in enumerate(texts)])
    monkeypatch.setattr(ngram_join, "TILE", 16)
    assert sorted(str(tuple(r)) for r in ngram_join.jaccard_components(docs).collect()) == want


def test_packed_leaves_tell_all_shared_ones():
    import numpy as np

    rng = np.random.default_rng(5)
    values = rng.integers(-(2**63), 2**63 - 1, 300)
    leaf, ids = rng.choice(values, 900), rng.integers(-50, 50, 900)
    batches = [ngram_join.pack_leaves(leaf[k : k + 300], ids[k : k + 300], 7).to_pylist() for k in (0, 300, 600)]
    got = {}
    for part in range(7):
        rows = [r for batch in batches for r in batch if r["part"] == part]
        for a, b in zip(*ngram_join.shared_leaves(part, *([r[c] for r in rows] for c in ("ids", "counts", "keys")))):
            assert b not in got.setdefault(a, set())
            got[a].add(b)
    want = [set(ids[leaf == x]) for x in set(leaf)]
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want if len(x) > 1)


def test_line_dedup_deletes_later_runs(spark):
    rng = random.Random(6)
    lines = [sentence(rng, 9, 10_000).replace(".", "") + ". " for _ in range(12)]
    passage = "".join(lines[:6])
    mine, yours = (f"alone {k} " + sentence(rng, 8, 10_000).replace(".", "") + ". " for k in (1, 2))
    texts = [mine + passage + "end one.", yours + passage + "end two.", passage, lines[7] + "short. ", lines[7] + "other. ", None, "", passage + passage]
    docs = plain_docs(spark, texts)
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert out[0] == texts[0]
    assert out[1] == yours + "end two."
    assert 2 not in out and 7 not in out  # nothing but later copies
    assert out[3] == texts[3] and out[4] == texts[4]  # a single short line is no passage
    assert out[5] is None and out[6] == ""


def plain_repeats(texts, least=25):
    """Lines of each text inside a run of ``least`` words that stands in an earlier text or earlier in its own."""
    import re

    seen, out = set(), []
    for text in texts:
        lines = [x for x in re.split(line_dedup.LINE_END, text) if x]
        said = [x.rstrip(" ") for x in lines]
        mine, gone = set(), set()
        for i in range(len(said)):
            for j in range(i + 1, len(said) + 1):
                run = tuple(said[i:j])
                if sum(x.count(" ") + 1 for x in run) >= least:
                    if run in seen or run in mine:
                        gone |= set(range(i, j))
                    mine.add(run)
        seen |= mine
        out.append(sorted(gone))
    return out


def line(rng, n):
    return " ".join(f"v{rng.randrange(10**6)}" for _ in range(n)) + ". "


def test_line_dedup_finds_every_passage(spark):
    """Passages of 1 to 8 lines of any length in other surroundings, against the plain definition."""
    rng = random.Random(12)
    texts = []
    passages = ["".join(line(rng, rng.randrange(1, 32)) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    for _ in range(120):
        parts = [line(rng, rng.randrange(1, 32)) for _ in range(rng.randrange(1, 9))]
        parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        texts.append("".join(parts))
    got = {r.id: r.gone or [] for r in line_dedup.repeated_lines(plain_docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_repeats(texts)


def test_line_dedup_counts_letters_of_scripts_without_spaces(spark):
    passage = "".join(chr(0x4E00 + 37 * i) + ("。" if i % 10 == 9 else "") for i in range(40))
    texts = ["一乙丁。" + passage + "七万丈。", "三上下。" + passage + "不与丐。"]
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(plain_docs(spark, texts)).collect()}
    assert out == {0: texts[0], 1: "三上下。不与丐。"}


def test_line_dedup_keeps_clean_text_and_awkward_rows(spark):
    rng = random.Random(7)
    texts = [sentence(rng, 120, 10**6) for _ in range(30)]
    docs = awkward(spark, texts)
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert all(rows[100 + i] == t for i, t in enumerate(texts))
    assert 1 in rows and 2 not in rows
    assert line_dedup.dedup_lines(none(docs)).count() == 0


def test_lines_are_the_text(spark):
    texts = ["a. b\nc, d! e", "x\x01y. z", "", "...  ", "no end"]
    docs = plain_docs(spark, texts)
    got = docs.select("text", line_dedup.lines_of(F.col("text")).alias("l"), F.split("text", line_dedup.LINE_END).alias("s")).collect()
    for r in got:
        assert "".join(r.l) == r.text and r.l == [x for x in r.s if x]


def test_line_dedup_hashes_only_runs_around_a_place(spark):
    text = "".join(f"w{i}a w{i}b w{i}c w{i}d w{i}e w{i}f.\n" for i in range(80))
    lines = line_dedup._hashed(plain_docs(spark, [text]), "doc_id", "text")
    places = spark.createDataFrame([(0, [40])], "k bigint, ps array<int>")
    runs = line_dedup._passages(lines, places, line_dedup.MIN_WORDS).first().runs
    # 25 words are five lines here; what begins at the lines 37 to 40 may have its fingerprint at 40.
    assert sorted((r.start, r.end) for r in runs) == [(s, s + 5) for s in range(37, 41)]


def test_line_dedup_joins_a_pair_in_each_context(spark):
    """The pairs of a passage stand in earlier texts too, each alone."""
    rng = random.Random(13)
    passage = [line(rng, 6) for _ in range(5)]
    early = [line(rng, 9) + "".join(passage[k : k + 2]) + line(rng, 9) for k in range(4)]
    texts = [*early, line(rng, 7) + "".join(passage) + line(rng, 7), line(rng, 8) + "".join(passage) + line(rng, 8)]
    got = {r.id: r.gone for r in line_dedup.repeated_lines(plain_docs(spark, texts)).collect()}
    assert [got[i] for i in range(6)] == [None] * 5 + [[1, 2, 3, 4, 5]]


def test_line_dedup_computes_arrays_once(spark):
    """Rows of lines and runs are made by compiled steps, which copy no array; no condition repeats the work on a text."""
    rng = random.Random(14)
    docs = plain_docs(spark, ["".join(line(rng, 6) for _ in range(9))] * 2)
    texts = line_dedup._hashed(docs, "doc_id", "text")
    places = spark.createDataFrame([(0, [4])], "k bigint, ps array<int>")
    plans = [line_dedup._prints(texts, 25), line_dedup._passages(texts, places, 25)]
    plans.append(line_dedup.dedup_lines(docs))
    for frame in plans:
        rows = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not [r for r in rows if "Filter" in r and ("lambda" in r or "split(" in r)]
        assert not [r for r in rows if "Generate" in r and "lambda" in r]
    compiled = plans[0]._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [r for r in compiled if "Generate" in r]
    assert len(made) == 2 and all("*(" in r for r in made)


def test_line_dedup_finds_passages_of_every_length(spark):
    """Other bounds of words, the last lines of a text, and ids that stand twice, against the plain definition."""
    rng = random.Random(15)
    shared = ["".join(line(rng, rng.randrange(1, 5)) for _ in range(rng.randrange(1, 12))) for _ in range(12)]
    texts = ["".join(rng.choice(shared) if rng.random() < 0.5 else line(rng, 3) for _ in range(5)) for _ in range(60)]
    for least in (1, 2, 7, 40):
        got = {r.id: r.gone or [] for r in line_dedup.repeated_lines(plain_docs(spark, texts), min_words=least).collect()}
        assert [got[i] for i in range(len(texts))] == plain_repeats(texts, least)
    twice = spark.createDataFrame([(7, texts[0]), (7, texts[0]), (7, texts[1]), (8, texts[0])], "doc_id bigint, text string")
    rows = [(r.id, r.gone or []) for r in line_dedup.repeated_lines(twice).collect()]
    own = [plain_repeats([t])[0] for t in texts[:2]]
    last = plain_repeats([texts[0], texts[0]])[1]
    assert sorted(rows) == sorted([(7, own[0]), (7, own[0]), (7, own[1]), (8, last)])


def test_license_sql_on_every_notice(spark, tmp_path):
    """Documents with each notice, whole, edited within and beyond the drift, and cut."""
    import duckdb
    from compare import difference, rows_of, spark_rows

    rng = random.Random(11)
    texts = []
    for t in licenses.TEMPLATES:
        w = t.text.split()
        more = [*w[: len(w) // 2], *["extra"] * rng.randrange(1, 6), *w[len(w) // 2 :]]
        texts += [f"aa {t.text} bb", " ".join(more), " ".join(w[:-1]), f"{t.text} {t.text}", " ".join(w[2:])]
    docs = plain_docs(spark, texts + [sentence(rng, 40) for _ in range(40)] + ["", None])
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    cur = con.execute(licenses.ORACLE)
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert difference(spark_rows(licenses.license_labels(docs)), want) is None
