"""Sharding, packing, components and the pipeline."""

import random
import sys
import zlib
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import numpy as np
import pytest
from conftest import SF
from helpers import awkward, none, plain_docs, sentence

import corpus_pipeline
from tidewatch.llm import packing, sharding
from tidewatch.llm.components import components


def check_shards(rows, docs, shards=8):
    assert len(rows) == len(docs)
    want = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    for s in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < shards for r in rows)


def test_shards_of_even_bytes(spark):
    rng = random.Random(8)
    texts = [sentence(rng, rng.randrange(5, 90)) for _ in range(1500)]
    texts += [texts[0]] * 900  # one text holds a third of the rows
    docs = plain_docs(spark, texts)
    rows = sharding.kd_shards(docs).collect()
    check_shards(rows, docs.collect())
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) <= 1.03 * min(sizes.values())
    where = {}
    for r in rows:
        where.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 7  # only groups that a cut must go through


@pytest.mark.parametrize("rows", ["awkward", "none", "one"])
def test_shards_of_awkward_rows(spark, rows):
    docs = awkward(spark)
    docs = {"awkward": docs, "none": none(docs), "one": docs.limit(1)}[rows]
    check_shards(sharding.kd_shards(docs).collect(), docs.collect())


def test_packing_is_a_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(9)
    texts = [sentence(rng, rng.randrange(0, 4000)) for _ in range(60)] + ["It's <|endoftext|> we'll  see\n\n¿qué? 12", "a" * 5000]
    docs = awkward(spark, texts)
    pieces = packing.pack(docs, range_ids=40_000).collect()
    ids = {}
    for d in docs.collect():
        found = whole.encode(d.text or "", add_special_tokens=False).ids + [1]
        ids.setdefault(d.doc_id, []).append(np.array(found, "<u4"))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert any(
            len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in ids[p.doc_id]
        )
    for d, found in ids.items():
        assert sum(p.length for p in by_doc[d]) == sum(map(len, found))
    full = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        full += at == 2048
    assert full >= len(by_sequence) * 0.7
    assert packing.pack(none(docs)).count() == 0


def test_other_tokenizer_files_use_the_library():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    found = packing.Encoder(path)
    assert not found.ranked
    assert [list(x) for x in found.ids(["Some words", None])] == [
        found.whole.encode("Some words", add_special_tokens=False).ids, found.whole.encode("", add_special_tokens=False).ids
    ]


def test_hilbert_neighbours_touch():
    import itertools

    points = np.array(list(itertools.product(range(16), repeat=3)))
    keys = packing.hilbert_key(points, 4)
    order = points[np.argsort(keys)]
    assert sorted(keys) == list(range(16**3))
    assert np.abs(np.diff(order, axis=0)).sum(axis=1).max() == 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(7, 7), (None, 3), (5, 4)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in linked}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        n = after.count()
        assert 0 < n <= docs.count()
        assert stage(spark, none(docs), SF).count() == 0
        docs = after
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_drops_near_copies_of_five_words(spark):
    """A block of 20 replaced words and 45 appended ones: 0.85 and 0.87 with five words, below 0.9 with three."""
    base = [f"w{i}" for i in range(300)]
    block = [*base[:100], *(f"x{i}" for i in range(20)), *base[120:]]
    longer = [*base, *(f"y{i}" for i in range(45))]
    other = [*base[:100], *(f"z{i}" for i in range(60)), *base[160:]]
    docs = plain_docs(spark, [" ".join(w) for w in (base, block, longer, other)])
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    assert sorted(r.doc_id for r in stage(spark, docs, SF).collect()) == [0, 3]


def test_pipeline_takes_awkward_rows(spark):
    """Null and repeated ids, null, empty and long texts, repeated rows and clashing columns, stage by stage."""
    docs = awkward(spark, ["you worthless pathetic idiot scum"] * 2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.dtypes == docs.dtypes, name
        rows = after.collect()
        texts = {r.text for r in docs.collect()}
        assert name == "line dedup" or {r.text for r in rows} <= texts
        assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}
