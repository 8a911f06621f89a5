"""Large lists against plain search, and large ledgers against the whole-file reader."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import phrases
from tidewatch.session import scratch_path
from tidewatch.sources import ledger as source
from tidewatch.sources.ledger import read_large_ledger
from tidewatch.sources.readers import read_ledger


def test_a_hundred_thousand_phrases(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(3, 9)))
    listed = [word() for _ in range(100_000)] + ["", None, "aa", "a"]
    texts = [(i, " ".join(word() for _ in range(rng.randrange(0, 60)))) for i in range(40)] + [(90, None), (91, ""), (None, "aa")]
    df = spark.createDataFrame(texts, "id int, t string")
    table = spark.createDataFrame([(p,) for p in listed], "phrase string")
    want = {(i, p) for i, t in texts for p in set(listed) if p and t and p in t}
    for shard_bytes in (phrases.SHARD_BYTES, 200_000):
        got = [tuple(r) for r in phrases.find_phrases(df, "id", "t", table, shard_bytes).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert phrases.find_phrases(df, "id", "t", table.filter("false")).count() == 0


def test_listed_words(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "x"), (3, None)], "id int, t string")
    words = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "word string")
    got = phrases.with_listed_words(df, "id", F.split("t", " "), words).collect()
    assert sorted(tuple(r) for r in got) == [(1, "a"), (1, "c")]


def ledger(rng, users):
    tricky = ['plain', 'quote " in', 'back \\', '\\\\" {', '}, "x": {', "é漢字😀", "\n\t", "[[{", "", '\\"', "\\" * 7]
    entry = lambda: {"offense": rng.choice(tricky), "points": rng.choice([1, -2, None]), "content": "".join(rng.sample(tricky, 3)), "timestamp": "2024"}
    return {
        f"u{i}{rng.choice(tricky)}": {"name": rng.choice(tricky), "behavior_score": i, "history": [entry() for _ in range(rng.randrange(6))]}
        for i in range(users)
    }


def rows(df):
    return sorted((r.user_id, r.name, r.behavior_score, str(r.history)) for r in df.collect())


@pytest.mark.parametrize("split", [7, 64, 1000])
@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_split_ledger_is_the_whole_ledger(spark, split, style):
    folder = Path(scratch_path(spark, "ledger").removeprefix("file:"))
    folder.mkdir()
    path = folder / "one.json"
    path.write_text(json.dumps(ledger(random.Random(split), 4 if split == 7 else 25), **style), encoding="utf-8")
    want = rows(read_ledger(spark, str(path)))
    got = read_large_ledger(spark, str(path), split)
    assert rows(got) == want and len(want) >= 4
    if split == 1000:
        assert got.select(F.spark_partition_id()).distinct().count() > 1


def test_small_splits_share_tasks_and_read_little_beyond_themselves(spark, monkeypatch):
    folder = Path(scratch_path(spark, "ledger").removeprefix("file:"))
    folder.mkdir()
    path = folder / "one.json"
    path.write_text(json.dumps(ledger(random.Random(5), 2000)))
    size = path.stat().st_size
    got = read_large_ledger(spark, str(path), 1000)
    assert size > 100_000 and 1 < got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert rows(got) == rows(read_ledger(spark, str(path)))

    done = []

    class Counted:
        def open_input_file(self, name):
            stream = open(name, "rb")
            read = stream.read

            class File:
                __enter__, __exit__ = lambda self: self, lambda self, *_: stream.close()
                seek = stream.seek

                def read(self, n):
                    done.append(n)
                    return read(n)

            return File()

    monkeypatch.setattr(source, "open_path", lambda p: (Counted(), p))
    assert len(list(source._entries(str(path), 0, 1000, size, source.OUTSIDE, 0))) > 0
    assert sum(done) <= 1000 + 2 * source.BEYOND


def test_ledgers_that_are_none(spark):
    folder = Path(scratch_path(spark, "ledger").removeprefix("file:"))
    folder.mkdir()
    (folder / "good.json").write_text('  {"a": {"name": "n", "behavior_score": 1, "history": []} , "b": {"name": 5}}\n')
    (folder / "cut.json").write_text('{"c": {"name": "n"')
    (folder / "list.json").write_text('[{"d": 1}]')
    (folder / "text.json").write_text("nothing")
    (folder / "empty.json").write_text("")
    (folder / "none.json").write_text(" {} ")
    got = {r.user_id: r for r in read_large_ledger(spark, str(folder), 5).collect()}
    assert set(got) == {"a", "b"} and got["a"].behavior_score == 1
    assert read_large_ledger(spark, f"{folder}/missing").count() == 0
