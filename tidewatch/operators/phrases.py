"""Large lists of words and phrases, given as tables.

Whole words are a semi join. Phrases anywhere in a text are found by an
automaton over the list: one step per character, however many phrases there are.
A list that is too large for one automaton is cut into shards of bounded size,
each of which goes over the texts once.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import pin

#: Bytes of phrases in an automaton; a node takes some 50 bytes of a Python worker.
SHARD_BYTES = 4 << 20
_automata: dict[str, object] = {}


def with_listed_words(texts: DataFrame, key: str, tokens: Column, words: DataFrame) -> DataFrame:
    """(key, word) for each token of a text that ``words(word)`` lists, once per key."""
    said = texts.select(key, F.explode(F.array_distinct(tokens)).alias("word"))
    return said.join(words.select("word").distinct(), "word", "left_semi").select(key, "word").distinct()


def _automaton(shared):
    """The automaton of a broadcast list, built once per worker."""
    import ahocorasick

    if shared.id not in _automata:
        _automata.clear()
        built = ahocorasick.Automaton()
        for phrase in shared.value:
            built.add_word(phrase, phrase)
        built.make_automaton()
        _automata[shared.id] = built
    return _automata[shared.id]


class _Shared:
    """A broadcast list with a name that workers can remember it by."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def _found(shared: _Shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared)
        for batch in batches:
            rows, phrases = [], []
            for i, text in enumerate(batch.column(1)):
                hits = {phrase for _, phrase in automaton.iter(text.as_py())}
                rows += [i] * len(hits)
                phrases += hits
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(phrases, pa.string())], names=["key", "phrase"]
            )

    return run


def find_phrases(texts: DataFrame, key: str, text: str, phrases: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(key, phrase) for each phrase of ``phrases(phrase)`` that a text contains, once per row of ``texts``.

    Compared as they are: bring both sides to one form first. Null and empty
    phrases are none, null texts contain nothing, repeated phrases count once.
    """
    spark = texts.sparkSession
    listed = phrases.select("phrase").filter("phrase <> ''").distinct()
    total = listed.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_bytes))
    listed = pin(listed.withColumn("shard", F.pmod(F.xxhash64("phrase"), F.lit(shards)).cast("int"))) if shards > 1 else listed
    kind = dict(texts.dtypes)[key]
    said = texts.select(key, text).filter(F.col(text).isNotNull())
    out = None
    for shard in range(shards):
        part = listed if shards == 1 else listed.filter(F.col("shard") == shard).select("phrase")
        words = [r.phrase for r in part.collect()]  # bounded by the size of a shard
        if words:
            broadcast = spark.sparkContext.broadcast(words)
            found = said.mapInArrow(_found(_Shared(broadcast)), f"key {kind}, phrase string")
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"{key} {kind}, phrase string")
    return out.withColumnRenamed("key", key)
