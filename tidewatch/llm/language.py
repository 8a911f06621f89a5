"""Language labels of words: scripts narrow the choice, Viterbi decides.

Every word is scored under each language by its character n-grams (hashed, with
the ends of the word) as a naive Bayes model of the labelled texts. The script
of a word rules out languages that do not use it. Viterbi over the words of a
document, with a penalty for each change of language, labels spans; the
language with most letters names the document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import (
    LOWER,
    fresh,
    held_out,
    learning_row,
    list_array,
    mix,
    row_blocks,
    row_counts,
    span_hashes,
    table,
    text_bytes,
    word_spans,
)

#: Labelled texts of each language that are learned from (about as many, by a hash).
TEXTS_PER_LANGUAGE = 5_000
ORDERS = (2, 3, 4)
BUCKETS = 1 << 14
SMOOTHING = 0.5
#: Cost of a change of language between two words, in nats.
SWITCH = 6.0
#: A language uses a script if this part of its letters is in it.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"
#: Word bytes whose scores are held at once; documents of one Viterbi pass.
SCORED_BYTES, PASS_BYTES = 1 << 20, 8 << 20

_byte = np.arange(256)
IS_LETTER = ((LOWER >= 97) & (LOWER <= 122)) | (_byte >= 128)
#: Script of a letter by the first byte of its character: ranges of the code space.
SCRIPT = np.zeros(256, np.int8)
SCRIPT[97:123] = 1  # Latin
SCRIPT[0xC3:0xCA] = 1
SCRIPT[0xCD:0xD0] = 2  # Greek
SCRIPT[0xD0:0xD4] = 3  # Cyrillic
SCRIPT[0xD5:0xDC] = 4  # Armenian, Hebrew, Arabic
SCRIPT[0xE0:0xE2] = 5  # scripts of South and South-East Asia
SCRIPT[0xE3:0xEA] = 6  # kana and Han
SCRIPT[0xEA:0xEE] = 7  # Hangul
SCRIPT[0xF0] = 8
SCRIPTS = 9


def unique_words(data: np.ndarray, offsets: np.ndarray):
    """Spans of the different words of a block, and word number and row of each word."""
    low = LOWER[data]
    starts, ends, row = word_spans(low, offsets, IS_LETTER)
    hashes = span_hashes(low, starts, ends)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    return low, starts[first], ends[first], number, row, ends - starts


def framed(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words with a space on each side, one after the other, and the owner of each byte."""
    sizes = ends - starts + 2
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(int(sizes.sum())) - begin[owner]
    source = np.clip(starts[owner] + within - 1, 0, max(len(low) - 1, 0))
    edge = (within == 0) | (within == sizes[owner] - 1)
    return np.where(edge, 32, low[source]).astype(np.uint64), owner


def gram_buckets(text: np.ndarray, owner: np.ndarray, order: int):
    """Bucket and owner of each run of ``order`` bytes inside one framed word."""
    n = len(text) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    for j in range(order):
        code = code * np.uint64(257) + text[j : j + n]
    keep = owner[:n] == owner[order - 1 :]
    h = mix(code[keep] + np.uint64(order << 40))
    return (h % np.uint64(BUCKETS)).astype(np.int64), owner[:n][keep]


def word_scripts(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The script of each word (the highest one, if it mixes several; 0 if unknown)."""
    if not len(starts):
        return np.zeros(0, np.int8)
    # Spans are bounded at both ends, so the even positions of reduceat are the words.
    table_ = np.append(SCRIPT[low], 0)
    order = np.argsort(starts)
    cuts = np.stack([starts[order], ends[order]], axis=1).ravel()
    out = np.empty(len(starts), np.int8)
    out[order] = np.maximum.reduceat(table_, cuts)[::2]
    return out


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, feature, count): n-gram buckets per order, then scripts."""
    total: dict[str, np.ndarray] = {}
    width = len(ORDERS) * BUCKETS + SCRIPTS
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        names = np.array(batch.column("lang").to_pylist(), object)
        langs, lang_of = np.unique(names.astype(str), return_inverse=True)
        for a, b in row_blocks(offsets, SCORED_BYTES):
            low, starts, ends, number, row, _ = unique_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            if not len(number):
                continue
            text, owner = framed(low, starts, ends)
            script = word_scripts(low, starts, ends)
            word_lang = lang_of[a:b][row]
            for k, lang in enumerate(langs):
                times = np.bincount(number[word_lang == k], minlength=len(starts)).astype(float)
                if not times.any():
                    continue
                sums = total.setdefault(lang, np.zeros(width))
                for o, order in enumerate(ORDERS):
                    bucket, whose = gram_buckets(text, owner, order)
                    sums[o * BUCKETS : (o + 1) * BUCKETS] += np.bincount(bucket, times[whose], minlength=BUCKETS)
                sums[-SCRIPTS:] += np.bincount(script, times, minlength=SCRIPTS)
    for lang, sums in total.items():
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(sums[at])], ["lang", "feature", "n"]
        )


class Model:
    """Log-probabilities of n-gram buckets and the scripts of each language."""

    def __init__(self, rows: list[tuple[str, int, float]]):
        self.langs = sorted({r[0] for r in rows})
        place = {lang: k for k, lang in enumerate(self.langs)}
        counts = np.zeros((len(self.langs), len(ORDERS) * BUCKETS + SCRIPTS))
        for lang, feature, n in rows:
            counts[place[lang], feature] = n
        grams = counts[:, :-SCRIPTS].reshape(len(self.langs), len(ORDERS), BUCKETS) + SMOOTHING
        logs = np.log(grams / grams.sum(axis=2, keepdims=True))
        # Overlapping n-grams tell much the same: their mean over the orders counts.
        self.logs = np.ascontiguousarray((logs / len(ORDERS)).transpose(1, 2, 0)).astype(np.float32)
        scripts = counts[:, -SCRIPTS:]
        share = scripts / np.maximum(scripts[:, 1:].sum(axis=1, keepdims=True), 1)
        self.uses = (share >= SCRIPT_SHARE).T.copy()
        self.uses[0] = True
        self.uses[~self.uses.any(axis=1)] = True

    def scores(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Score of each word under each language."""
        out = np.zeros((len(starts), len(self.langs)), np.float32)
        sizes = np.cumsum(ends - starts + 2)
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + SCORED_BYTES, "right")))
            text, owner = framed(low, starts[a:b], ends[a:b])
            for o, order in enumerate(ORDERS):
                bucket, whose = gram_buckets(text, owner, order)
                for k in range(len(self.langs)):
                    out[a:b, k] += np.bincount(whose, self.logs[o, bucket, k], minlength=b - a)
            a = b
        out[~self.uses[word_scripts(low, starts, ends)]] -= 1e4
        return out


def scored_words(model: Model, data: np.ndarray, offsets: np.ndarray):
    """Scores of different words, the word at each place, places per row and their letters.

    Words are told apart and scored in small blocks of rows, so that memory
    does not follow the size of a Viterbi pass.
    """
    scores, number, sizes = [], [], []
    counts = np.zeros(len(offsets) - 1, np.int64)
    seen = 0
    for a, b in row_blocks(offsets, SCORED_BYTES):
        low, starts, ends, words, row, lengths = unique_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        scores.append(model.scores(low, starts, ends))
        number.append((words + seen).astype(np.int32))
        sizes.append(lengths.astype(np.int32))
        counts[a:b] = np.bincount(row, minlength=b - a)
        seen += len(starts)
    if not scores:
        none = np.zeros(0, np.int32)
        return np.zeros((0, len(model.langs)), np.float32), none, counts, none
    return np.concatenate(scores), np.concatenate(number), counts, np.concatenate(sizes)


def viterbi(scores: np.ndarray, number: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word; all documents step forward together, longest first.

    ``scores`` are those of the different words, ``number`` names the word at
    each place, ``counts`` the places of each document.
    """
    states = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    # How many documents are longer than t words.
    active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0]) if len(sizes) else 0), "right")
    moved = np.zeros((len(number), states), bool)
    best = np.zeros(len(number), np.int16)
    value = np.zeros((len(sizes), states), np.float32)
    final = np.zeros(len(sizes), np.int64)
    for t, n in enumerate(active.tolist()):
        at = first[:n] + t
        v = value[:n]
        if t:
            top = v.argmax(axis=1)
            jump = v[np.arange(n), top] - switch
            moved[at] = v < jump[:, None]
            best[at] = top
            np.maximum(v, jump[:, None], out=v)
            v -= v.max(axis=1, keepdims=True)
        v += scores[number[at]]
    if len(sizes):
        final = value.argmax(axis=1)
    labels = np.zeros(len(number), np.int16)
    state = final
    for t in range(len(active) - 1, -1, -1):
        n = int(active[t])
        at = first[:n] + t
        s = state[:n]
        labels[at] = s
        if t:
            state[:n] = np.where(moved[at, s], best[at], s)
    return labels


def _label(shared, text: str, names: list[str], switch: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        langs = np.array([*model.langs, UNKNOWN], object)
        for batch in batches:
            n = batch.num_rows
            data, offsets = text_bytes(batch.column(text))
            pred, score = np.full(n, len(model.langs)), np.zeros(n)
            runs = np.zeros(n, np.int64)
            parts = []
            for a, b in row_blocks(offsets, PASS_BYTES):
                if not model.langs:
                    continue
                scores, number, counts, sizes = scored_words(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                row = np.repeat(np.arange(b - a), counts)
                labels = viterbi(scores, number, counts, switch).astype(np.int64)
                if not len(labels):
                    continue
                letters = np.bincount(
                    row * len(model.langs) + labels, sizes, minlength=(b - a) * len(model.langs)
                ).reshape(b - a, -1)
                some = counts > 0
                pred[a:b][some] = letters[some].argmax(axis=1)
                score[a:b][some] = letters[some].max(axis=1) / letters[some].sum(axis=1)
                new = np.ones(len(labels), bool)
                new[1:] = (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])
                at = np.flatnonzero(new)
                runs[a:b] = np.bincount(row[at], minlength=b - a)
                place = at - (np.cumsum(counts) - counts)[row[at]]
                parts.append((langs[labels[at]], place, np.diff(np.append(at, len(labels)))))
            # Signs beyond ASCII that are no letters (dashes, pictures) make no language.
            plain = row_counts(IS_LETTER & (_byte < 128), data, offsets)
            odd = (plain == 0) & (row_counts(IS_LETTER, data, offsets) > 0)
            for i in np.flatnonzero(odd):
                if not any(c.isalpha() for c in batch.column(text)[i].as_py()):
                    pred[i], score[i] = len(model.langs), 0.0
            flat = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, object if k == 0 else np.int64) for k in range(3)]
            spans = pa.StructArray.from_arrays(
                [pa.array(flat[1].astype(np.int64)), pa.array(flat[2].astype(np.int64)), pa.array(flat[0].tolist(), pa.string())],
                ["start_word", "words", "lang"],
            )
            columns = [batch.column(i) for i in range(batch.num_columns)]
            out = [pa.array(langs[pred].tolist(), pa.string()), pa.array(score), list_array(spans, runs)]
            yield pa.RecordBatch.from_arrays([*columns, *out], [*batch.schema.names, *names])

    return run


def fit(docs: DataFrame, per_language: int = TEXTS_PER_LANGUAGE) -> Model:
    """The model of a sample of the labelled texts, about ``per_language`` of each.

    Rows that are held out, without a language, a text or an id are left out.
    """
    known = docs.filter(learning_row(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model([])
    steps = 1 << 20
    parts = [(lang, math.ceil(min(1.0, per_language / n) * steps)) for lang, n in sizes.items()]
    limits = F.broadcast(docs.sparkSession.createDataFrame(parts, "lang string, part long"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(steps))
    taken = known.join(limits, "lang").filter(draw < F.col("part")).select("lang", "text")
    counts = taken.mapInArrow(_learn, "lang string, feature long, n double")
    rows = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).collect()
    return Model([tuple(r) for r in rows])


def language_spans(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH):
    """Rows of ``docs`` with language, score and spans, and the names of these columns.

    The score is the part of the letters that lies in spans of the language.
    ``spans`` are (start_word, words, lang), words being runs of letters. Null,
    empty and letterless texts are ``und`` with score 0; so is all without a
    labelled text to learn from.
    """
    names = fresh(docs.columns, "lang_pred", "score", "spans")
    span = T.ArrayType(
        T.StructType(
            [T.StructField("start_word", T.LongType()), T.StructField("words", T.LongType()), T.StructField("lang", T.StringType())]
        )
    )
    fields = [T.StructField(c, k) for c, k in zip(names, (T.StringType(), T.DoubleType(), span))]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_label(shared, text, names, switch), T.StructType([*docs.schema.fields, *fields])), names


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled, (lang, score, spans) = language_spans(docs.select("doc_id", "text"), fit(docs))
    return labelled.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col(lang).alias("lang_pred"),
        F.col(score).alias("score"),
        F.size(spans).cast("long").alias("n_spans"),
    )
