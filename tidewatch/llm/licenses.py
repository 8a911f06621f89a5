"""License scan with a positional index of rare licence words.

The document frequencies of all licence words are counted over the whole corpus.
Every template is entered in the index under its rarest words, with their
positions. A file's words that are keys of the index (its licence words of
highest IDF) are looked up; each posting gives the place where its template
would begin, and postings that agree on the place are one candidate. The
template's mandatory phrases are then compared word by word.

Everything on a row is a native expression over its word array: nothing moves
but the document frequencies, one row per licence word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import table, word_array


@dataclass(frozen=True)
class Template:
    """``words``: the text; ``phrases``: (position, words) that must stand there."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> tuple[str, ...]:
        return tuple(self.text.split())

    def places(self) -> list[tuple[int, tuple[str, ...]]]:
        out = []
        for phrase in self.phrases or (self.text,):
            words = tuple(phrase.split())
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(words)] == words)
            out.append((at, words))
        return out


# Notices as their licences state them, lower-cased, words only.
BASE = (
    Template("mit", "under the mit license", base=True),
    Template("apache-2", "apache license version 2", base=True),
    Template("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license",
        ("licensed under the apache license", "except in compliance with the license"),
    ),
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl-3", "gnu affero general public license"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template("mpl-2", "mozilla public license version 2"),
    Template("mpl-2", "mozilla public license v 2 0"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("cc0", "cc0 1 0 universal"),
    Template("cc-by", "cc by 4 0"),
    Template("cc-by-sa", "cc by sa 4 0"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by", "creative commons attribution 4 0"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
)
TEMPLATES = BASE + NOTICES
#: Index keys of a notice; a base phrase has one, which every place of it holds.
KEYS = 3
#: Words that a phrase of a notice may be moved by, as copies add or lose some.
DRIFT = 3
#: A place is template * START + start + BEFORE, one number.
START, BEFORE = 1 << 36, 1 << 20


def document_frequencies(words: DataFrame, vocabulary: tuple[str, ...]) -> tuple[dict[str, int], int]:
    """In how many rows each licence word occurs, and how many rows there are."""
    known = F.array_intersect("w", F.array(*[F.lit(v) for v in vocabulary]))
    counts = words.select(F.explode(F.array_append(known, F.lit(""))).alias("v")).groupBy("v").count()
    found = {r.v: r["count"] for r in counts.collect()}  # one row per licence word
    return {v: found.get(v, 0) for v in vocabulary}, found.get("", 0)


def build_index(df: dict[str, int], rows: int, templates=TEMPLATES, keys: int = KEYS):
    """{word: [(template, position)]}, keys per template, and the IDF of each word."""
    idf = {w: math.log((rows + 1) / (n + 1)) for w, n in df.items()}
    index: dict[str, list[tuple[int, int]]] = {}
    used = []
    for k, t in enumerate(templates):
        order = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], i))[: 1 if t.base else keys]
        used.append(len(order))
        for i in order:
            index.setdefault(t.words[i], []).append((k, i))
    return index, used, idf


def _literal_words(words: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _shifted(phrase_at, words: tuple[str, ...], at: Column):
    return lambda drift: phrase_at(words, at + drift)


def license_places(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """``docs`` reduced to its ids, with ``n_words`` and ``places``.

    ``places`` lists every verified match as (template, start, score), in the
    order of the text; start counts words from 0. Null and empty texts have no
    words; repeated rows each have their own result; an empty table gives none.
    """
    vocabulary = tuple(sorted({w for t in templates for w in t.words}))
    words = docs.select("doc_id", word_array(F.col(text)).alias("w"))
    df, rows = document_frequencies(words, vocabulary)
    index, used, _ = build_index(df, rows, templates)
    keys, keys_ = sorted(index), max([1, *used])
    # Where the file's words are keys of the index.
    looked_up = F.filter(
        F.transform("w", lambda w, i: F.when(w.isin(keys), F.struct(i.alias("i"), w.alias("w")))),
        lambda x: x.isNotNull(),
    )
    posting = F.create_map(
        *[
            x
            for w in keys
            for x in (
                F.lit(w),
                F.array(*[F.struct(F.lit(k).alias("t"), F.lit(p).alias("p")) for k, p in index[w]]),
            )
        ]
    )
    # Template and start of each posting as one number, sorted, so that what agrees stands side by side; a template
    # may begin before the text if its head is missing.
    begins = F.sort_array(
        F.flatten(
            F.transform(
                "found",
                lambda f: F.transform(
                    F.element_at(posting, f.w),
                    lambda p: p.t.cast("long") * START + (f.i - p.p + BEFORE).cast("long"),
                ),
            )
        )
    )

    def agreed(x: Column, i: Column) -> Column:
        """Keys of the template at this start, give or take the drift; no more of them than a template has count."""
        near = [F.coalesce((F.abs(F.get("begins", i + d) - x) <= DRIFT).cast("int"), F.lit(0)) for d in range(-keys_, keys_ + 1)]
        return reduce(lambda a, b: a + b, near)

    def phrase_at(words: tuple[str, ...], at: Column) -> Column:
        inside = (at >= 0) & (at + len(words) <= F.size("w"))
        return F.coalesce(F.when(inside, F.slice("w", at + 1, len(words)) == _literal_words(words)), F.lit(False))

    drifts = F.array(*[F.lit(d) for d in sorted(range(-DRIFT, DRIFT + 1), key=abs)])

    def verified(x: Column, i: Column, start: Column) -> Column:
        cases, template = F.lit(0.0), F.floor(x / START)
        for k, t in enumerate(templates):
            if t.base:
                ok = F.when(phrase_at(t.words, start), 1.0).otherwise(0.0)
            else:
                need = min(2, used[k])
                there = F.lit(True)
                for at, words in t.places():
                    there = there & F.exists(drifts, _shifted(phrase_at, words, start + at))
                ok = F.when((agreed(x, i) >= need) & there, agreed(x, i) / F.lit(float(used[k]))).otherwise(0.0)
                ok = F.least(ok, F.lit(1.0))
            cases = F.when(template == k, ok).otherwise(cases)
        return cases

    def place(x: Column, i: Column) -> Column:
        start = (x % START - BEFORE).cast("int")
        # Equal numbers are one place: the first of them.
        new = F.coalesce(F.get("begins", i - 1) != x, F.lit(True))
        found = F.struct(start.alias("start"), F.floor(x / START).cast("int").alias("template"), verified(x, i, start).alias("score"))
        return F.when(new, found)

    places = F.array_sort(F.filter(F.transform("begins", place), lambda p: p.isNotNull() & (p.score > 0)))
    return (
        words.select("doc_id", "w", looked_up.alias("found"))
        .select("doc_id", "w", begins.alias("begins"))
        .select(
            "doc_id",
            F.size("w").cast("long").alias("n_words"),
            F.when(F.size("begins") > 0, places).otherwise(F.lit(None)).alias("places"),
        )
    )


def license_labels(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """Per document: base places and labels, all labels, and the best score."""
    none = F.array().cast("array<struct<start:int,template:int,score:double>>")
    places = F.coalesce(F.col("places"), none)
    base_ids = [k for k, t in enumerate(templates) if t.base]
    names = F.array(*[F.lit(t.label) for t in templates])
    base = F.filter(places, lambda p: p.template.isin(base_ids))
    starts = F.transform(base, lambda p: p.start.cast("long"))

    def joined(x: Column) -> Column:
        labels = F.transform(x, lambda p: F.get(names, p.template))
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return license_places(docs, templates=templates).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(places).alias("labels"),
        F.coalesce(F.array_max(F.transform(places, lambda p: p.score)), F.lit(0.0)).alias("score"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _starts(words: tuple[str, ...]) -> str:
    """SQL: where these words stand one after the other, from 0."""
    n = len(words)
    found = f"list_filter(range(0, len(w) - {n - 1}), lambda i: w[i + 1 : i + {n}] = {_list(words)})"
    return f"CASE WHEN list_has_all(w, {_list(words)}) THEN {found} ELSE [] END"


def _oracle() -> str:
    """The same results from whole phrases, which need no index, and keys for notices of several phrases."""
    base = [t for t in TEMPLATES if t.base]
    single = [t for t in TEMPLATES if not t.base and not t.phrases]
    several = [(k, t) for k, t in enumerate(TEMPLATES) if t.phrases]
    columns = [f"{_starts(t.words)} AS b{k}" for k, t in enumerate(base)]
    columns += [f"len({_starts(t.words)}) > 0 AS s{k}" for k, t in enumerate(single)]
    rows = [f"({k}, {i}, '{w}')" for k, t in several for i, w in enumerate(t.words)]
    checks = []
    for k, t in several:
        near = [
            f"len(list_filter(range(s + {at - DRIFT}, s + {at + DRIFT + 1}), lambda i: i >= 0"
            f" AND w[i + 1 : i + {len(words)}] = {_list(words)})) > 0"
            for at, words in t.places()
        ]
        checks.append(f"(t = {k} AND {' AND '.join(near)})")
    names = " ".join(f"WHEN {k} THEN '{t.label}'" for k, t in several)
    every = "list_concat(" + ", ".join(f"b{k}" for k in range(len(base))) + ")"
    base_labels = ", ".join(f"CASE WHEN len(b{k}) > 0 THEN '{t.label}' END" for k, t in enumerate(base))
    labels = ", ".join(f"CASE WHEN s{k} THEN '{t.label}' END" for k, t in enumerate(single))
    joined = "array_to_string(list_sort(list_distinct(list_filter({}, lambda x: x IS NOT NULL))), ',')".format
    return rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, w, {', '.join(columns)} FROM d),
template(t, pos, word) AS (VALUES {', '.join(rows)}),
seen AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM seen WHERE word IN (SELECT word FROM template) GROUP BY word),
keys AS (SELECT t, pos, word FROM template LEFT JOIN df USING (word)
  QUALIFY row_number() OVER (PARTITION BY t ORDER BY coalesce(n, 0), pos) <= {KEYS}),
posting AS (SELECT doc_id, t, i - pos AS s FROM seen JOIN keys USING (word)),
agreed AS (SELECT a.doc_id, a.t, a.s, count(*) AS n FROM (SELECT DISTINCT * FROM posting) a JOIN posting b
  ON a.doc_id = b.doc_id AND a.t = b.t AND abs(a.s - b.s) <= {DRIFT} GROUP BY 1, 2, 3 HAVING count(*) >= 2),
more AS (SELECT doc_id, list(DISTINCT CASE t {names} END) AS found, max(least(n / {float(KEYS)}, 1.0)) AS best
  FROM agreed JOIN d USING (doc_id) WHERE {' OR '.join(checks)} GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len({every})::BIGINT AS n_base,
  list_min({every})::BIGINT AS first_word, list_max({every})::BIGINT AS last_word,
  {joined(f'[{base_labels}]')} AS base_labels,
  {joined(f"list_concat([{base_labels}, {labels}], coalesce(found, []))")} AS labels,
  CASE WHEN len({every}) > 0 OR {' OR '.join(f's{k}' for k in range(len(single)))} THEN 1.0::DOUBLE
    ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM p LEFT JOIN more USING (doc_id)
"""


ORACLE = _oracle()
