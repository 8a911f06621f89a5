"""Text scorers: native lexicons by default, any model through pandas UDFs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch import fixed_values as V
from tidewatch.functions.text import NO_TOKEN, let

Scorer = Callable[[Column], Column]
SCORES = T.MapType(T.StringType(), T.DoubleType())


def _listed(text: Column, words: Iterable[str]) -> Column:
    """The tokens of a text that are on any list: a short array."""
    return F.filter(F.split(F.lower(text), NO_TOKEN), lambda t: t.isin(*words))


def _hits(tokens: Column, words: Sequence[str]) -> Column:
    return F.size(F.filter(tokens, lambda t: t.isin(*words)))


def lexicon_sentiment(
    positive: Sequence[str] = V.POSITIVE_WORDS, negative: Sequence[str] = V.NEGATIVE_WORDS
) -> Scorer:
    """1.0 when positive words outnumber negative ones, else 0.0."""

    def score(text: Column) -> Column:
        listed = _listed(text, [*positive, *negative])
        better = let(listed, lambda t: _hits(t, positive) > _hits(t, negative))
        return F.when(better, F.lit(1.0)).when(text.isNotNull(), F.lit(0.0))

    return score


def lexicon_toxicity(lexicon: Mapping[str, Sequence[str]] = V.TOXICITY_LEXICON) -> Scorer:
    """Score per category: 0.95 for one listed word, 1.0 for more; overall = maximum."""

    def by_category(listed: Column) -> Column:
        parts = {c: F.least(F.lit(1.0), _hits(listed, w) * F.lit(0.95)) for c, w in lexicon.items()}
        overall = F.array_max(F.array(*parts.values()))
        entries = [F.lit("toxicity"), overall]
        for category, value in parts.items():
            entries += [F.lit(category), value]
        return F.create_map(*entries)

    def score(text: Column) -> Column:
        listed = _listed(text, [w for words in lexicon.values() for w in words])
        return F.when(text.isNotNull(), let(listed, by_category))

    return score


_models: dict[str, object] = {}


def loaded(name: str, load: Callable[[], object]):
    """What ``load()`` returns, loaded once in each Python worker (workers outlive their tasks).

    Must be a function of this module: what a task carries along is fresh in
    every task, what the worker imported stays.
    """
    if name not in _models:
        _models[name] = load()
    return _models[name]


def model_sentiment(load: Callable[[], Callable[[list[str]], list[float]]]) -> Scorer:
    """Scores from a model: ``load()`` runs once per Python worker, then the model per Arrow batch.

    Null texts are not shown to the model, so a caller limits the work by
    passing null for the rows that need no score.
    """

    name = uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = loaded(name, load)
        for batch in batches:
            out = pd.Series([None] * len(batch), index=batch.index, dtype="float64")
            asked = batch.dropna()
            if len(asked):
                out[asked.index] = predict(asked.tolist())
            yield out

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, T.DoubleType())


@dataclass(frozen=True)
class WordListModel:
    """A model in Python for ``model_sentiment``: 1.0 when positive words outnumber negative ones.

    The instance itself is the ``load`` of the scorer.
    """

    positive: tuple[str, ...]
    negative: tuple[str, ...]

    def __call__(self) -> Callable[[list[str]], list[float]]:
        good, bad = set(self.positive), set(self.negative)

        def predict(texts: list[str]) -> list[float]:
            said = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
            return [float(sum(w in good for w in s) > sum(w in bad for w in s)) for s in said]

        return predict


def model_toxicity(load: Callable[[], Callable[[list[str]], list[dict[str, float]]]]) -> Scorer:
    """Category scores from a model, as a map; same contract as ``model_sentiment``."""

    name = uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = loaded(name, load)
        for batch in batches:
            asked = batch.dropna()
            scores = dict(zip(asked.index, predict(asked.tolist()))) if len(asked) else {}
            yield pd.Series([scores.get(i) for i in batch.index], index=batch.index, dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, SCORES)


def no_model(text: Column) -> Column:
    """The scorer when no model is there: an empty map, so nothing is flagged."""
    return F.when(text.isNotNull(), F.create_map().cast(SCORES))
