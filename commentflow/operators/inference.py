"""Batched model inference over a text column.

A predictor factory is called once per task, so a model is loaded once and then fed Arrow batches.
Any callable ``Sequence[str] -> Sequence[int]`` is a predictor.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentflow.functions.labels import flag_target
from commentflow.functions.text import WORD, strip_space

# Predictors travel to the executors by value, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Predictor = Callable[[Sequence[str]], Sequence[int]]
PredictorFactory = Callable[[], Predictor]


@dataclass(frozen=True)
class ColumnPredictor:
    """A predictor that is an expression over the text column."""

    column: Callable[[Column], Column]


class LexiconPredictor:
    """Highest label among the listed words a text contains, 0 when it contains none."""

    def __init__(self, words: Mapping[str, int]):
        self.words = {w.lower(): label for w, label in words.items()}
        longest_first = sorted(map(re.escape, self.words), key=len, reverse=True)
        self.pattern = re.compile(rf"(?<!\w)(?:{'|'.join(longest_first)})(?!\w)") if longest_first else None

    def __call__(self, texts: Sequence[str]) -> list[int]:
        if self.pattern is None:
            return [0] * len(texts)
        return [max((self.words[w] for w in self.pattern.findall(t.lower())), default=0) for t in texts]


def lexicon_factory(words: Mapping[str, int]) -> PredictorFactory:
    words = dict(words)
    return lambda: LexiconPredictor(words)


def lexicon_column(words: Mapping[str, int]) -> ColumnPredictor:
    """The same predictor as a built-in expression: one word-bounded pattern for each label, the highest first."""
    by_label: dict[int, list[str]] = {}
    for word, label in words.items():
        by_label.setdefault(label, []).append(re.escape(word.lower()))

    def predict(text: Column) -> Column:
        lowered = F.lower(F.coalesce(text, F.lit("")))
        found = F.lit(0)
        for label in sorted(by_label):
            pattern = rf"(?<!{WORD})(?:{'|'.join(sorted(by_label[label], key=len, reverse=True))})(?!{WORD})"
            found = F.greatest(found, F.when(lowered.rlike(pattern), F.lit(label)).otherwise(F.lit(0)))
        return found

    return ColumnPredictor(predict)


def batch_predict(
    df: DataFrame, predictor_factory: PredictorFactory | ColumnPredictor, text_col: str = "text", batch_size: int = 64,
    out: str = "predicted_label",
) -> DataFrame:
    """Add a predicted label. Missing texts are predicted as empty ones.

    A column predictor becomes part of the plan. A factory is called in the tasks:

    The model runs exactly once per row, also when rows are then filtered by their label: the
    optimizer is kept from copying the call into the filter. For the same reason it will not move
    later filters below the model, so rows that need no label should be filtered out before.
    """

    if isinstance(predictor_factory, ColumnPredictor):
        return df.withColumn(out, predictor_factory.column(F.col(text_col)).cast("int"))

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = predictor_factory()
        for texts in batches:
            values = texts.fillna("").tolist()
            labels: list[int] = []
            for start in range(0, len(values), batch_size):
                labels.extend(predictor(values[start:start + batch_size]))
            yield pd.Series(labels, dtype="int32")

    predict.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    model = F.pandas_udf(predict, T.IntegerType()).asNondeterministic()
    return df.withColumn(out, model(F.col(text_col)))


def analyze_text(
    df: DataFrame, predictor_factory: PredictorFactory | ColumnPredictor, text_col: str = "text", batch_size: int = 64
) -> DataFrame:
    """Trim, ignore blank texts, predict and flag what moderation acts on."""
    trimmed = df.withColumn(text_col, strip_space(F.col(text_col))).filter(F.col(text_col) != "")
    predicted = batch_predict(trimmed, predictor_factory, text_col, batch_size)
    return predicted.withColumn("is_target", flag_target(F.col("predicted_label")))
