"""Toxicity by classifier chains.

Categories are predicted in order: low quality, toxic, severe (toxic text of low quality). Each is a logistic
model over words, word beginnings and a few shares of the text; later models also see the probabilities of the
earlier categories. While training, these are predictions from folds that did not hold the document, so later
models learn to use them as they will be at scoring time.

The chain is fitted on a bounded sample of labelled documents: at most ``SAMPLE`` of them, chosen by a hash of
their ids. Their features are counted and made by Spark tasks; the small matrix of the sample is solved on the
driver. All documents are then scored, whole, in Arrow batches, without a shuffle.

Edge cases: a null or empty text has no words and gets the probabilities of the intercepts; labels with nulls are
left out, of repeated labels one counts; without labels, or where all agree, every document gets the share seen
(no toxic ones: 0). Repeated rows give repeated results; extra columns are ignored or, in ``drop_toxic``, passed
through whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentflow.llm.tables import fresh

CATEGORIES = ("low_quality", "toxic", "severe")
#: Most labelled documents used for fitting.
SAMPLE = 6000
FOLDS = 3
#: Features chosen for each category, and the fewest sample documents that hold one.
CHOSEN = {"low_quality": 40, "toxic": 200, "severe": 20}
MIN_DOCS = 5
BEGINNINGS = (4, 5, 6, 7)
RIDGE = 0.01
THRESHOLD = 0.5
SHARES = 4

_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 100_000


def word_features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)]


def counted(text: str) -> tuple[Counter, int]:
    words = _WORD.findall(text.lower())
    return Counter(words), len(words)


def shares(text: str, words: Counter, n: int) -> list[float]:
    """Symbols, letters and distinct words in proportion, and the mean word length."""
    size = max(1, len(text))
    letters = sum(len(w) * k for w, k in words.items())
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return [min(1.0, 5.0 * symbols / size), letters / size, len(words) / max(1, n), min(2.0, letters / max(1, n) / 10.0)]


@dataclass
class Chain:
    """Feature numbers and one weight vector for each category: features, shares, intercept, earlier probabilities."""

    vocabulary: dict[str, int]
    weights: list[np.ndarray] = field(default_factory=list)
    _known: dict = field(default_factory=dict, repr=False)

    def row(self, text: str | None) -> np.ndarray:
        text = text or ""
        words, n = counted(text)
        size = len(self.vocabulary)
        x = np.zeros(size + SHARES + 1, dtype=np.float64)
        known = self._known
        for word, k in words.items():
            at = known.get(word)
            if at is None:
                at = tuple(self.vocabulary[f] for f in word_features(word) if f in self.vocabulary)
                if len(known) >= _CACHE:
                    known.clear()
                known[word] = at
            for j in at:
                x[j] += k
        np.sqrt(x[:size] / max(1, n), out=x[:size])
        x[size:size + SHARES] = shares(text, words, n)
        x[-1] = 1.0
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of all categories, one row for each row of x."""
        out = np.zeros((len(x), 0))
        for w in self.weights:
            out = np.hstack([out, _probability(np.hstack([x, out]), w)[:, None]])
        return out


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = RIDGE * np.eye(x.shape[1])
    for _ in range(steps):
        p = _probability(x, w)
        slope = x.T @ (p - y) + RIDGE * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, slope)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit_chain(x: np.ndarray, y: np.ndarray, folds: np.ndarray, vocabulary: dict[str, int]) -> Chain:
    """Fit one model after another; earlier categories enter as out-of-fold probabilities."""
    chain, earlier = Chain(vocabulary), np.zeros((len(x), 0))
    for c in range(y.shape[1]):
        z, target = np.hstack([x, earlier]), y[:, c]
        if not len(x) or target.min() == target.max():
            w = np.zeros(z.shape[1])
            w[x.shape[1] - 1] = 30.0 if len(x) and target[0] else -30.0
            chain.weights.append(w)
            unseen = np.full(len(x), float(target[0]) if len(x) else 0.0)
        else:
            chain.weights.append(_fit(z, target))
            unseen = np.zeros(len(x))
            if c + 1 < y.shape[1]:
                for k in range(FOLDS):
                    held = folds == k
                    if held.any() and not held.all():
                        unseen[held] = _probability(z[held], _fit(z[~held], target[~held]))
        earlier = np.hstack([earlier, unseen[:, None]])
    return chain


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Rows (fold, low_quality, toxic, severe, text) of at most ``most`` labelled documents."""
    clean = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chosen = clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(
        F.col("doc_id").alias("_id"), F.pmod(F.hash("doc_id"), F.lit(FOLDS)).alias("fold"),
        (1 - F.col("quality")).cast("int").alias("low_quality"), F.col("toxic").cast("int").alias("toxic"),
        (F.col("toxic") * (1 - F.col("quality"))).cast("int").alias("severe"))
    # At most ``most`` rows of a few numbers each.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("fold", *CATEGORIES, "text")


def _choose(sample: DataFrame) -> list[str]:
    """The features that tell each category best by the chi-square of presence, most frequent in the category."""

    def run(batches):
        for batch in batches:
            tallies: dict[str, list[int]] = {}
            columns = [batch.column(k).to_pylist() for k in range(1, 4)]
            for text, *marks in zip(batch.column(4).to_pylist(), *columns):
                words, _ = counted(text or "")
                for f in {f for w in words for f in word_features(w)}:
                    row = tallies.setdefault(f, [0, 0, 0, 0])
                    row[0] += 1
                    for c, mark in enumerate(marks, 1):
                        row[c] += mark
            rows = list(tallies.values()) or [[0, 0, 0, 0]]
            names = list(tallies) or [""]
            yield pa.record_batch([pa.array(names, pa.string()), *(pa.array(v, pa.int64()) for v in zip(*rows))],
                                  names=["f", "n", "n0", "n1", "n2"])

    total = sample.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in CATEGORIES)).first()
    if not total["n"]:
        return []
    tallied = sample.mapInArrow(run, "f string, n bigint, n0 bigint, n1 bigint, n2 bigint")
    per = tallied.groupBy("f").agg(*(F.sum(c).alias(c) for c in ("n", "n0", "n1", "n2"))).where(F.col("n") >= MIN_DOCS)
    chosen: list[str] = []
    n = float(total["n"])
    ranked = []
    for c, name in enumerate(CATEGORIES):
        inside = float(total[name])
        if not 0 < inside < n:
            continue
        a, b = F.col(f"n{c}").cast("double"), (F.col("n") - F.col(f"n{c}")).cast("double")
        score = F.when(a * (n - inside) > b * inside, n * F.pow(a * (n - inside) - b * inside, 2) / (
            inside * (n - inside) * F.col("n") * F.greatest(n - F.col("n"), F.lit(1.0))))
        ranked.append(per.select("f", score.alias("s")).where("s is not null").orderBy(F.desc("s"), "f").limit(CHOSEN[name]))
    for part in ranked:
        chosen += [r["f"] for r in part.collect()]  # as many rows as CHOSEN says
    return list(dict.fromkeys(chosen))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Chain:
    """The chain fitted on at most ``most`` labelled documents."""
    sample = _sample(docs, labels, most)
    vocabulary = {f: k for k, f in enumerate(_choose(sample))}
    maker = Chain(vocabulary)

    def run(batches):
        for batch in batches:
            x = [maker.row(t).astype(np.float32).tobytes() for t in batch.column(4).to_pylist()]
            yield pa.record_batch([*(batch.column(k) for k in range(4)), pa.array(x, pa.binary())], names=["fold", *CATEGORIES, "x"])

    # At most ``most`` rows of one number for each chosen feature.
    made = sample.mapInArrow(run, "fold int, low_quality int, toxic int, severe int, x binary").toPandas()
    width = len(vocabulary) + SHARES + 1
    made = made.sort_values(["fold", "x"], kind="stable")  # the same order on every run
    x = np.frombuffer(b"".join(made["x"]), dtype=np.float32).reshape(-1, width).astype(np.float64)
    y = made[list(CATEGORIES)].to_numpy(dtype=np.float64)
    return fit_chain(x, y, made["fold"].to_numpy(), vocabulary)


def toxicity(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the probabilities of all categories and the verdict of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(0, max(1, batch.num_rows), 1024):
                part = batch.slice(k, 1024)
                p = chain.predict(_matrix(chain, part.column(1).to_pylist()))
                yield pa.record_batch(
                    [part.column(0), *(pa.array(p[:, c], pa.float64()) for c in range(len(CATEGORIES))), pa.array(p[:, 1] >= threshold, pa.bool_())],
                    names=["doc_id", *(f"p_{c}" for c in CATEGORIES), "toxic"])

    fields = ", ".join(f"p_{c} double" for c in CATEGORIES)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {fields}, toxic boolean")


def _matrix(chain: Chain, texts: list) -> np.ndarray:
    width = len(chain.vocabulary) + SHARES + 1
    return np.vstack([chain.row(t) for t in texts]) if texts else np.zeros((0, width))


def drop_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that the chain does not call toxic."""
    verdict, = fresh(docs, "toxic")

    @F.pandas_udf("boolean")
    def is_toxic(texts: pd.Series) -> pd.Series:
        p = chain.predict(_matrix(chain, [None if t is None else t for t in texts]))
        return pd.Series(p[:, 1] >= threshold)

    return docs.withColumn(verdict, is_toxic("text")).where(~F.col(verdict)).drop(verdict)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
