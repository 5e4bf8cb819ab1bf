"""TF-IDF baselines on MLlib."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.functions.text import SPACE_CLASS
from commentflow.operators.evaluation import required_weight
from commentflow.operators.sampling import class_weights
from commentflow.plans.scratch import stored

FEATURES = 1 << 16


def _counts_col(features: int) -> str:
    return f"_tf{features}"


def _counting(text_col: str, features: int) -> list:
    return [
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=f"[{SPACE_CLASS}]+"),
        HashingTF(inputCol="_words", outputCol=_counts_col(features), numFeatures=features),
    ]


def with_term_counts(df: DataFrame, text_col: str = "text", features: int = FEATURES) -> DataFrame:
    """Rows with their hashed term counts, which the baselines below then take instead of splitting the texts again."""
    for stage in _counting(text_col, features):
        df = stage.transform(df)
    return df.drop("_words")


def _tfidf(df: DataFrame, text_col: str, features: int) -> list:
    counts = _counts_col(features)
    before = [] if counts in df.columns else _counting(text_col, features)
    return [*before, IDF(inputCol=counts, outputCol="features", minDocFreq=2)]


def with_class_weight(df: DataFrame, weights: DataFrame, y: str = "label", out: str = "weight") -> DataFrame:
    """Attach each row's class weight; a class without one is an error, not a dropped row."""
    return df.join(weights.select(y, F.col("weight").alias(out)), y, "left").withColumn(out, required_weight(F.col(out), F.col(y)))


def baseline_tfidf_lr(
    df: DataFrame, text_col: str = "text", y: str = "label", weight_col: str | None = None,
    max_iter: int = 20, reg: float = 0.01, features: int = FEATURES,
) -> PipelineModel:
    """TF-IDF with multinomial logistic regression, optionally class-weighted."""
    classifier = LogisticRegression(featuresCol="features", labelCol=y, maxIter=max_iter, regParam=reg)
    if weight_col is not None:
        classifier = classifier.setWeightCol(weight_col)
    return Pipeline(stages=[*_tfidf(df, text_col, features), classifier]).fit(df)


def baseline_tfidf_svm(
    df: DataFrame, text_col: str = "text", y: str = "label", weight_col: str | None = None,
    max_iter: int = 20, reg: float = 0.01, features: int = FEATURES,
) -> PipelineModel:
    """TF-IDF with one linear SVM per class, fitted one after another: threads that share one plan have failed to ship their tasks."""
    svm = LinearSVC(featuresCol="features", maxIter=max_iter, regParam=reg)
    classifier = OneVsRest(classifier=svm, featuresCol="features", labelCol=y, parallelism=1)
    if weight_col is not None:
        classifier = classifier.setWeightCol(weight_col)
    return Pipeline(stages=[*_tfidf(df, text_col, features), classifier]).fit(df)


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Rows with the model's class and none of its working columns."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").cast("int").alias(out))


def cross_fitted(
    df: DataFrame, fit: Callable[..., PipelineModel] = baseline_tfidf_lr, k: int = 5, fold: str = "fold", y: str = "label",
    text_col: str = "text", out: str = "prediction",
) -> DataFrame:
    """Every row with the class that a model gives it which was trained on the other folds only.

    Each of the ``k`` models is weighted by the class sizes of its own training rows. Rows whose fold is not 0…k-1 are an
    error, as they would have no prediction. Texts are split and hashed once and stored; document frequencies and weights
    are each model's own."""
    checked = df.withColumn(fold, F.when(F.col(fold).between(0, k - 1), F.col(fold)).otherwise(
        F.raise_error(F.concat(F.lit("not a fold: "), F.coalesce(F.col(fold).cast("string"), F.lit("null"))))))
    counts = _counts_col(FEATURES)
    rows = stored(with_term_counts(checked, text_col), "folded")
    parts = []
    for n in range(k):
        train = rows.filter(F.col(fold) != n)
        weighted = with_class_weight(train.select(text_col, counts, y), class_weights(train, y=y), y)
        parts.append(predict(fit(weighted, text_col, y, weight_col="weight"), rows.filter(F.col(fold) == n), out).drop(counts))
    return reduce(DataFrame.unionByName, parts)
