"""Classification metrics.

Every metric is derived from the confusion counts, which are conditional counts of one partially
aggregated group-by: k² numbers per group, whatever the number of rows. The label grid is complete
by construction, also when a class never occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.schema import CLASSES

# ---- fixed values -------------------------------------------------------------------------
REPORT_NAMES = {0: "clean", 1: "offensive", 2: "hate"}
SUMMARY_COLUMNS = {
    "model": "Model", "dataset": "Dataset", "acc": "OOF Acc", "f1_macro": "OOF F1 Macro",
    "fold_f1_mean": "Fold F1 Mean", "fold_f1_std": "Fold F1 Std", "recall_clean": "Recall(clean)",
    "recall_off": "Recall(off)", "recall_hate": "Recall(hate)",
}
RADAR_METRICS = ("accuracy", "macro_f1", "macro_precision", "macro_recall", "target_hate_f1", "target_normal_f1")
# ---- end of fixed values ------------------------------------------------------------------


def _cell(i: int, j: int) -> str:
    return f"c{i}_{j}"


def confusion_counts(
    df: DataFrame, y: str = "label", p: str = "prediction", classes: Sequence[int] = CLASSES, by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with a column for every (actual, predicted) pair."""
    cells = [
        F.count_if((F.col(y) == i) & (F.col(p) == j)).alias(_cell(i, j)) for i in classes for j in classes
    ]
    extra = [
        F.count("*").alias("rows"),
        F.count_if(F.col(y) == F.col(p)).alias("correct"),
        *[F.count_if(F.col(y) == i).alias(f"actual{i}") for i in classes],
        *[F.count_if(F.col(p) == j).alias(f"predicted{j}") for j in classes],
    ]
    return df.groupBy(*by).agg(*cells, *extra)


def _safe(numerator: Column, denominator: Column) -> Column:
    """Quotient with 0 for a zero denominator."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0).cast("double"))


def _precision(c: int) -> Column:
    return _safe(F.col(_cell(c, c)), F.col(f"predicted{c}"))


def _recall(c: int) -> Column:
    return _safe(F.col(_cell(c, c)), F.col(f"actual{c}"))


def _f1(c: int) -> Column:
    return _safe(2 * F.col(_cell(c, c)), F.col(f"actual{c}") + F.col(f"predicted{c}"))


def _macro(metric, classes: Sequence[int]) -> Column:
    parts = [metric(c) for c in classes]
    return sum(parts[1:], parts[0]) / F.lit(float(len(parts)))


def _weighted(metric, classes: Sequence[int]) -> Column:
    parts = [metric(c) * F.col(f"actual{c}") for c in classes]
    support = [F.col(f"actual{c}") for c in classes]
    return _safe(sum(parts[1:], parts[0]), sum(support[1:], support[0]))


def _accuracy() -> Column:
    return _safe(F.col("correct"), F.col("rows"))


def confusion_matrix(
    df: DataFrame, y: str = "label", p: str = "prediction", classes: Sequence[int] = CLASSES, by: Sequence[str] = ()
) -> DataFrame:
    """Complete grid of (actual, predicted, count) with each cell's share of the largest one."""
    counts = confusion_counts(df, y, p, classes, by)
    largest = F.greatest(*[F.col(_cell(i, j)) for i in classes for j in classes])
    cells = [
        F.struct(
            F.lit(i).alias("actual"), F.lit(j).alias("predicted"), F.col(_cell(i, j)).alias("count"),
            F.round(_safe(F.col(_cell(i, j)), largest), 4).alias("intensity"),
        )
        for i in classes for j in classes
    ]
    return counts.select(*by, F.inline(F.array(*cells)))


def matrix_json(
    df: DataFrame, y: str = "label", p: str = "prediction", classes: Sequence[int] = CLASSES, by: Sequence[str] = ()
) -> DataFrame:
    """The matrix as the JSON string an evaluation row stores."""
    counts = confusion_counts(df, y, p, classes, by)
    matrix = F.array(*[F.array(*[F.col(_cell(i, j)) for j in classes]) for i in classes])
    return counts.select(*by, F.to_json(matrix).alias("confusion_matrix"))


def matrix_cells(df: DataFrame, by: Sequence[str], matrix_col: str = "confusion_matrix") -> DataFrame:
    """Stored JSON matrices as (actual, predicted, count) rows."""
    parsed = F.from_json(F.col(matrix_col), "array<array<bigint>>")
    rows = df.select(*by, F.posexplode(parsed).alias("actual", "_row"))
    return rows.select(*by, "actual", F.posexplode("_row").alias("predicted", "count"))


def accuracy(
    df: DataFrame, y: str = "label", p: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    hit = F.when(F.col(y) == F.col(p), 1.0).otherwise(0.0).cast("double")
    return df.groupBy(*by).agg(F.round(F.avg(hit), 4).alias("accuracy"))


def class_report(
    df: DataFrame, y: str = "label", p: str = "prediction", classes: Sequence[int] = CLASSES, by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class, the accuracy (under ``f1``), macro and weighted averages."""
    counts = confusion_counts(df, y, p, classes, by)
    support = [F.col(f"actual{c}") for c in classes]
    total = sum(support[1:], support[0])

    def row(name: str, precision: Column, recall: Column, f1: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), F.round(precision, 4).alias("precision"),
            F.round(recall, 4).alias("recall"), F.round(f1, 4).alias("f1"), rows.alias("support"),
        )

    lines = [
        row(REPORT_NAMES.get(c, str(c)), _precision(c), _recall(c), _f1(c), F.col(f"actual{c}")) for c in classes
    ]
    none = F.lit(None).cast("double")
    lines.append(row("accuracy", none, none, _accuracy(), F.col("rows")))
    lines += [
        row(f"{kind} avg", avg(_precision, classes), avg(_recall, classes), avg(_f1, classes), total)
        for kind, avg in (("macro", _macro), ("weighted", _weighted))
    ]
    return counts.select(*by, F.inline(F.array(*lines)))


def macro_f1(
    df: DataFrame, y: str = "label", p: str = "prediction", classes: Sequence[int] = CLASSES, by: Sequence[str] = ()
) -> DataFrame:
    """Mean F1 over the classes."""
    counts = confusion_counts(df, y, p, classes, by)
    return counts.select(*by, F.round(_macro(_f1, classes), 4).alias("macro_f1"))


def weighted_f1(
    df: DataFrame, y: str = "label", p: str = "prediction", classes: Sequence[int] = CLASSES, by: Sequence[str] = ()
) -> DataFrame:
    """F1 averaged by the support of the classes."""
    counts = confusion_counts(df, y, p, classes, by)
    return counts.select(*by, F.round(_weighted(_f1, classes), 4).alias("weighted_f1"))


def _fold_metrics(df, y, p, classes, by) -> DataFrame:
    counts = confusion_counts(df, y, p, classes, by)
    return counts.select(
        *by, _accuracy().alias("acc"), _macro(_f1, classes).alias("f1_macro"),
        _recall(1).alias("recall_off"), _recall(2).alias("recall_hate"),
    )


def _rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


_FOLD_METRICS = ("acc", "f1_macro", "recall_off", "recall_hate")


def fold_metrics(
    df: DataFrame, y: str = "label", p: str = "prediction", fold: str = "fold",
    classes: Sequence[int] = CLASSES, by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy, macro F1 and the recalls of classes 1 and 2 per fold."""
    return _rounded(_fold_metrics(df, y, p, classes, [*by, fold]), _FOLD_METRICS)


def _fold_summary(df, y, p, fold, classes, by) -> DataFrame:
    per_fold = _fold_metrics(df, y, p, classes, [*by, fold])
    stats = [f(m).alias(f"{m}_{n}") for m in _FOLD_METRICS for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    return per_fold.groupBy(*by).agg(*stats)


def fold_summary(
    df: DataFrame, y: str = "label", p: str = "prediction", fold: str = "fold",
    classes: Sequence[int] = CLASSES, by: Sequence[str] = (),
) -> DataFrame:
    """Mean and sample standard deviation of the fold metrics."""
    summary = _fold_summary(df, y, p, fold, classes, by)
    return _rounded(summary, [c for c in summary.columns if c not in by])


def oof_evaluation(
    df: DataFrame, y: str = "label", p: str = "prediction", model: str = "model",
    dataset: str = "oof_full", classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """Metrics over all out-of-fold predictions of each model."""
    counts = confusion_counts(df, y, p, classes, [model])
    return counts.select(
        F.col(model).alias("model"), F.lit(dataset).alias("dataset"), F.round(_accuracy(), 4).alias("acc"),
        F.round(_macro(_f1, classes), 4).alias("f1_macro"), F.round(_recall(0), 4).alias("recall_clean"),
        F.round(_recall(1), 4).alias("recall_off"), F.round(_recall(2), 4).alias("recall_hate"),
    )


def model_summary_table(
    df: DataFrame, y: str = "label", p: str = "prediction", model: str = "model", fold: str = "fold",
    dataset: str = "oof_full", classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """One row per model under its report headings.

    Confusion counts are additive, so the counts per fold serve both the fold statistics and, summed
    up, the out-of-fold metrics: the rows are read once.
    """
    cells = [_cell(i, j) for i in classes for j in classes]
    parts = [*cells, "rows", "correct", *[f"actual{i}" for i in classes], *[f"predicted{i}" for i in classes]]
    per_fold = confusion_counts(df, y, p, classes, [model, fold]).withColumn("_f1", _macro(_f1, classes))
    overall = per_fold.groupBy(F.col(model).alias("model")).agg(
        *[F.sum(c).alias(c) for c in parts],
        F.avg("_f1").alias("fold_f1_mean"), F.stddev_samp("_f1").alias("fold_f1_std"),
    )
    table = overall.select(
        "model", F.lit(dataset).alias("dataset"), _accuracy().alias("acc"), _macro(_f1, classes).alias("f1_macro"),
        "fold_f1_mean", "fold_f1_std", _recall(0).alias("recall_clean"), _recall(1).alias("recall_off"),
        _recall(2).alias("recall_hate"),
    )
    numbers = [c for c in SUMMARY_COLUMNS if c not in ("model", "dataset")]
    return _rounded(table, numbers).withColumnsRenamed(SUMMARY_COLUMNS)


def model_evaluation(
    df: DataFrame, y: str = "label", p: str = "prediction", model: str = "model_id", classes: Sequence[int] = CLASSES
) -> DataFrame:
    """Evaluation rows as the registry keeps them, the confusion matrix as a JSON string."""
    counts = confusion_counts(df, y, p, classes, [model])
    matrix = F.array(*[F.array(*[F.col(_cell(i, j)) for j in classes]) for i in classes])
    metrics = {
        "accuracy": _accuracy(), "macro_f1": _macro(_f1, classes), "weighted_f1": _weighted(_f1, classes),
        "macro_precision": _macro(_precision, classes), "macro_recall": _macro(_recall, classes),
        "target_hate_f1": _f1(2), "target_offensive_f1": _f1(1), "target_normal_f1": _f1(0),
    }
    return counts.select(
        model, *[F.round(v, 4).alias(k) for k, v in metrics.items()],
        F.to_json(matrix).alias("confusion_matrix"), F.col("rows").alias("total_samples"),
    )


def model_best_flags(
    models: DataFrame, metrics: Sequence[str] = ("accuracy", "macro_f1", "target_hate_f1"), model: str = "model_id"
) -> DataFrame:
    """Whether a model holds the maximum of each metric. There is one row per model."""
    everything = Window.partitionBy()
    flags = [(F.col(m) == F.max(m).over(everything)).alias(f"best_{m}") for m in metrics]
    return models.select(model, *metrics, *flags)


def metric_radar(
    models: DataFrame, names: Sequence[str], metrics: Sequence[str] = RADAR_METRICS, model: str = "model_id"
) -> DataFrame:
    """Metric × model matrix in percent with one decimal."""
    long = models.select(model, *metrics).unpivot(model, list(metrics), "metric", "value")
    cells = [F.max(F.when(F.col(model) == n, F.bround(F.col("value") * 100, 1))).alias(n) for n in names]
    return long.groupBy("metric").agg(*cells)


def _neg_log_softmax(scores: Column, target: Column) -> Column:
    """Cross-entropy of one row, shifted by the largest score so that nothing overflows."""
    wide = F.transform(scores, lambda s: s.cast("double"))
    top = F.array_max(wide)
    mass = F.aggregate(wide, F.lit(0.0).cast("double"), lambda acc, s: acc + F.exp(s - top))
    return F.ln(mass) + top - F.get(wide, target)


def log_loss(scores: str | Column, y: str | Column) -> Column:
    """Loss of one row over its class scores."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return _neg_log_softmax(as_column(scores), as_column(y))


def required_weight(weight: Column, y: Column) -> Column:
    """The weight itself; a missing one raises when a row of its class is read."""
    return F.coalesce(weight, F.raise_error(F.concat(F.lit("no weight for class "), F.coalesce(y.cast("string"), F.lit("null")))).cast("double"))


def weighted_log_loss(
    df: DataFrame, weights: DataFrame, scores: str = "logits", y: str = "label"
) -> DataFrame:
    """Class-weighted mean cross-entropy; ``weights`` has one row per class, and a class without one is an error."""
    joined = df.join(weights.select(y, "weight"), y, "left")
    weighted = joined.withColumn("weight", required_weight(F.col("weight"), F.col(y)))
    loss = log_loss(scores, y)
    return weighted.agg(
        F.round(F.sum(F.col("weight") * loss) / F.sum("weight"), 4).alias("weighted_log_loss")
    )


def perplexity(df: DataFrame, loss: str | Column = "loss") -> DataFrame:
    return df.agg(F.round(F.exp(F.avg(loss)), 4).alias("perplexity"))
