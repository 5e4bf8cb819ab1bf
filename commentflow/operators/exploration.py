"""Exploratory counts and percentages. Null keys are dropped, as a dataframe library would."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.operators.filters import filter_source_in
from commentflow.schema import PLATFORMS

PIE_LABEL_THRESHOLD = 2.0


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("count"))


def _hundred() -> Column:
    return F.lit(100.0).cast("double")


def share_of_total(counts: DataFrame, by: Sequence[str], value: str = "count", out: str = "pct") -> DataFrame:
    """Add each row's percentage of its group total; groups that sum to zero get 0."""
    total = F.sum(value).over(Window.partitionBy(*by))
    return counts.withColumn(out, F.coalesce(F.try_divide(F.col(value) * _hundred(), total), F.lit(0.0).cast("double")))


def eda_label_counts(df: DataFrame) -> DataFrame:
    """Label frequencies with share; a share of 2 % or less carries no caption."""
    shares = share_of_total(value_counts(df, "label"), [])
    caption = F.when(
        F.col("pct") > PIE_LABEL_THRESHOLD, F.concat(F.format_string("%.1f", F.bround("pct", 1)), F.lit("%"))
    ).otherwise("")
    return shares.select("label", "count", F.round("pct", 4).alias("pct"), caption.alias("caption"))


def eda_source_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "source").orderBy(F.desc("count"), "source")


def eda_topic_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "topic").orderBy(F.desc("count"), "topic")


def source_label_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "source", "label")


def topic_label_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "topic", "label")


def source_topic_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, "source", "topic")


def _column(label: int) -> str:
    return f"label_{label}".replace("-", "minus_")


def _label_pct(df: DataFrame, by: Sequence[str], labels: Sequence[int]) -> DataFrame:
    """Wide table of label percentages per group. The denominator is every non-null label."""
    usable = df.dropna(subset=[*by, "label"])
    cells = [
        F.round(F.count_if(F.col("label") == v) * _hundred() / F.count("*"), 4).alias(_column(v)) for v in labels
    ]
    return usable.groupBy(*by).agg(*cells)


def _melt(wide: DataFrame, by: Sequence[str], labels: Sequence[int], out: str) -> DataFrame:
    pairs = F.explode(
        F.array(*[F.struct(F.lit(v).alias("label"), F.col(_column(v)).alias(out)) for v in labels])
    )
    return wide.select(*by, pairs.alias("_cell")).select(*by, "_cell.*")


def source_label_pct(
    df: DataFrame, sources: Sequence[str] = PLATFORMS, labels: Sequence[int] = (-1, 0, 1, 2)
) -> DataFrame:
    """Label percentages per source in long form, absent combinations as 0."""
    wide = _label_pct(filter_source_in(df, sources), ["source"], labels)
    return _melt(wide, ["source"], labels, "percentage")


def topic_label_pct(df: DataFrame, labels: Sequence[int] = (-1, 0, 1, 2)) -> DataFrame:
    """One row per topic, one percentage column per label."""
    return _label_pct(df, ["topic"], labels)


def topic_source_label_pct(
    df: DataFrame, sources: Sequence[str] = PLATFORMS, labels: Sequence[int] = (-1, 0, 1, 2)
) -> DataFrame:
    """Per label a topic × source matrix of the label's percentage inside (topic, source)."""
    long = _melt(_label_pct(df, ["topic", "source"], labels), ["topic", "source"], labels, "pct")
    cells = [F.max(F.when(F.col("source") == s, F.col("pct"))).alias(s) for s in sources]
    return long.groupBy("label", "topic").agg(*cells)
