"""Exact text-length statistics.

Every statistic is read off a length histogram: one partially aggregated count per (group, length).
Only the histogram is shuffled again, so a group holding most of the rows costs no more than any
other and percentiles need no approximation. The length histograms of ``sources.kept`` are taken as well, in place
of the comments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.functions.labels import label_name
from commentflow.operators.dashboard import counts_by
from commentflow.operators.filters import drop_unlabelled, top_topics_semi
from commentflow.schema import KEPT_ROWS

WHISKER = 1.5


def _sized(df: DataFrame, by: Sequence[str], text_col: str) -> DataFrame:
    """One row per comment, or per row of a kept histogram, with its length."""
    return df if KEPT_ROWS in df.columns else df.select(*by, F.length(text_col).alias("length"))


def length_histogram(df: DataFrame, by: Sequence[str], text_col: str = "text") -> DataFrame:
    """Number of texts per group and length; texts that are missing are left out."""
    return counts_by(_sized(df, by, text_col).filter(F.col("length").isNotNull()), *by, "length", name="n")


def _drop_null_keys(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(by)) if by else df


def text_length_stats(
    df: DataFrame, by: Sequence[str] = ("label", "platform"), text_col: str = "text", platform: str | None = None
) -> DataFrame:
    """Count, mean, sample deviation, range and quartiles (actual lengths) per label and platform.

    Groups whose texts are all missing keep a row with their count, as a plain group-by would.
    """
    if platform is not None:
        df = df.filter(F.col("platform") == platform)
    sized = counts_by(_sized(df, by, text_col), *by, "length", name="n")
    group = Window.partitionBy(*by)
    known = F.when(F.col("length").isNotNull(), F.col("n"))
    weighted = F.col("length").cast("double") * known
    marked = sized.withColumns(
        {
            "_known": F.sum(known).over(group),
            "_mean": F.sum(weighted).over(group) / F.sum(known).over(group),
            "_upto": F.sum(known).over(
                group.orderBy(F.col("length").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
            ),
        }
    )

    def quantile(p: float) -> Column:
        return F.min(F.when(F.col("_upto") >= F.col("_known") * p, F.col("length"))).cast("bigint")

    squares = F.sum(known * F.pow(F.col("length") - F.col("_mean"), 2))
    total = F.max("_known")
    stats = marked.groupBy(*by).agg(
        F.sum("n").alias("count"),
        F.max("_mean").alias("mean"),
        F.when(total > 1, F.sqrt(squares / (total - 1))).alias("stddev"),
        F.min("length").alias("min"),
        F.max("length").alias("max"),
        quantile(0.25).alias("q1"),
        quantile(0.50).alias("median"),
        quantile(0.75).alias("q3"),
    )
    return stats.withColumn("label_name", label_name(F.col("label"))) if "label" in by else stats


def box_stats(df: DataFrame, by: Sequence[str] = (), text_col: str = "text") -> DataFrame:
    """Box-plot numbers: interpolated quartiles, whisker ends inside the 1.5·IQR fences, outliers."""
    by = list(by)
    hist = length_histogram(_drop_null_keys(df, by), by, text_col)
    quartiles = hist.groupBy(*by).agg(
        F.expr("percentile(length, array(0.25, 0.5, 0.75), n)").alias("_q"), F.sum("n").alias("count")
    )
    fences = quartiles.select(
        *by,
        "count",
        F.col("_q")[0].alias("q1"),
        F.col("_q")[1].alias("median"),
        F.col("_q")[2].alias("q3"),
    ).withColumns(
        {
            "low_fence": F.col("q1") - WHISKER * (F.col("q3") - F.col("q1")),
            "high_fence": F.col("q3") + WHISKER * (F.col("q3") - F.col("q1")),
        }
    )
    inside = F.col("length").between(F.col("low_fence"), F.col("high_fence"))
    found = [
        F.min(F.when(inside, F.col("length"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("length"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    ]
    numbers = [c for c in fences.columns if c not in by]
    if by:
        return hist.join(fences, by).groupBy(*by, *numbers).agg(*found)
    # The one row of fences is a scalar subquery, not a join partner.
    row = fences.select(F.struct(*numbers)).scalar()
    marked = hist.withColumn("_fences", row).select("length", "n", "_fences.*")
    return marked.groupBy(*numbers).agg(*found)


def length_box_overall(df: DataFrame, text_col: str = "text") -> DataFrame:
    return box_stats(df, (), text_col)


def length_box_by_label(df: DataFrame, text_col: str = "text") -> DataFrame:
    return box_stats(df, ["label"], text_col)


def length_box_by_source(df: DataFrame, text_col: str = "text") -> DataFrame:
    return box_stats(df, ["source"], text_col)


def length_box_source_label(df: DataFrame, text_col: str = "text") -> DataFrame:
    return box_stats(df, ["source", "label"], text_col)


def length_box_topic_label(df: DataFrame, text_col: str = "text", top_n: int = 10) -> DataFrame:
    """Per topic and label, most frequent topics only."""
    return box_stats(top_topics_semi(df, top_n), ["topic", "label"], text_col)


def median_length_matrix(
    df: DataFrame, labels: Sequence[int] = (-1, 0, 1, 2), text_col: str = "text"
) -> DataFrame:
    """Median length per source and topic, one column per label."""
    by = ["source", "topic", "label"]
    medians = (
        length_histogram(_drop_null_keys(df, by), by, text_col)
        .groupBy(*by)
        .agg(F.expr("percentile(length, 0.5, n)").alias("median_length"))
    )
    return medians.groupBy("source", "topic").agg(
        *[F.max(F.when(F.col("label") == v, F.col("median_length"))).alias(f"label_{v}".replace("-", "minus_"))
          for v in labels]
    )


def boxplot_pivot(
    df: DataFrame, platforms: Sequence[str] = ("threads", "tiktok"), text_col: str = "text"
) -> DataFrame:
    """One row per class name with median, q1 and q3 of every platform side by side."""
    stats = text_length_stats(drop_unlabelled(df), text_col=text_col)
    return stats.groupBy("label_name").agg(
        *[
            F.max(F.when(F.col("platform") == p, F.col(m))).alias(f"{p}_{m}")
            for p in platforms
            for m in ("median", "q1", "q3")
        ]
    )
