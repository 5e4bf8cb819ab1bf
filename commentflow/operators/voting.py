"""Combining the labels of several models."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentflow.functions import labels
from commentflow.functions.labels import label_name
from commentflow.schema import UNLABELLED


def hard_vote(df: DataFrame, voter_cols: Sequence[str], out: str = "hard_voting_label") -> DataFrame:
    """Majority of three columns; the first decides a three-way tie. -1 is a vote like any other."""
    return df.withColumn(out, labels.hard_vote(*[F.col(c) for c in voter_cols]))


def hard_vote_n(
    votes: DataFrame, id_col: str = "id", voter_col: str = "voter_rank", label_col: str = "label",
    out: str = "hard_voting_label",
) -> DataFrame:
    """Majority per id over votes in long form; a tie goes to the label named by the earliest voter.

    Two aggregates on the id, the first one partial: an id has as many rows as there are voters.
    """
    counted = votes.groupBy(id_col, label_col).agg(
        F.count("*").alias("_votes"), F.min(voter_col).alias("_first")
    )
    best = F.max_by(F.col(label_col), F.struct(F.col("_votes"), (-F.col("_first")).alias("_order")))
    return counted.groupBy(id_col).agg(best.alias(out))


def missing_voter_default(df: DataFrame, voter_cols: Sequence[str], default: int = UNLABELLED) -> DataFrame:
    """Add voter columns that are absent, filled with the default label."""
    absent = [c for c in voter_cols if c not in df.columns]
    if absent:
        warnings.warn(f"no predictions in column(s) {absent}; using {default}", stacklevel=2)
    return df.withColumns({c: F.lit(default) for c in absent}) if absent else df


def vote_distribution(df: DataFrame, label_cols: Sequence[str]) -> DataFrame:
    """Rows per label of every model and of the ensemble, from one pass."""
    long = df.select(*label_cols).unpivot([], list(label_cols), "model", "label")
    return long.groupBy("model", "label").agg(F.count("*").alias("count"))


def prediction_quality(df: DataFrame, label_col: str = "predicted_label") -> DataFrame:
    """Final label counts with names next to how many answers could be read."""
    per_label = df.groupBy(F.col(label_col).alias("_raw")).agg(F.count("*").alias("_n"))
    everything = Window.partitionBy()
    final = per_label.select(
        labels.unparsed_to_clean(F.col("_raw")).alias("label"),
        "_n",
        F.coalesce(F.sum(F.when(F.col("_raw") == UNLABELLED, F.col("_n"))).over(everything), F.lit(0)).alias("unparsed"),
        F.sum("_n").over(everything).alias("total"),
    )
    return (
        final.groupBy("label", "unparsed", "total").agg(F.sum("_n").alias("count"))
        .select("label", label_name(F.col("label")).alias("label_name"), "count",
                "unparsed", (F.col("total") - F.col("unparsed")).alias("parsed"))
    )
