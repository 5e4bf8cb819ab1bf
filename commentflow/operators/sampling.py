"""Class counts, class weights, stratified folds and stable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.operators.ranking import HASH_PREFIX, with_bucketed_rank
from commentflow.schema import CLASSES

SEED = 42


def class_counts(df: DataFrame, y: str = "label") -> DataFrame:
    return df.filter(F.col(y).isNotNull()).groupBy(y).agg(F.count("*").alias("count")).orderBy(y)


def _weights(total: Column, counts: list[Column], classes: Sequence[int]) -> list[Column]:
    """Inverse class frequencies scaled to sum to the number of classes."""
    k = F.lit(float(len(classes)))
    raw = [F.try_divide(total.cast("double"), k * n) for n in counts]
    whole = sum(raw[1:], raw[0])
    return [w / whole * k for w in raw]


def class_weights(
    df: DataFrame, y: str = "label", classes: Sequence[int] = CLASSES, digits: int | None = 4
) -> DataFrame:
    """Weight of each class: rows / (k · class rows), scaled so that the weights sum to k."""
    counts = [F.count_if(F.col(y) == c).alias(f"n{c}") for c in classes]
    wide = df.agg(F.count("*").alias("total"), *counts)
    weights = _weights(F.col("total"), [F.col(f"n{c}") for c in classes], classes)
    rows = [
        F.struct(F.lit(c).alias("label"), F.col(f"n{c}").alias("count"),
                 (w if digits is None else F.round(w, digits)).alias("weight"))
        for c, w in zip(classes, weights)
    ]
    return wide.select(F.inline(F.array(*rows)))


def fold_class_weights(
    df: DataFrame, y: str = "label", fold: str = "fold", classes: Sequence[int] = CLASSES
) -> DataFrame:
    """Class weights of each training part (all folds but one); an absent class counts as 1.

    Counts per fold come from one aggregate; a training part is the total minus the fold.
    """
    counts = [F.count_if(F.col(y) == c).alias(f"n{c}") for c in classes]
    per_fold = df.groupBy(fold).agg(F.count("*").alias("rows"), *counts)
    everything = Window.partitionBy()

    def rest(name: str) -> Column:
        return F.sum(name).over(everything) - F.col(name)

    train = per_fold.select(fold, rest("rows").alias("rows"), *[rest(f"n{c}").alias(f"n{c}") for c in classes])
    clamped = [F.when(F.col(f"n{c}") == 0, F.lit(1)).otherwise(F.col(f"n{c}")) for c in classes]
    weights = _weights(F.col("rows"), clamped, classes)
    rows = [
        F.struct(F.lit(c).alias("label"), n.alias("train_count"), F.round(w, 4).alias("weight"))
        for c, n, w in zip(classes, clamped, weights)
    ]
    return train.select(fold, F.inline(F.array(*rows)))


def stratified_kfold(
    df: DataFrame, k: int = 5, y: str = "label", id_col: str = "id", seed: int = SEED,
    prefix: int = HASH_PREFIX, out: str = "fold",
) -> DataFrame:
    """Fold 0…k-1 of every row; class sizes of two folds differ by one at most.

    Rows of a class are dealt out in the order of a seeded hash. A class is ranked in 16**prefix hash
    buckets, so no task handles a whole class.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}"))))
    ranked = with_bucketed_rank(hashed, [y], ["_hash", id_col], F.substring("_hash", 1, prefix), "_dealt")
    return ranked.withColumn(out, (F.col("_dealt") % k).cast("int")).drop("_dealt", "_hash")


def hash_percentile(id_col: str | Column) -> Column:
    """A row's stable place 0…99, the same for any partitioning and on every run."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.conv(F.substring(F.md5(column.cast("string")), 1, 8), 16, 10).cast("bigint") % 100


def train_test_split(
    df: DataFrame, test_percent: int = 1, id_col: str = "id", out: str = "split_set"
) -> DataFrame:
    """Mark each row ``train`` or ``test``."""
    return df.withColumn(out, F.when(hash_percentile(id_col) < test_percent, "test").otherwise("train"))
