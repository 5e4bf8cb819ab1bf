"""Counts and length histograms that loads keep up to date, so reports need not count the comments again.

A load turns its new rows into two small tables of signed deltas, rows per (day, platform, topic, keyword, label) and
texts per (platform, topic, label, length), in one scan, and adds them to two leveled tables. A row that changes, such
as one that gets its label, is removed as it was and added as it is. Groups whose rows are all gone disappear.

``counts`` and ``lengths`` take the place of the comments in the functions of ``operators.dashboard`` and
``operators.lengths``: each of their rows stands for ``KEPT_ROWS`` comments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentflow.plans.scratch import stored
from commentflow.schema import KEPT_ROWS
from commentflow.sources.leveled import Leveled

COUNT_KEYS = ("crawl_date", "platform", "topic", "keyword", "label")
LENGTH_KEYS = ("platform", "topic", "label", "length")
_TYPES = {"crawl_date": T.DateType(), "label": T.LongType(), "length": T.IntegerType()}


def _schema(keys: tuple[str, ...]) -> T.StructType:
    fields = [T.StructField(k, _TYPES.get(k, T.StringType())) for k in keys]
    return T.StructType([*fields, T.StructField(KEPT_ROWS, T.LongType())])


def deltas(added: DataFrame, removed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Signed deltas of the counts and of the length histogram, from one scan of the rows."""

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(
            "crawl_date", "platform", "topic", "keyword", F.col("label").cast("bigint").alias("label"),
            F.length("text").alias("length"), F.lit(sign).cast("bigint").alias("_sign"))

    rows = signed(added, 1) if removed is None else signed(added, 1).unionByName(signed(removed, -1))
    used = [*COUNT_KEYS, "length"]
    sets = [[F.col(k) for k in keys] for keys in (COUNT_KEYS, LENGTH_KEYS)]
    both = stored(
        rows.groupingSets(sets, *used).agg(F.grouping("length").alias("_of_counts"), F.sum("_sign").alias(KEPT_ROWS)), "deltas")
    of_counts = F.col("_of_counts") == 1
    return both.filter(of_counts).select(*COUNT_KEYS, KEPT_ROWS), both.filter(~of_counts).select(*LENGTH_KEYS, KEPT_ROWS)


class KeptReports:
    """The two kept tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        root = root.rstrip("/")
        self._counts, self._lengths = (
            Leveled(spark, f"{root}/{name}", self._sums(keys)) for name, keys in (("counts", COUNT_KEYS), ("lengths", LENGTH_KEYS)))

    @staticmethod
    def _sums(keys: tuple[str, ...]):
        return lambda rows: rows.groupBy(*keys).agg(F.sum(KEPT_ROWS).alias(KEPT_ROWS)).filter(F.col(KEPT_ROWS) != 0)

    def batches(self) -> int:
        """Loads that are complete; one that was interrupted between the tables does not count, and is to be run again."""
        return min(self._counts.batches(), self._lengths.batches())

    def load(self, added: DataFrame, batch: int, removed: DataFrame | None = None) -> None:
        """Take in load ``batch``, the next one or the last one again; a load that is run again must bring the same rows."""
        counts, lengths = deltas(added, removed)
        self._counts.add(counts, batch)
        self._lengths.add(lengths, batch)

    def counts(self) -> DataFrame:
        return self._read(self._counts, COUNT_KEYS)

    def lengths(self) -> DataFrame:
        return self._read(self._lengths, LENGTH_KEYS)

    def _read(self, table: Leveled, keys: tuple[str, ...]) -> DataFrame:
        rows = table.read(self.batches())
        return self.spark.createDataFrame([], _schema(keys)) if rows is None else rows
