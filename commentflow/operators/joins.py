"""Joins: incremental loads, prediction alignment and dimension look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.functions.text import strip_space
from commentflow.schema import label_dim, topic_keyword_dim

STORED_KEY = ("text", "topic", "keyword", "url")
DIGEST = "row_digest"


def row_digest(columns: Sequence[str], text_col: str = "text") -> Column:
    """256-bit digest of a row key; the text is trimmed, nulls count as values of their own."""
    parts = []
    for name in columns:
        value = strip_space(F.col(name)) if name == text_col else F.col(name).cast("string")
        # The length in front keeps neighbouring fields from running into each other.
        parts.append(F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    # Never null, so joins on it need no extra filter that would compute it a second time.
    return F.coalesce(F.unhex(F.sha2(F.concat(*parts), 256)), F.lit(b""))


def left_join_dealt(rows: DataFrame, facts: DataFrame, key: str, deal: Mapping[str, Column]) -> DataFrame:
    """Left join on ``key`` whose rows lie in tasks by ranges of (``deal``, key) afterwards.

    ``deal`` has to follow from the key alone, so it is known for both sides. Rows and facts are shuffled together, once,
    and meet inside their task. A join by the key and a shuffle by ``deal`` after it would move wide rows twice, or once
    as long as the facts are broadcast.
    """
    others = [c for c in facts.columns if c != key]
    wide = rows.select(key, F.struct(*rows.columns).alias("_row"))
    narrow = facts.filter(F.col(key).isNotNull()).select(key, F.struct(*others).alias("_fact"))
    both = wide.unionByName(narrow, allowMissingColumns=True)
    named = {f"_deal{i}": column for i, column in enumerate(deal.values())}
    dealt = both.withColumns(named).repartitionByRange(*named, key)
    met = dealt.withColumn("_facts", F.collect_list("_fact").over(Window.partitionBy(*named, key)))
    joined = met.filter(F.col("_row").isNotNull()).select("_row", F.explode_outer("_facts").alias("_fact"))
    return joined.select("_row.*", "_fact.*")


def incremental_anti(
    new: DataFrame, stored: DataFrame, keys: Sequence[str] = STORED_KEY, text_col: str = "text"
) -> DataFrame:
    """New rows that are not stored yet. Duplicates inside the new rows stay.

    ``stored`` is either a table of digests, as ``scan_digests`` reads them, or rows with the keys."""
    fresh = new.withColumn(DIGEST, row_digest(keys, text_col))
    return unknown_rows(fresh, digests(stored, keys, text_col)).select(*new.columns)


def digests(stored: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    """Stored digests where the table has them; only rows without any are hashed."""
    return stored.select(DIGEST) if DIGEST in stored.columns else stored.select(row_digest(keys, text_col).alias(DIGEST))


def unknown_rows(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``fresh`` whose digest is not among the known ones.

    Only 32-byte digests of the stored rows are moved. They are first cut down to digests the new
    rows hold at all, a broadcast semi join whenever the batch is small, and made distinct with
    map-side aggregation: a text stored many times is one row by the time of the anti join. A digest
    frequent among the new rows is left to adaptive skew handling, which may split the left side of
    an anti join.
    """
    hits = known.join(fresh.select(DIGEST).distinct(), DIGEST, "left_semi").distinct()
    return fresh.join(hits, DIGEST, "left_anti")


def align_predictions(base: DataFrame, predictions: Mapping[str, DataFrame], key: str = "id") -> DataFrame:
    """Put the ``label`` of several prediction tables next to each row, matched by id."""

    def add(left: DataFrame, item: tuple[str, DataFrame]) -> DataFrame:
        name, table = item
        return left.join(table.select(key, F.col("label").alias(name)), key, "left")

    return reduce(add, predictions.items(), base)


def model_comparison_join(registry: DataFrame, evaluation: DataFrame) -> DataFrame:
    """Registry entries with their evaluation results; models without results drop out."""
    return evaluation.join(registry, "model_id")


def label_dim_join(df: DataFrame, label_col: str = "label") -> DataFrame:
    """All four names of each row's label. The broadcast table has one row per known label."""
    dim = label_dim(df.sparkSession).withColumnRenamed("label", "_dim_label")
    return df.join(F.broadcast(dim), F.col(label_col) == F.col("_dim_label"), "left").drop("_dim_label")


def topic_keyword_check(df: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """(topic, keyword) pairs with their row count that the crawl plan does not contain.

    Pairs are counted first, so the anti join sees distinct pairs only.
    """
    pairs = df.groupBy("topic", "keyword").agg(F.count("*").alias("row_count"))
    planned = dim if dim is not None else F.broadcast(topic_keyword_dim(df.sparkSession))
    return pairs.join(planned, ["topic", "keyword"], "left_anti")
