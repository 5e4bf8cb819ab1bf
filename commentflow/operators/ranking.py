"""Ranking, top-k and share helpers that stay balanced when one key holds most of the rows.

* ``first_rows`` and ``limit_rows`` are a ``row_number() <= k`` filter: Spark cuts every group to ``k`` rows in each
  map task before the shuffle.
* ``with_rank`` ranks exactly: rows are dealt to blocks by ranges of (keys, order), ranked inside each block, and
  get the number of the group's rows in earlier blocks added. Blocks hold about ``BLOCK_ROWS`` rows or
  ``BLOCK_BYTES`` of stored files each, whichever is less, so their number follows the table and no task sorts a
  whole group, however wide its rows are.
* ``cap_rows`` cuts groups on a salted key first, which Spark does in the map tasks where it can, and ranks what
  is left. The plan is the same for every limit.

Both write their input to the shared folder first: it is run once, and the count, the sample of the ranges and the
ranking read the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.plans.scratch import stored

HASH_PREFIX = 3
SALTS = 64
BLOCK_ROWS = 1_000_000
BLOCK_BYTES = 32 << 20


def _order(order_by: str | Column | Sequence[str | Column]) -> list[str | Column]:
    return list(order_by) if isinstance(order_by, (list, tuple)) else [order_by]


def _blocks(df: DataFrame, block_rows: int) -> int:
    """Number of blocks for the rows and the bytes of a stored table."""
    files = df.groupBy("_metadata.file_path").agg(F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes"))
    rows, size = files.agg(F.sum("rows"), F.sum("bytes")).first()
    return max(1, -(-(rows or 0) // block_rows), -(-(size or 0) // BLOCK_BYTES))


def limit_rows(
    df: DataFrame, keys: Sequence[str | Column], order_by, n: int, rank_col: str | None = None
) -> DataFrame:
    """First ``n`` rows of every group, for groups or limits known to be small."""
    rank = rank_col or "_rank"
    window = Window.partitionBy(*keys).orderBy(*_order(order_by))
    cut = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
    return cut.select(*df.columns, *([rank] if rank_col else []))


def cap_rows(
    df: DataFrame, keys: Sequence[str | Column], order_by, n: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """First ``n`` rows of every group in the given order."""
    order, df = _order(order_by), stored(df, "to-cap")
    named = {f"_key{i}": k if isinstance(k, Column) else F.col(k) for i, k in enumerate(keys)}
    spread = [c for c in order if isinstance(c, str)] or df.columns
    salt = F.pmod(F.xxhash64(*spread), F.lit(_blocks(df, block_rows)))
    salted = df.withColumns({**named, "_salt": salt})
    left = limit_rows(salted, [*named, "_salt"], order, n).drop("_salt")
    ranked = with_rank(left, list(named), order, "_rank", block_rows)
    return ranked.filter(F.col("_rank") < n).select(*df.columns)


def first_rows(df: DataFrame, keys: Sequence[str | Column], order_by) -> DataFrame:
    """First row of every group."""
    return limit_rows(df, keys, order_by, 1)


def top_values(df: DataFrame, col: str, n: int, count_col: str = "total") -> DataFrame:
    """The ``n`` most frequent values; ties by value."""
    counted = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias(count_col))
    return counted.orderBy(F.desc(count_col), col).limit(n)


def top_counted(
    counted: DataFrame, by: Sequence[str], value: str, n: int, count_col: str = "count"
) -> DataFrame:
    """Rows with the largest counts inside every group, ties by value, with their rank.

    A first cut compares counts only, which is much cheaper than sorting every value; it keeps ties,
    on a salted key so that a group of nothing but ties stays spread out. The values decide among
    what is left.
    """
    spread = Window.partitionBy(*by, "_salt").orderBy(F.desc(count_col))
    salted = counted.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    contenders = salted.withColumn("_rank", F.rank().over(spread)).filter(F.col("_rank") <= n)
    return limit_rows(contenders.select(*counted.columns), by, [F.desc(count_col), value], n, rank_col="rank")


def share_of(value: Column, by: Sequence[str] = ()) -> Column:
    """Value as a percentage of its group total."""
    return value * 100.0 / F.sum(value).over(Window.partitionBy(*by))


def with_bucketed_rank(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column], bucket: Column, out: str = "rank"
) -> DataFrame:
    """Exact 0-based rank inside ``keys``, given a bucket that never decreases along the order.

    The offsets have one row per key and bucket and read only those columns. Keys are compared as one
    struct, and so are buckets: that treats nulls as equal and lets the join reuse the partitioning of the
    window. The input is read more than once and has to give the same rows each time.
    """
    marked = df.withColumns({"_key": F.struct(F.lit(0).alias("_"), *keys), "_bucket": F.struct(bucket.alias("_"))})
    lower = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy("_key", "_bucket")
        .agg(F.count("*").alias("_rows"))
        .select("_key", "_bucket", F.coalesce(F.sum("_rows").over(lower), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_key", "_bucket").orderBy(*order_by)
    ranked = marked.withColumn("_inside", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["_key", "_bucket"]).select(
        *df.columns, (F.col("_inside") + F.col("_offset")).cast("bigint").alias(out)
    )


def with_rank(
    df: DataFrame, keys: Sequence[str] = (), order_by="id", out: str = "rank", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Exact 0-based rank in the order of any sortable columns, inside ``keys`` or over the whole table.

    Nulls come first and are ranked like any value; rows equal in the whole order share out their ranks
    arbitrarily. The ranked rows are written to the shared folder, so each keeps its block and rank.
    """
    order, df = _order(order_by), stored(df, "to-rank")
    dealt = df.repartitionByRange(_blocks(df, block_rows), *keys, *order).withColumn("_block", F.spark_partition_id())
    inside = Window.partitionBy("_block", *keys).orderBy(*order)
    ranked = stored(dealt.withColumn("_inside", F.row_number().over(inside) - 1), "ranked")
    key = F.struct(F.lit(0).alias("_"), *keys)
    lower = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first group of a block can have rows in earlier blocks, so few offsets are left.
    offsets = (
        ranked.groupBy(key.alias("_key"), "_block")
        .agg(F.count("*").alias("_rows"))
        .select("_key", "_block", F.sum("_rows").over(lower).alias("_offset"))
        .filter("_offset > 0")
    )
    marked = ranked.withColumn("_key", key)
    return marked.join(offsets, ["_key", "_block"], "left").select(
        *df.columns, (F.col("_inside") + F.coalesce("_offset", F.lit(0))).cast("bigint").alias(out)
    )
