"""An index of row digests that a load reads by bucket only.

Digests are kept in buckets of equal prefixes, about ``rows_per_bucket`` digests each, so the number of buckets follows
the number of digests and the bytes of a bucket do not. A batch reads the buckets its own digests fall into. New
digests go to the levels of a ``Leveled`` table, each of which has buckets of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentflow.operators.joins import DIGEST, STORED_KEY, row_digest, unknown_rows
from commentflow.plans.scratch import stored
from commentflow.sources.leveled import Leveled

ROWS_PER_BUCKET = 1 << 20
#: Buckets that are named one by one; a batch that touches more reads them all.
NAMED_BUCKETS = 4096
_MAX_BITS = 24


def prefix(digest: Column, bits: int) -> Column:
    """The first bits of a digest as a number."""
    head = F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("bigint")
    return F.shiftright(F.coalesce(head, F.lit(0)), 32 - bits).cast("int")


class DigestIndex(Leveled):
    """Digests below ``root``."""

    def __init__(self, spark: SparkSession, root: str, rows_per_bucket: int = ROWS_PER_BUCKET):
        super().__init__(spark, root)
        self.rows_per_bucket = rows_per_bucket

    def build(self, digests: DataFrame) -> None:
        """Start the index with the digests of a store; there must be none yet."""
        if self.state() is not None:
            raise ValueError(f"{self.root} holds an index")
        self.publish(0, {}, self._write(digests.select(DIGEST), f"{self.root}/base"))

    def _part(self, spark: SparkSession, name: str) -> DataFrame:
        return super()._part(spark, name).select(DIGEST)

    def _write(self, rows: DataFrame, path: str) -> int:
        once = rows.select(DIGEST).distinct()
        bits = min(_MAX_BITS, max(0, -(-once.count() // self.rows_per_bucket) - 1).bit_length())
        bucketed = once.withColumn("bucket", prefix(F.col(DIGEST), bits))
        bucketed.repartition("bucket").sortWithinPartitions("bucket", DIGEST).write.mode("overwrite").partitionBy("bucket").parquet(path)
        return bits

    def near(self, rows: DataFrame, batches: int | None = None) -> DataFrame | None:
        """The indexed digests of all buckets that the digests of ``rows`` fall into; None for an empty index.

        Digests of later batches than ``batches`` are left out."""
        state = self.state()
        if state is None:
            return None
        count = state["batches"] if batches is None else batches
        parts = {name: state["bits"][name] for name in self.folders(count)}
        if state["base"] is not None:
            parts["base"] = state["base"]
        if not parts:
            return None
        most = max(parts.values())
        touched = rows.select(prefix(F.col(DIGEST), most).alias("bucket")).distinct().limit(NAMED_BUCKETS + 1).collect()
        found = []
        for name, bits in parts.items():
            part = rows.sparkSession.read.parquet(f"{self.root}/{name}")
            if len(touched) <= NAMED_BUCKETS:
                part = part.filter(F.col("bucket").isin(sorted({r["bucket"] >> (most - bits) for r in touched})))
            found.append(part.select(DIGEST))
        return reduce(DataFrame.unionByName, found)

    def unknown(self, rows: DataFrame, batches: int | None = None) -> DataFrame:
        """The rows whose digest the index does not hold."""
        known = self.near(rows, batches)
        return rows if known is None else unknown_rows(rows, known)


def load_unknown(new: DataFrame, index: DigestIndex, keys: Sequence[str] = STORED_KEY, text_col: str = "text") -> DataFrame:
    """New rows that the index does not know, with their digests; see ``DigestIndex.add`` to make them known.

    The rows are written to the shared folder with their digests, so each text is hashed once."""
    return index.unknown(stored(new.withColumn(DIGEST, row_digest(keys, text_col)), "fresh"))
