"""A table that grows by numbered batches and stays in few folders.

Batch n, counted from 1, is merged with the levels 0, ..., t - 1 into level t, where t is the number of zero bits at the
end of n. So after n batches the rows lie in the levels that are the one bits of n: never more than log2(n) + 1 folders
are read, and a row is rewritten once for each level it rises.

A level has two sides, written in turn, so a batch never writes a folder that is read at its time: not by the merge
itself, nor by readers that began one batch earlier. The pointer tells how many batches are there; it too has two
sides. A merge that is interrupted before its pointer is published leaves the old state in place, and running the batch
again, before or after that, gives the same folders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from commentflow.sources.paths import parquet_or_none

_POINTER = "batches bigint, base int, bits map<string,int>"


class Leveled:
    """The folders below ``root``; ``merge`` makes one table of the rows of several batches, all rows by default."""

    def __init__(self, spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.root, self._merge = spark, root.rstrip("/"), merge

    # The pointer.

    def state(self) -> dict | None:
        """The last published state, or None before the first."""
        found = []
        for side in (0, 1):
            rows = parquet_or_none(self.spark, f"{self.root}/pointer-{side}", T.StructType.fromDDL(_POINTER))
            found += [] if rows is None else rows.collect()  # one row
        return max((r.asDict() for r in found), key=lambda r: r["batches"], default=None)

    def batches(self) -> int:
        return (self.state() or {"batches": 0})["batches"]

    def publish(self, batches: int, bits: dict[str, int], base: int | None) -> None:
        row = self.spark.createDataFrame([(batches, base, bits)], _POINTER)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/pointer-{batches % 2}")

    # The levels.

    @staticmethod
    def level_of(batch: int) -> int:
        return (batch & -batch).bit_length() - 1

    @staticmethod
    def folder(level: int, batches: int) -> str:
        """Where a level lies after so many batches, if it holds rows then."""
        return f"level-{level}-{(batches >> (level + 1)) & 1}"

    def folders(self, batches: int) -> list[str]:
        return [self.folder(k, batches) for k in range(batches.bit_length()) if batches >> k & 1]

    def read(self, batches: int | None = None) -> DataFrame | None:
        """All rows of the batches so far (or of the first ``batches``, as long as they lie there), None without any."""
        count = self.batches() if batches is None else batches
        parts = [self.spark.read.parquet(f"{self.root}/{name}") for name in self.folders(count)]
        if not parts:
            return None
        rows = reduce(DataFrame.unionByName, parts)
        return self._merge(rows) if self._merge else rows

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add batch ``batch``: the next one, or the last one again."""
        state = self.state() or {"batches": 0, "base": None, "bits": {}}
        if batch not in (state["batches"], state["batches"] + 1) or batch < 1:
            raise ValueError(f"batch {batch} does not follow {state['batches']}")
        level = self.level_of(batch)
        parts = [self._part(rows.sparkSession, name) for name in self.folders(batch - 1)[:level]]
        rows = reduce(DataFrame.unionByName, parts, rows)
        name = self.folder(level, batch)
        bits = dict(state["bits"])
        bits[name] = self._write(self._merge(rows) if self._merge else rows, f"{self.root}/{name}")
        self.publish(batch, bits, state["base"])

    def _part(self, spark: SparkSession, name: str) -> DataFrame:
        # A micro-batch has a session of its own.
        return spark.read.parquet(f"{self.root}/{name}")

    def _write(self, rows: DataFrame, path: str) -> int:
        rows.write.mode("overwrite").parquet(path)
        return 0
