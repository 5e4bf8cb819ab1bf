"""Batch-numbered Parquet sinks.

Every micro-batch owns the directory ``batch_id=<n>`` and overwrites it, so a batch that is replayed
after a failure leaves the sink as one successful run would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PRODUCTION_TRIGGER = {"processingTime": "2 seconds"}


def write_batch(df: DataFrame, sink: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had closed their window, over the progress reports still held.

    Spark leaves such rows out of stateful results; a job that must not lose them compares this with zero."""
    return sum(state.numRowsDroppedByWatermark for report in query.recentProgress for state in report.stateOperators)


def read_sink(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """Everything written so far, with the partition column ``batch_id``."""
    if schema is None:
        return spark.read.parquet(sink)
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(sink)
