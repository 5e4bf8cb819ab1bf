"""Continuous version of the incremental load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from commentflow.operators.joins import DIGEST, STORED_KEY, digests, row_digest
from commentflow.sources.digest_index import ROWS_PER_BUCKET, DigestIndex
from commentflow.streaming.sinks import PRODUCTION_TRIGGER, write_batch


def stream_ingest_dedup(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    stored: DataFrame | None = None,
    keys: Sequence[str] = STORED_KEY,
    text_col: str = "text",
    trigger: Mapping[str, object] = PRODUCTION_TRIGGER,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> StreamingQuery:
    """Append rows whose key is neither in ``stored`` nor in an earlier batch of the sink.

    An index of digests lies beside the sink's batches. It starts with the digests of ``stored``, which is read only
    when the index is made; every batch reads the buckets its own digests fall into, whatever the size of store and
    sink, and adds its digests. A batch compares itself with lower batch numbers only, so replaying it gives the same
    rows.
    """
    index = DigestIndex(stream.sparkSession, f"{sink}/_digests", rows_per_bucket)
    if stored is not None and index.state() is None:
        index.build(digests(stored, keys, text_col))

    def load(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.withColumn(DIGEST, row_digest(keys, text_col)).persist()
        write_batch(index.unknown(fresh, batch_id), sink, batch_id)
        written = batch.sparkSession.read.parquet(f"{sink}/batch_id={batch_id}")
        index.add(written.select(DIGEST), batch_id + 1)
        fresh.unpersist()

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
