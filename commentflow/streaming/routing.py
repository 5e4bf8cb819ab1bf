"""Streams that lose no row: late and repeated rows go to a sink of their own.

Spark's own de-duplication drops rows behind the watermark and repeats of a key without a trace. Here a stateful
processor sees every row: a key's first row is kept and remembered until the watermark has passed it by the delay, at
which an event-time timer clears it. Rows in = rows kept + rows repeated + rows late.

All rows of a key in a micro-batch meet in one task, one at a time; the source's ``maxFilesPerTrigger`` bounds them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from commentflow.functions.text import strip_space
from commentflow.operators.inference import ColumnPredictor, PredictorFactory, analyze_text
from commentflow.streaming.sinks import PRODUCTION_TRIGGER, write_batch

KEPT, REPEATED, LATE = "kept", "repeated", "late"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfKey(StatefulProcessor):
    """Marks each row of a key as kept, repeated or late. Rows without an event time are never late."""

    def __init__(self, names: list[str], time_at: int, delay_ms: int):
        self.out, self.time_at, self.delay_ms = Row(*names, "route"), time_at, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark, known = timerValues.getCurrentWatermarkInMs(), None
        for row in rows:
            at = row[self.time_at]
            if at is not None and at <= watermark:
                yield self.out(*row, LATE)
                continue
            if known is None:  # every call to the state costs a round trip
                known = self._held(watermark)
            if known:
                route = REPEATED
            else:
                route, known = KEPT, True
                # A row without a time counts as one at the watermark.
                seen = max(watermark, 0) if at is None else at
                self.first.update((seen,))
                self.handle.registerTimer(seen + self.delay_ms)
            yield self.out(*row, route)

    def _held(self, watermark: int) -> bool:
        """Whether the key's first row is not yet behind the watermark by the delay; timers fire after the rows of a batch.

        A first row that is behind gives way, and so does its timer: what a timer finds is its own."""
        first = self.first.get()
        if first is None:
            return False
        if first[0] + self.delay_ms > watermark:
            return True
        self.handle.deleteTimer(first[0] + self.delay_ms)
        self.first.clear()
        return False

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.first.clear()
        return iter([])


def delay_ms(spark: SparkSession, delay: str) -> int:
    """Milliseconds of an interval such as ``10 minutes``."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    span = F.timestamp_diff("MILLISECOND", zero, zero + F.expr(f"interval {delay}"))
    return spark.range(1).select(span).first()[0]


def route(stream: DataFrame, key_cols: Sequence[str], event_time: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """The stream's rows with ``route``: kept, repeated or late."""
    timed = stream.withWatermark(event_time, delay)
    # The stateful operator sees a copy of the time that is not marked as event time, or Spark would drop late rows before it.
    plain = timed.select(
        *[c if c != event_time else F.timestamp_micros(F.unix_micros(F.col(c))).alias(c) for c in stream.columns],
        F.unix_millis(event_time).alias("_at"))
    schema = T.StructType([*plain.schema.fields, T.StructField("route", T.StringType())])
    processor = FirstOfKey(plain.columns, len(plain.columns) - 1, delay_ms(stream.sparkSession, delay))
    return plain.groupBy(*key_cols).transformWithState(processor, schema, "append", "eventTime").drop("_at")


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which large states and stateful processors need."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def stream_moderation_routed(
    stream: DataFrame,
    sink: str,
    rest: str,
    checkpoint: str,
    predictor_factory: PredictorFactory | ColumnPredictor,
    key_cols: Sequence[str],
    event_time: str = "ts",
    delay: str = "10 minutes",
    text_col: str = "text",
    trigger: Mapping[str, object] = PRODUCTION_TRIGGER,
) -> StreamingQuery:
    """Classify every comment once, into ``sink``; repeated and late ones go to ``rest`` with their route.

    Both are batch-numbered sinks, so a batch that is replayed leaves them as one run would. Blank comments are no input."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        kept = held.filter(F.col("route") == KEPT).drop("route")
        write_batch(analyze_text(kept, predictor_factory, text_col), sink, batch_id)
        write_batch(held.filter(F.col("route") != KEPT), rest, batch_id)
        held.unpersist()

    routed = route(stream.filter(strip_space(F.col(text_col)) != ""), key_cols, event_time, delay)
    with rocksdb(stream.sparkSession):
        return (
            routed.writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
