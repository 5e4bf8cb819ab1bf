"""Running daily counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from commentflow.sources.leveled import Leveled
from commentflow.streaming.sinks import PRODUCTION_TRIGGER


def utc_instant(ntz: Column) -> Column:
    """Instant whose UTC clock shows a zone-less timestamp, whatever zone the session is in."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, ntz))


def utc_day(instant: Column) -> Column:
    days = F.floor(F.unix_seconds(instant) / 86400).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def running_daily_counts(
    stream: DataFrame, keys: Sequence[str], event_time: str = "ts", delay: str = "1 day"
) -> DataFrame:
    """Rows per UTC day and key. Days older than the watermark are closed and their state dropped."""
    day = F.window(event_time, "1 day")
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(day.alias("_window"), *keys)
        .agg(F.count("*").alias("total"))
        .select(utc_day(F.col("_window.start")).alias("crawl_date"), *keys, "total")
    )


def stream_daily_count(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    keys: Sequence[str] = ("platform",),
    event_time: str = "ts",
    delay: str = "1 day",
    trigger: Mapping[str, object] = PRODUCTION_TRIGGER,
) -> StreamingQuery:
    """Write the counts each micro-batch changed; ``latest_counts`` reads the current state back.

    The sink is merged as it grows: a count that a later batch replaced goes, and few folders are left."""
    table = count_table(stream.sparkSession, sink, keys)
    return (
        running_daily_counts(stream, keys, event_time, delay)
        .writeStream.outputMode("update")
        .foreachBatch(lambda changed, batch_id: table.add(changed.withColumn("batch_id", F.lit(batch_id).cast("bigint")), batch_id + 1))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def count_table(spark: SparkSession, sink: str, keys: Sequence[str]) -> Leveled:
    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("crawl_date", *keys).agg(F.max_by("total", "batch_id").alias("total"), F.max("batch_id").alias("batch_id"))

    return Leveled(spark, sink, newest)


def latest_counts(spark: SparkSession, sink: str, keys: Sequence[str] = ("platform",)) -> DataFrame:
    """Newest count of every day and key in the sink."""
    rows = count_table(spark, sink, keys).read()
    if rows is None:
        raise FileNotFoundError(f"{sink} holds no batch")
    return rows.drop("batch_id")
