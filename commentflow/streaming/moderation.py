"""Continuous classification of incoming comments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from commentflow.operators.inference import ColumnPredictor, PredictorFactory, analyze_text
from commentflow.streaming.sinks import PRODUCTION_TRIGGER


def stream_moderation(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    predictor_factory: PredictorFactory | ColumnPredictor,
    key_cols: Sequence[str],
    event_time: str = "ts",
    delay: str = "10 minutes",
    text_col: str = "text",
    trigger: Mapping[str, object] = PRODUCTION_TRIGGER,
) -> StreamingQuery:
    """Classify every comment once and append the result with its flag to a Parquet sink.

    Repeats of a key are dropped while it is younger than the watermark delay, which bounds the
    state. Duplicates go before the model runs, so a repeated comment costs no inference.
    """
    once = stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key_cols))
    flagged = analyze_text(once, predictor_factory, text_col)
    return (
        flagged.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
