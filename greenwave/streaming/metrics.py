"""Window metrics on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from greenwave.operators.metrics import window_metrics


def stream_metrics(
    vehicles: DataFrame, length: str = "1 second", delay: str = "1 second"
) -> DataFrame:
    """Watermarked window metrics of decoded vehicle readings.

    In update mode a window is emitted whenever it changes and its last emission
    equals the batch result; in append mode it is emitted once, when the
    watermark has passed its end.
    """
    return window_metrics(vehicles.withWatermark("event_time", delay), length)
