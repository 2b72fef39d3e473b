"""Tumbling-window vehicle metrics per intersection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.functions import (
    FIXED_UNIT,
    beyond_fixed,
    hundredths,
    parse_produced_at,
    ratio_half_up,
    to_fixed,
)

#: Each part is divided once, so that a mean of integers is rounded once.
_MEAN = f"(speed_sum / ({FIXED_UNIT}D * nullif(speed_readings, 0)) + speed_rest / nullif(speed_readings, 0))"


def window_metrics(
    vehicles: DataFrame,
    length: str = "1 second",
    slide: str | None = None,
    extra: Sequence[str] = (),
    with_event_time: bool = False,
) -> DataFrame:
    """Vehicle total, mean speed and earliest production time per window and intersection.

    Works on batch and streaming input alike. All aggregation buffers are fixed
    width (the production time is parsed before the minimum is taken), so Spark
    uses hash aggregation with a map-side part and a hot intersection reaches the
    shuffle as at most one row per window and input partition.

    ``avg_speed_kmh`` is not weighted by vehicles. ``speed_sum`` (ten-thousandths),
    ``speed_rest`` (what that leaves: further decimals, and readings of a million or more) and
    ``speed_readings`` carry the mean for rounding: every reading counts. ``extra`` names
    further aggregates as ``"min(event_id) AS first_event_id"``. Production times
    that do not parse are ignored. ``with_event_time`` adds ``window_time``, the last
    instant of the window, which on a stream carries the watermark on.
    """
    produced = "produced_at"
    if dict(vehicles.dtypes)[produced] == "string":
        produced = parse_produced_at(produced)
    speed = to_fixed("average_speed_kmh")
    aggregates = [
        "sum(vehicle_count) AS total_vehicles",
        f"sum({speed}) AS speed_sum",
        "count(average_speed_kmh) AS speed_readings",
        f"sum({beyond_fixed('average_speed_kmh')}) AS speed_rest",
        f"min({produced}) AS min_produced_at",
        *extra,
    ]
    grouped = vehicles.groupBy(
        F.window("event_time", length, slide or length), "intersection_id"
    ).agg(*[F.expr(a) for a in aggregates])
    return grouped.selectExpr(
        "intersection_id",
        "window.start AS window_start",
        "window.end AS window_end",
        "total_vehicles",
        f"{_MEAN} AS avg_speed_kmh",
        "min_produced_at",
        "speed_sum",
        "speed_readings",
        "speed_rest",
        *grouped.columns[7:],
        *(["window_time(window) AS window_time"] if with_event_time else []),
    )


def rounded_speed(metrics: DataFrame) -> str:
    """Mean speed at two decimals, half up; 0 where no speed was read."""
    if {"speed_sum", "speed_readings"} <= set(metrics.columns):
        exact = ratio_half_up("speed_sum", f"speed_readings * {FIXED_UNIT // 100}")
        plain = f"coalesce({hundredths(exact)}, 0D)"
        if "speed_rest" not in metrics.columns:
            return plain
        return f"IF(coalesce(speed_rest, 0D) = 0D, {plain}, round({_MEAN}, 2))"
    return "coalesce(round(avg_speed_kmh, 2), 0D)"
