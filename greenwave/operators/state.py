"""Latest decision per intersection and the reports built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.functions import mode_symbol, severity_symbol

ARRIVAL = ("received_at", "window_start")


def latest_state(received: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The decision that arrived last for each intersection, which need not be its last window.

    A maximum over structs led by the arrival order: one row per intersection
    leaves each input partition, however hot the key. Usable on a stream in
    update or complete mode. ``arrival`` must order the rows of an intersection
    without ties. Records without an intersection count as ``UNKNOWN``, the name
    ``decode_decisions`` gives them; it is set after grouping so that an existing
    order by intersection saves the sort.
    """
    rest = [c for c in received.columns if c not in arrival and c != "intersection_id"]
    return (
        received.groupBy("intersection_id")
        .agg(F.max(F.struct(*arrival, *rest)).alias("_latest"))
        .selectExpr(
            *[
                "coalesce(intersection_id, 'UNKNOWN') AS intersection_id"
                if c == "intersection_id"
                else f"_latest.{c}"
                for c in received.columns
            ]
        )
    )


def lookup_state(state: DataFrame, intersection_id: str) -> DataFrame:
    """State of one intersection; an empty result means it is not known."""
    return state.filter(F.col("intersection_id") == intersection_id)


def state_counts(state: DataFrame) -> DataFrame:
    return state.agg(F.count_distinct("intersection_id").alias("intersections_monitored"))


def state_report(state: DataFrame) -> DataFrame:
    """Dashboard rows ordered by intersection: symbols attached, speed at one decimal."""
    return state.selectExpr(
        "intersection_id",
        f"{mode_symbol('traffic_mode')} AS mode_symbol",
        "coalesce(traffic_mode, '?') AS traffic_mode",
        "total_vehicles",
        "round(coalesce(avg_speed_kmh, 0D), 1) AS avg_speed_kmh",
        f"{severity_symbol('worst_severity')} AS severity_symbol",
        "coalesce(worst_severity, '?') AS worst_severity",
        "green_duration_sec",
        "red_duration_sec",
        "latency_ms",
        "e2e_latency_ms",
    ).orderBy("intersection_id")
