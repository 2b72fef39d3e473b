"""Incident streams: the plain feed, and the native join with window metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.operators.incidents import live_incidents
from greenwave.operators.metrics import window_metrics


def stream_incidents(incidents: DataFrame, delay: str = "1 second") -> DataFrame:
    """Watermarked incident feed for append mode.

    The watermark binds only where a stateful operator follows; the feed itself
    keeps incidents however late they are.
    """
    return incidents.withWatermark("event_time", delay)


def stream_interval_join(
    vehicles: DataFrame,
    incidents: DataFrame,
    length: str = "1 second",
    delay: str = "1 second",
    horizon: str = "8 hours",
) -> DataFrame:
    """Matching (window, incident) pairs as a native stream-stream join, append mode.

    A window is joined once it is closed, and incident state is dropped when the
    watermark has moved ``horizon`` past it. Under the default watermark policy
    pairs wait for the slower stream; set
    ``spark.sql.streaming.multipleWatermarkPolicy`` to ``max`` where incidents are
    rare. Windows without an incident do not appear: for a decision on every
    window use ``stream_decisions``.
    """
    metrics = window_metrics(
        vehicles.withWatermark("event_time", delay), length, with_event_time=True
    )
    reported = live_incidents(stream_incidents(incidents, delay)).selectExpr(
        "intersection_id AS _at_intersection",
        "event_id AS incident_event_id",
        "event_time AS incident_time",
        "severity AS incident_severity",
        "severity_rank AS incident_rank",
        "expires_at",
    )
    # ``window_time`` is one microsecond before the window's end.
    pairs = metrics.join(
        reported,
        F.expr(
            "intersection_id = _at_intersection "
            "AND incident_time <= window_time + INTERVAL 1 MICROSECOND "
            f"AND window_time + INTERVAL 1 MICROSECOND <= incident_time + INTERVAL {horizon}"
        ),
    )
    return pairs.filter("window_end <= expires_at").drop("_at_intersection", "window_time")
