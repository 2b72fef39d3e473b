"""Reference enrichment and conformance of events to the published rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenwave.functions import (
    CAPACITY_REDUCTION,
    INCIDENT_TYPES,
    INTERSECTIONS,
    MIN_SPEED_KMH,
    density_class,
    hour_band,
    hour_factor,
)

_KNOWN_INTERSECTION = "intersection_id IN ({})".format(", ".join(f"'{i}'" for i in INTERSECTIONS))


def incident_type_table(spark: SparkSession) -> DataFrame:
    """The reference table of incident types (six rows) with the ranges of their severity."""
    rows = ", ".join(
        f"('{name}', '{severity}', {low}, {high}, {frequency}D, "
        f"{CAPACITY_REDUCTION[severity][0]}D, {CAPACITY_REDUCTION[severity][1]}D)"
        for name, (severity, low, high, frequency) in INCIDENT_TYPES.items()
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(incident_type, type_severity, min_duration, "
        "max_duration, type_frequency, min_capacity_reduction, max_capacity_reduction)"
    )


def enrich_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents with the reference values of their type; unknown types get NULLs.

    The table has a fixed six rows, hence the broadcast.
    """
    table = incident_type_table(incidents.sparkSession)
    return incidents.join(F.broadcast(table), "incident_type", "left")


# Rule name -> condition that holds; a value that is missing violates its rule.
INCIDENT_RULES = {
    "known_type": "type_severity IS NOT NULL",
    "known_intersection": _KNOWN_INTERSECTION,
    "severity_of_type": "severity = type_severity",
    "duration_in_range": "estimated_duration_min BETWEEN min_duration AND max_duration",
    "capacity_in_range": "capacity_reduction_factor "
    "BETWEEN min_capacity_reduction AND max_capacity_reduction",
    "lanes_by_severity": "CASE WHEN severity IN ('HIGH', 'CRITICAL') "
    "THEN lanes_blocked BETWEEN 1 AND 2 ELSE lanes_blocked = 0 END",
}

VEHICLE_RULES = {
    "known_intersection": _KNOWN_INTERSECTION,
    "count_not_negative": "vehicle_count >= 0",
    "speed_at_least_minimum": f"average_speed_kmh >= {MIN_SPEED_KMH}D",
    "density_matches_count": f"density_level = {density_class('vehicle_count')}",
}


def conformance_report(rows: DataFrame, rules: dict[str, str], stream: str) -> DataFrame:
    """Checked and violating rows per rule, counted in one pass over the data.

    Incident rules need the reference columns of ``enrich_incidents``.
    """
    counted = rows.agg(
        F.expr("count(*) AS checked"),
        *[F.expr(f"count_if(NOT coalesce({holds}, false)) AS {name}") for name, holds in rules.items()],
    )
    pairs = ", ".join(f"'{name}', {name}" for name in rules)
    return counted.selectExpr(
        f"'{stream}' AS stream",
        "checked",
        f"stack({len(rules)}, {pairs}) AS (rule, violations)",
    ).select("stream", "rule", "checked", "violations")


def with_density_class(vehicles: DataFrame) -> DataFrame:
    """Density class by count, and whether it agrees with the one the event carries."""
    return vehicles.selectExpr(
        "*", f"{density_class('vehicle_count')} AS density_class"
    ).selectExpr("*", "density_level <=> density_class AS density_agrees")


def with_hour_band(events: DataFrame, time: str = "event_time") -> DataFrame:
    """Density band of the hour and the range of factors expected in it."""
    return events.selectExpr("*", f"{hour_band(time)} AS hour_band").selectExpr(
        "*",
        f"{hour_factor('hour_band', 0)} AS min_factor",
        f"{hour_factor('hour_band', 1)} AS max_factor",
    )


def compose_event_id(prefix: str, intersection: str, time: str) -> str:
    """``<prefix>_<intersection>_<milliseconds>``."""
    return f"concat_ws('_', '{prefix}', {intersection}, unix_millis({time}))"


def incident_description(incident_type: str, intersection: str) -> str:
    return f"concat({incident_type}, ' signalé à ', {intersection})"
