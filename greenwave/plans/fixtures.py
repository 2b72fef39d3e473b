"""Vehicle, incident and decision inputs derived from the ``events`` table.

Errors become incidents and all other events vehicle readings. Derivations use
only integer arithmetic on columns, so that other SQL engines get the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from greenwave.functions import (
    DIRECTIONS,
    INCIDENT_TYPES,
    INTERSECTIONS,
    VEHICLE_TYPES,
    iso_seconds,
    literal,
)
from greenwave.operators.decisions import decide, decision_records
from greenwave.operators.incidents import severity_at
from greenwave.operators.latency import receive
from greenwave.operators.metrics import window_metrics
from greenwave.operators.quality import compose_event_id, incident_description

# k modulo 25 up to and including this value -> incident type.
TYPE_BY_K = [
    (4, "ACCIDENT"),
    (7, "TRAVAUX"),
    (15, "VEHICULE_EN_PANNE"),
    (17, "MANIFESTATION"),
    (18, "INONDATION"),
    (24, "CONTROLE_POLICE"),
]


EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _pick(values: list, index: str) -> str:
    """The value at a 0-based index; a constant array keeps the index evaluated once."""
    return f"array({', '.join(map(literal, values))})[CAST({index} AS INT)]"


_INTERSECTION = _pick(INTERSECTIONS, "user_id % 8")
_EVENT_TIME = "date_trunc('second', CAST(ts AS TIMESTAMP))"


def vehicles_from(events: DataFrame) -> DataFrame:
    """Vehicle readings; works on a batch or a stream of events."""
    return events.filter("event_type <> 'error'").selectExpr(
        "event_id",
        f"{_EVENT_TIME} AS event_time",
        f"{_EVENT_TIME} AS produced_at",
        f"{_INTERSECTION} AS intersection_id",
        f"{_pick(DIRECTIONS, 'event_id % 4')} AS direction",
        "CAST(event_id * 7 % 16 AS INT) AS vehicle_count",
        f"{_pick(VEHICLE_TYPES, 'greatest(event_id % 10 - 5, 0)')} AS vehicle_type",
        "(500 + event_id * 37 % 4000) / 100D AS average_speed_kmh",
        "CASE WHEN event_id % 17 = 0 OR event_id * 7 % 16 > 10 THEN 'MEDIUM' ELSE 'LOW' END"
        " AS density_level",
    )


def incidents_from(events: DataFrame) -> DataFrame:
    """Incidents; works on a batch or a stream of events.

    The type comes from ``inline``, which reads each JSON text once: through a
    plain projection the optimizer would copy the parse into every later filter.
    """
    kinds = [next(name for last, name in TYPE_BY_K if k <= last) for k in range(25)]
    rows = ", ".join(
        "struct({} AS incident_type, {} AS severity, {} AS _low, {} AS _high)".format(
            *map(literal, (kind, *INCIDENT_TYPES[kind][:3]))
        )
        for kind in kinds
    )
    k = "CAST(get_json_object(props, '$.k') AS INT) % 25"
    typed = events.filter("event_type = 'error'").selectExpr(
        "event_id", "ts", "user_id", f"inline(array(array({rows})[{k}]))"
    )
    return typed.selectExpr(
        "event_id",
        f"{_EVENT_TIME} AS event_time",
        f"{_INTERSECTION} AS intersection_id",
        "incident_type",
        "severity",
        "CAST(_low + event_id % (_high - _low + 1) AS INT) AS estimated_duration_min",
        "(10 + event_id % 91) / 100D AS capacity_reduction_factor",
        "CAST(if(severity IN ('HIGH', 'CRITICAL'), 1 + event_id % 2, event_id % 11 % 2) AS INT)"
        " AS lanes_blocked",
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicles_from(read_events(spark, sf_dir))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents_from(read_events(spark, sf_dir))


# Damage done to the payloads of some events, so that decoding has something to reject.
SPOILED = r"""CASE event_id % 100
  WHEN 1 THEN 'not json'
  WHEN 2 THEN '{"a":'
  WHEN 3 THEN '{}'
  WHEN 4 THEN '[]'
  WHEN 5 THEN regexp_replace(json, '"timestamp":"[^"]*"', '"timestamp":"bad"')
  WHEN 6 THEN regexp_replace(json, '("timestamp":"[^"]*)"', '$1Z"')
  WHEN 7 THEN regexp_replace(json, '"intersection_id":"[^"]*",?', '')
  WHEN 8 THEN regexp_replace(json, '[}]$', ',"extra":1}')
  ELSE json END"""


def _payloads(rows: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    identity = f"{compose_event_id(prefix, 'intersection_id', 'event_time')} AS event_id"
    json = f"to_json(struct({identity}, {iso_seconds('event_time')} AS timestamp, {', '.join(columns)}))"
    return rows.selectExpr("event_id", f"{json} AS json").selectExpr(
        f"CAST({SPOILED} AS BINARY) AS value"
    )


def vehicle_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle readings as they travel: JSON text in a binary ``value``, some damaged."""
    return _payloads(
        vehicles(spark, sf_dir),
        "VEH",
        [
            f"{iso_seconds('produced_at')} AS produced_at",
            "intersection_id",
            "direction",
            "vehicle_count",
            "vehicle_type",
            "average_speed_kmh",
            "density_level",
        ],
    )


def incident_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payloads(
        incidents(spark, sf_dir),
        "INC",
        [
            "intersection_id",
            "incident_type",
            "severity",
            "estimated_duration_min",
            "capacity_reduction_factor",
            "lanes_blocked",
            f"{incident_description('incident_type', 'intersection_id')} AS description",
        ],
    )


DECIDED_AT = "timestamp_seconds(unix_seconds(window_end) + first_event_id % 5)"
RECEIVED_AT = (
    "timestamp_millis(unix_millis(CAST(decision_timestamp AS TIMESTAMP)) + first_event_id % 700)"
)


def decided(spark: SparkSession, sf_dir: str, length: str = "1 second") -> DataFrame:
    """Decision records with repeatable decision times, plus ``first_event_id``."""
    metrics = window_metrics(
        vehicles(spark, sf_dir), length, extra=["min(event_id) AS first_event_id"]
    )
    found = severity_at(
        metrics, incidents(spark, sf_dir), grid=length, want=("latest_severity",)
    )
    plans = decide(found, "latest_severity")
    return decision_records(plans, DECIDED_AT, keep=("first_event_id",))


def received(spark: SparkSession, sf_dir: str, length: str = "1 second") -> DataFrame:
    """Decisions as the receiving side sees them, with repeatable arrival times."""
    return receive(decided(spark, sf_dir, length), RECEIVED_AT)


def reading_records(events: DataFrame) -> DataFrame:
    """A decision record for every single vehicle reading, with an arrival that is out of order.

    Works on a batch or a stream of events.
    """
    readings = vehicles_from(events).selectExpr(
        "intersection_id",
        "event_time AS window_start",
        "event_time + INTERVAL 1 SECOND AS window_end",
        "CAST(vehicle_count AS BIGINT) AS total_vehicles",
        "average_speed_kmh AS avg_speed_kmh",
        "'NONE' AS worst_severity",
        "produced_at AS min_produced_at",
        "timestamp_seconds(unix_seconds(event_time) + event_id * 7919 % 7200) AS received_at",
    )
    return decision_records(decide(readings), "window_end", keep=("received_at",))
