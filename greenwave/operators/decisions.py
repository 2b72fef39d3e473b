"""Signal decisions from window metrics, and their record, JSON and log-line forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.functions import (
    SignalRules,
    elapsed_ms,
    green_seconds,
    iso_seconds,
    mode_label,
    mode_symbol,
    plain_decimal,
    traffic_mode,
)
from greenwave.operators.metrics import rounded_speed
from greenwave.schemas import DECISION


def decide(
    metrics: DataFrame, severity: str = "worst_severity", rules: SignalRules = SignalRules()
) -> DataFrame:
    """Metrics with a severity column to signal plans; every expression is native.

    Missing totals and speeds become 0, and the speed is rounded to two decimals
    before it meets the threshold.
    """
    replaced = {
        "total_vehicles": "coalesce(total_vehicles, 0L)",
        "avg_speed_kmh": rounded_speed(metrics),
        "worst_severity": f"coalesce({severity}, 'NONE')",
    }
    spent = {"speed_sum", "speed_readings", "speed_rest", *replaced}
    mode = traffic_mode("total_vehicles", "avg_speed_kmh", "worst_severity", rules)
    return (
        metrics.selectExpr(
            *[c for c in metrics.columns if c not in spent],
            *[f"{expression} AS {name}" for name, expression in replaced.items()],
        )
        .selectExpr("*", f"{mode} AS traffic_mode")
        .selectExpr("*", f"{green_seconds('traffic_mode', rules)} AS green_duration_sec")
        .selectExpr("*", f"{rules.cycle_seconds} - green_duration_sec AS red_duration_sec")
    )


def decision_records(
    decisions: DataFrame, decided_at: str = "current_timestamp()", keep: Sequence[str] = ()
) -> DataFrame:
    """Decisions in the published record layout, times as ISO text.

    ``decided_at`` is the decision time as an expression; by default the time the
    query (or the micro-batch) runs. ``keep`` names further columns to pass on.
    """
    return decisions.selectExpr("*", f"{decided_at} AS _decided").selectExpr(
        "intersection_id",
        f"{iso_seconds('window_start')} AS window_start",
        f"{iso_seconds('window_end')} AS window_end",
        "total_vehicles",
        "avg_speed_kmh",
        "worst_severity",
        "traffic_mode",
        "green_duration_sec",
        "red_duration_sec",
        f"{iso_seconds('_decided')} AS decision_timestamp",
        f"{elapsed_ms('_decided', 'min_produced_at')} AS e2e_latency_ms",
        *keep,
    )


def keyed_json(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``key`` (intersection) and ``value`` (the whole record as JSON, nulls kept)."""
    return records.select(
        F.col("intersection_id").alias("key"),
        F.to_json(F.struct(*DECISION.fieldNames()), {"ignoreNullFields": "false"}).alias("value"),
        *keep,
    )


def status_line(tag: str = "[Spark]") -> str:
    """Log line of the deciding job, as expression text; an unknown latency shows as N/A.

    Fixed values: the wording and order of its parts.
    """
    latency = (
        f"CASE WHEN e2e_latency_ms >= 0 THEN {plain_decimal('e2e_latency_ms')} || 'ms' "
        "ELSE 'N/A' END"
    )
    return (
        f"'{tag} ' || {mode_label('traffic_mode')} || ' ' || coalesce(intersection_id, 'None')"
        " || ' | ' || traffic_mode || ' | Veh:' || total_vehicles"
        f" || ' | ' || {plain_decimal('avg_speed_kmh')} || 'km/h | Sev:' || worst_severity"
        " || ' | Vert:' || green_duration_sec || 's Rouge:' || red_duration_sec"
        f" || 's | Latence E2E:' || {latency}"
    )


def receipt_line(tag: str = "[DecisionService]") -> str:
    """Log line of the receiving side, as expression text, with both latencies.

    Fixed values: the wording and order of its parts.
    """

    def text(name: str) -> str:
        return f"coalesce(CAST({name} AS STRING), 'None')"

    def number(name: str) -> str:
        return f"CASE WHEN {name} = -1 THEN '-1' ELSE {plain_decimal(name)} END"

    return (
        f"'{tag} ' || {mode_symbol('traffic_mode', default='⚪')} || ' ' || intersection_id"
        " || ' | Mode: ' || coalesce(traffic_mode, '?')"
        f" || ' | Vert: ' || {text('green_duration_sec')}"
        f" || 's | Véhicules: ' || {text('total_vehicles')}"
        f" || ' | Latence Kafka: ' || {number('latency_ms')}"
        f" || 'ms | Latence E2E: ' || {number('e2e_latency_ms')} || 'ms'"
    )
