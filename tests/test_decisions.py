"""Boundary vectors of the signal rule, and the forms a decision is published in."""

import json

import pytest

from greenwave.functions import SignalRules
from greenwave.operators.decisions import decide, decision_records, keyed_json, receipt_line, status_line
from greenwave.operators.latency import receive

CASES = [
    (24, 28.5, "NONE", "DENSE", 60, 30),
    (10, 30.0, "NONE", "FLUID", 20, 70),
    (11, 30.0, "NONE", "MODERATE", 40, 50),
    (20, 30.0, "HIGH", "MODERATE", 40, 50),
    (21, 30.0, "NONE", "DENSE", 60, 30),
    (10, 30.0, "HIGH", "FLUID", 20, 70),
    (0, 14.99, "NONE", "CONGESTION", 60, 30),
    (0, 15.0, "NONE", "FLUID", 20, 70),
    (0, 14.996, "NONE", "FLUID", 20, 70),
    (50, 5.0, "CRITICAL", "EMERGENCY", 5, 85),
    (None, 30.0, "NONE", "FLUID", 20, 70),
    (30, None, "NONE", "CONGESTION", 60, 30),
    (15, 30.0, "UNKNOWN_X", "MODERATE", 40, 50),
    (15, 30.0, None, "MODERATE", 40, 50),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(i, *case[:3]) for i, case in enumerate(CASES)]
    return spark.createDataFrame(
        rows, "case int, total_vehicles long, avg_speed_kmh double, worst_severity string"
    )


def _plans(df):
    rows = df.orderBy("case").collect()
    return [(r.traffic_mode, r.green_duration_sec, r.red_duration_sec) for r in rows]


def test_boundary_vectors(cases):
    assert _plans(decide(cases)) == [case[3:] for case in CASES]


def test_exact_mean_is_rounded_before_the_threshold(spark):
    rows = [(0, 1, 149960, 1), (1, 1, 149949, 1), (2, 1, 2 * 150000 - 101, 2), (3, 1, None, 0)]
    metrics = spark.createDataFrame(
        [(c, t, 0.0, "NONE", s, n) for c, t, s, n in rows],
        "case int, total_vehicles long, avg_speed_kmh double, worst_severity string, "
        "speed_sum long, speed_readings long",
    )
    got = decide(metrics).orderBy("case").collect()
    assert [(r.avg_speed_kmh, r.traffic_mode) for r in got] == [
        (15.0, "FLUID"),
        (14.99, "CONGESTION"),
        (14.99, "CONGESTION"),
        (0.0, "CONGESTION"),
    ]


def test_green_and_red_fill_the_cycle(cases):
    rules = SignalRules(cycle_seconds=120)
    assert all(green + red == 120 for _, green, red in _plans(decide(cases, rules=rules)))


def test_other_weights_let_severity_raise_the_mode(spark):
    rules = SignalRules(severity_malus={"HIGH": 30, "MEDIUM": 15}, override="NEVER")
    rows = spark.createDataFrame(
        [(0, 15, 30.0, "HIGH"), (1, 5, 30.0, "HIGH"), (2, 15, 30.0, "MEDIUM"), (3, 5, 30.0, "CRITICAL")],
        "case int, total_vehicles long, avg_speed_kmh double, worst_severity string",
    )
    assert [p[0] for p in _plans(decide(rows, rules=rules))] == ["DENSE", "MODERATE", "MODERATE", "FLUID"]


@pytest.fixture(scope="module")
def record(spark):
    metrics = spark.sql(
        "SELECT 'INT_CENTRE_VILLE' AS intersection_id, TIMESTAMP '2024-03-24 10:15:32' AS window_start, "
        "TIMESTAMP '2024-03-24 10:15:33' AS window_end, 24L AS total_vehicles, 28.5D AS avg_speed_kmh, "
        "'NONE' AS worst_severity, TIMESTAMP '2024-03-24 10:15:32' AS min_produced_at"
    )
    return decision_records(decide(metrics), "TIMESTAMP '2024-03-24 10:15:33.850224'")


def test_status_line_matches_the_published_sample(record):
    assert record.selectExpr(f"{status_line()} AS line").first().line == (
        "[Spark] ORANGE INT_CENTRE_VILLE | DENSE | Veh:24 | 28.5km/h | Sev:NONE | "
        "Vert:60s Rouge:30s | Latence E2E:1850.22ms"
    )


def test_unknown_latency_shows_as_not_available(record):
    unknown = record.selectExpr("* EXCEPT (e2e_latency_ms)", "-1D AS e2e_latency_ms")
    assert unknown.selectExpr(f"{status_line()} AS line").first().line.endswith("Latence E2E:N/A")


def test_large_latency_prints_without_exponent(record):
    late = record.selectExpr("* EXCEPT (e2e_latency_ms)", "12345678.5D AS e2e_latency_ms")
    assert late.selectExpr(f"{status_line()} AS line").first().line.endswith("E2E:12345678.5ms")


def test_receipt_line(record):
    got = receive(record, "TIMESTAMP '2024-03-24 10:15:33.250'")
    assert got.selectExpr(f"{receipt_line()} AS line").first().line == (
        "[DecisionService] 🟠 INT_CENTRE_VILLE | Mode: DENSE | Vert: 60s | Véhicules: 24 | "
        "Latence Kafka: 250.0ms | Latence E2E: 1850.22ms"
    )


def test_json_keeps_field_order_and_nulls(record):
    row = keyed_json(record.selectExpr("* EXCEPT (intersection_id)", "CAST(NULL AS STRING) AS intersection_id")).first()
    value = json.loads(row.value)
    assert row.key is None and value["intersection_id"] is None
    assert list(value) == [
        "intersection_id",
        "window_start",
        "window_end",
        "total_vehicles",
        "avg_speed_kmh",
        "worst_severity",
        "traffic_mode",
        "green_duration_sec",
        "red_duration_sec",
        "decision_timestamp",
        "e2e_latency_ms",
    ]
    assert value["window_end"] == "2024-03-24T10:15:33" and value["decision_timestamp"] == "2024-03-24T10:15:33"


def test_record_without_production_time_has_unknown_latency(spark, record):
    metrics = spark.sql(
        "SELECT 'a' AS intersection_id, TIMESTAMP '2024-03-24 10:15:32' AS window_start, "
        "TIMESTAMP '2024-03-24 10:15:33' AS window_end, 1L AS total_vehicles, 28.5D AS avg_speed_kmh, "
        "'NONE' AS worst_severity, CAST(NULL AS TIMESTAMP) AS min_produced_at"
    )
    assert decision_records(decide(metrics)).first().e2e_latency_ms == -1
