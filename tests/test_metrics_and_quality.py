"""Window metrics, data-quality rules, and the shape of the plans."""

import math
from datetime import datetime

import pytest

from greenwave.operators.metrics import rounded_speed, window_metrics
from greenwave.operators.quality import (
    INCIDENT_RULES,
    VEHICLE_RULES,
    conformance_report,
    enrich_incidents,
    with_density_class,
    with_hour_band,
)
from greenwave.plans.catalog import QUERIES
from greenwave.sources.sinks import status_lines, write_topic
from greenwave.sources.topics import kafka_options, read_topic, stream_json_lines

T = datetime(2024, 1, 1, 8, 0, 0)
SF = "/root/testdata/sf0.001"


def readings(spark, rows):
    return spark.createDataFrame(
        rows,
        "event_time timestamp, intersection_id string, vehicle_count int, average_speed_kmh double, "
        "produced_at string",
    )


def test_metrics_of_one_window(spark):
    rows = [
        (T, "A", 4, 10.0, "2024-01-01T08:00:01"),
        (T, "A", None, 20.01, "2024-01-01T08:00:00"),
        (T, "A", 6, None, "rubbish"),
        (T, "A", 1, float("nan"), None),
        (T, "A", 1, 1e300, None),
        (T, "A", 0, -9e14, None),
        (T, "A", 0, float("inf"), None),
        (T, None, 2, 7.5, None),
    ]
    got = {r.intersection_id: r for r in window_metrics(readings(spark, rows)).collect()}
    a = got["A"]
    assert (a.total_vehicles, a.speed_sum, a.speed_readings) == (12, 300100, 6)
    assert math.isnan(a.avg_speed_kmh) and a.min_produced_at == T
    assert a.window_start == T and (a.window_end - a.window_start).total_seconds() == 1
    assert got[None].total_vehicles == 2 and got[None].min_produced_at is None


@pytest.mark.parametrize(
    "speeds, mean",
    [
        ((10.0, 20.01), 15.005),
        ((20.00004, 20.00004), 20.00004),
        ((0.1 + 0.2,), 0.1 + 0.2),
        ((33.333333333333336, 12.5, -0.0000001), (33.333333333333336 + 12.5 - 0.0000001) / 3),
        ((999_999.9999999, 1.0), 500_000.49999995),
        ((2_000_000.0, 30.0), 1_000_015.0),
        ((1e300, 1.0), 5e299),
        ((float("inf"), 1.0), float("inf")),
        ((float("inf"), float("-inf")), float("nan")),
        ((float("nan"), 1.0), float("nan")),
    ],
)
def test_every_speed_counts_as_in_a_plain_mean(spark, speeds, mean):
    frame = readings(spark, [(T, "A", 1, s, None) for s in speeds])
    row = window_metrics(frame).selectExpr("avg_speed_kmh AS own").first()
    plain = frame.selectExpr("avg(average_speed_kmh) AS own").first()
    for value in (row.own, plain.own):
        assert value == mean or math.isnan(mean) and math.isnan(value)
    rounded = window_metrics(frame).selectExpr(f"{rounded_speed(window_metrics(frame))} AS r").first().r
    assert rounded == pytest.approx(mean, abs=0.006, nan_ok=True)


def test_window_without_any_value(spark):
    row = window_metrics(readings(spark, [(T, "A", None, None, None)])).first()
    assert (row.total_vehicles, row.avg_speed_kmh, row.speed_readings) == (None, None, 0)


def test_sliding_and_longer_windows(spark):
    rows = [(T, "A", 1, 5.0, None), (T.replace(minute=30), "A", 2, 5.0, None)]
    assert window_metrics(readings(spark, rows), "1 hour").first().total_vehicles == 3
    assert window_metrics(readings(spark, rows), "1 hour", "30 minutes").count() == 3


def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_metrics_use_hash_aggregation_and_read_few_columns(spark):
    plan = _plan(spark, "window_metrics_1s")
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in plan


@pytest.mark.parametrize("name", ["decisions_latest", "decisions_worst", "worst_active_severity"])
def test_severity_needs_no_join_and_no_python(spark, name):
    plan = _plan(spark, name)
    for absent in ("Join", "CartesianProduct", "Python", "ArrowEval"):
        assert absent not in plan
    assert plan.count("FileScan") == 3  # readings, and incidents twice with one exchange reused


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream")])
def test_no_plan_has_a_cross_join(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hour_bands(spark):
    df = spark.range(24).selectExpr("timestamp_seconds(id * 3600) AS event_time")
    got = [r.hour_band for r in with_hour_band(df).orderBy("event_time").collect()]
    assert got == ["NIGHT"] * 6 + ["NORMAL"] + ["PEAK"] * 3 + ["NORMAL"] * 2 + ["MIDDAY"] * 3 + [
        "NORMAL"
    ] * 2 + ["PEAK"] * 3 + ["NORMAL"] * 4


def test_density_bounds(spark):
    df = spark.createDataFrame(
        [(10, "LOW"), (11, "LOW"), (20, "MEDIUM"), (21, "HIGH"), (None, None)],
        "vehicle_count int, density_level string",
    )
    got = [(r.density_class, r.density_agrees) for r in with_density_class(df).collect()]
    assert got == [("LOW", True), ("MEDIUM", False), ("MEDIUM", True), ("HIGH", True), (None, True)]


def test_conformance_counts_missing_values_as_violations(spark):
    incidents = spark.createDataFrame(
        [
            ("INT_GARE_NORD", "ACCIDENT", "HIGH", 15, 0.5, 1),
            ("INT_GARE_NORD", "ACCIDENT", "LOW", 61, 0.9, 0),
            ("elsewhere", "SPILL", "HIGH", 15, 0.5, 0),
            (None, None, None, None, None, None),
        ],
        "intersection_id string, incident_type string, severity string, estimated_duration_min int, "
        "capacity_reduction_factor double, lanes_blocked int",
    )
    report = conformance_report(enrich_incidents(incidents), INCIDENT_RULES, "incidents")
    assert {r.rule: (r.checked, r.violations) for r in report.collect()} == {
        "known_type": (4, 2),
        "known_intersection": (4, 2),
        "severity_of_type": (4, 3),
        "duration_in_range": (4, 3),
        "capacity_in_range": (4, 3),
        "lanes_by_severity": (4, 2),
    }
    vehicles = spark.createDataFrame(
        [("INT_GARE_NORD", 21, 5.0, "HIGH"), ("INT_GARE_NORD", -1, 4.99, "MEDIUM")],
        "intersection_id string, vehicle_count int, average_speed_kmh double, density_level string",
    )
    report = conformance_report(vehicles, VEHICLE_RULES, "vehicles")
    assert {r.rule: r.violations for r in report.collect()} == {
        "known_intersection": 0,
        "count_not_negative": 1,
        "speed_at_least_minimum": 1,
        "density_matches_count": 1,
    }


def test_topic_options():
    assert kafka_options("vehicles", "broker:1") == {
        "kafka.bootstrap.servers": "broker:1",
        "subscribe": "vehicles",
        "startingOffsets": "latest",
    }
    assert kafka_options("vehicles", "b", max_offsets_per_trigger=500)["maxOffsetsPerTrigger"] == "500"


def test_topic_reader_and_writers_are_built_like_the_file_ones(spark, tmp_path):
    """The connector is not installed here, so only the set-up can be checked."""
    with pytest.raises(Exception, match="kafka"):
        read_topic(spark, "vehicles", "broker:1")
    (tmp_path / "in").mkdir()
    stream = stream_json_lines(spark, str(tmp_path / "in")).selectExpr(
        "value AS intersection_id", "0L AS total_vehicles", "0D AS avg_speed_kmh", "'NONE' AS worst_severity",
        "'FLUID' AS traffic_mode", "20 AS green_duration_sec", "70 AS red_duration_sec", "'' AS window_start",
        "'' AS window_end", "'' AS decision_timestamp", "-1D AS e2e_latency_ms",
    )
    write_topic(stream, "traffic_decisions", "broker:1", str(tmp_path / "a"))
    query = status_lines(stream, str(tmp_path / "b")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
