"""Latency parsing, history and statistics; latest state and its reports."""

from datetime import datetime, timedelta

import pytest

from greenwave.functions import elapsed_ms, parse_logged_time, parse_produced_at
from greenwave.operators.latency import latency_history, latency_summary, receive
from greenwave.operators.state import latest_state, lookup_state, state_counts, state_report


def history(spark, values):
    rows = [(float(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "e2e_latency_ms double, received_at long")


@pytest.mark.parametrize(
    "n, p95, p99", [(1, 1, 1), (20, 20, 20), (100, 96, 100), (1000, 951, 991), (39, 38, 39)]
)
def test_nearest_rank_percentiles(spark, n, p95, p99):
    row = latency_summary(history(spark, range(n, 0, -1))).first()
    assert (row.sample_count, row.p95_latency_ms, row.p99_latency_ms) == (n, p95, p99)
    assert (row.min_latency_ms, row.max_latency_ms) == (1, n)
    assert row.avg_latency_ms == (n + 1) / 2


def test_sla_is_strict_and_rounded(spark):
    row = latency_summary(history(spark, [2999.99, 3000.0, 10.0])).first()
    assert row.sla_3sec_compliance_pct == 66.67
    assert row.avg_latency_ms == 2003.33


def test_empty_history_gives_no_row(spark):
    assert latency_summary(history(spark, [])).count() == 0


def test_history_keeps_the_most_recent_known_values(spark):
    got = latency_history(history(spark, [5, -1, 7, 8, -3, 9]), size=3, arrival=("received_at",))
    assert [r.e2e_latency_ms for r in got.collect()] == [9, 8, 7]


def test_history_is_a_top_k_plan(spark):
    plan = latency_history(history(spark, [1]), arrival=("received_at",))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


LOGGED = [
    ("2024-03-24T10:15:32.123456", datetime(2024, 3, 24, 10, 15, 32, 123456)),
    ("2024-03-24 10:15:32.123456", datetime(2024, 3, 24, 10, 15, 32, 123456)),
    ("2024-03-24 10:15:32", datetime(2024, 3, 24, 10, 15, 32)),
    ("  2024-03-24 10:15:32\t", datetime(2024, 3, 24, 10, 15, 32)),
    ("2024-03-24T10:15:32.5", datetime(2024, 3, 24, 10, 15, 32, 500000)),
    ("2024-3-4T1:2:3", datetime(2024, 3, 4, 1, 2, 3)),
    ("2024-03-24 10:15:32\n", datetime(2024, 3, 24, 10, 15, 32)),
    ("2024-03-24T25:15:32", None),
    ("2024-03-24T10:15:60", None),
    ("2024-003-24T10:15:32", None),
    ("2024-03-24T10:15:32.1234567", None),
    ("2024-03-24", None),
    ("2024-03-24T10:15:32Z", None),
    ("2024-03-24  10:15:32", None),
    ("2024-03-24T10:15:32.", None),
    ("2024-13-24T10:15:32", None),
    ("2024-02-30T10:15:32", None),
    ("", None),
    (None, None),
]


def test_logged_times(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LOGGED)], "i int, t string")
    got = rows.selectExpr("i", f"{parse_logged_time('t')} AS p").orderBy("i").collect()
    assert [r.p for r in got] == [want for _, want in LOGGED]


def test_production_time_takes_no_fraction(spark):
    rows = spark.createDataFrame([("2024-03-24T10:15:32",), ("2024-03-24T10:15:32.5",)], "t string")
    got = rows.selectExpr(f"{parse_produced_at('t')} AS p").collect()
    assert [r.p for r in got] == [datetime(2024, 3, 24, 10, 15, 32), None]


@pytest.mark.parametrize(
    "micros, want", [(1850224, 1850.22), (1850225, 1850.23), (0, 0.0), (-500000, -500.0), (None, -1.0)]
)
def test_elapsed(spark, micros, want):
    start = datetime(2024, 1, 1)
    end = None if micros is None else start + timedelta(microseconds=micros)
    df = spark.createDataFrame([(end, start)], "a timestamp, b timestamp")
    assert df.selectExpr(f"{elapsed_ms('a', 'b')} AS ms").first().ms == want


def test_hop_latency_of_unreadable_time_is_unknown(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",), ("soon",), (None,)], "decision_timestamp string")
    got = receive(df, "TIMESTAMP '2024-01-01 00:00:02.5'").collect()
    assert [r.latency_ms for r in got] == [2500.0, -1.0, -1.0]


@pytest.fixture(scope="module")
def received(spark):
    rows = [
        ("B", 1, "w9", "DENSE", 30, 28.55, "HIGH", 60, 30, 4.0, 5.0),
        ("B", 3, "w1", "FLUID", 3, 31.26, "NONE", 20, 70, 4.0, -1.0),
        ("A", 2, "w2", None, None, None, None, None, None, -1.0, 6.0),
        (None, 2, "w2", "ODD", 1, 1.0, "ODD", 1, 1, 1.0, 1.0),
    ]
    return spark.createDataFrame(
        rows,
        "intersection_id string, received_at long, window_start string, traffic_mode string, "
        "total_vehicles long, avg_speed_kmh double, worst_severity string, green_duration_sec int, "
        "red_duration_sec int, latency_ms double, e2e_latency_ms double",
    )


def test_latest_state_is_by_arrival(received):
    state = {r.intersection_id: r.window_start for r in latest_state(received).collect()}
    assert state == {"A": "w2", "B": "w1", "UNKNOWN": "w2"}


def test_lookup_and_counts(received):
    state = latest_state(received)
    assert lookup_state(state, "B").first().traffic_mode == "FLUID"
    assert lookup_state(state, "nowhere").count() == 0
    assert state_counts(state).first()[0] == 3


def test_report(received):
    rows = state_report(latest_state(received)).collect()
    assert [r.intersection_id for r in rows] == ["A", "B", "UNKNOWN"]
    assert (rows[0].traffic_mode, rows[0].mode_symbol, rows[0].avg_speed_kmh) == ("?", "", 0.0)
    assert (rows[1].mode_symbol, rows[1].severity_symbol, rows[1].avg_speed_kmh) == ("🟢", "⚪", 31.3)
    assert (rows[2].mode_symbol, rows[2].severity_symbol) == ("", "")
