"""Incident state: published vectors and brute force on random fixtures."""

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from greenwave.functions import SEVERITY_RANK
from greenwave.operators import fold
from greenwave.operators.fold import fold_incidents
from greenwave.operators.incidents import interval_join, severity_at

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
INCIDENTS = (
    "event_id string, intersection_id string, event_time timestamp, severity string, "
    "estimated_duration_min int, arrival_ts timestamp"
)


def minute(m):
    return START + timedelta(minutes=m)


def frame(spark, rows):
    """Rows of (intersection, minute, severity, duration[, arrival minute]) in arrival order."""
    full = [
        (f"{i:06d}", r[0], minute(r[1]), r[2], r[3], minute(r[4] if len(r) > 4 else r[1]))
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, INCIDENTS)


def points(spark, rows):
    return spark.createDataFrame(
        [(i, k, minute(m)) for i, (k, m) in enumerate(rows)],
        "point int, intersection_id string, window_end timestamp",
    )


VECTORS = [
    ([(0, "CRITICAL", 120), (5, "LOW", 10)], 10, "LOW", "CRITICAL"),
    ([(0, "CRITICAL", 120), (5, "LOW", 10)], 16, "NONE", "CRITICAL"),
    ([(5, "LOW", 30), (0, "HIGH", 60)], 10, "LOW", "HIGH"),
    ([(5, "HIGH", 30), (0, "LOW", 60)], 10, "HIGH", "HIGH"),
    ([(0, "HIGH", 30)], 30, "HIGH", "HIGH"),
    ([(0, "HIGH", 30)], 31, "NONE", "NONE"),
    ([(0, "HIGH", None)], 30, "HIGH", "HIGH"),
    ([(0, "HIGH", 0)], 30, "HIGH", "HIGH"),
    ([(0, "", 30)], 10, "NONE", "NONE"),
    ([(0, None, 30)], 10, "NONE", "NONE"),
    ([(0, "UNKNOWN_X", 30)], 10, "UNKNOWN_X", "NONE"),
    ([(0, "HIGH", -5)], 0, "NONE", "NONE"),
    ([(0, "HIGH", 60), (5, "LOW", -1)], 10, "HIGH", "HIGH"),
    ([(20, "HIGH", 60)], 10, "NONE", "NONE"),
    ([(0, "HIGH", 3000)], 2999, "HIGH", "HIGH"),
]


def test_lookup_vectors(spark):
    incidents = frame(
        spark, [(f"k{i}", *row) for i, (rows, *_) in enumerate(VECTORS) for row in rows]
    )
    at = points(spark, [(f"k{i}", v[1]) for i, v in enumerate(VECTORS)])
    got = severity_at(at, incidents).orderBy("point").collect()
    assert [(r.latest_severity, r.worst_severity) for r in got] == [v[2:] for v in VECTORS]


def test_fold_vectors(spark):
    """The fold differs from ``latest`` only where arrivals are out of order."""
    cases = [
        ([(0, "CRITICAL", 120, 0), (5, "LOW", 10, 5)], "LOW"),
        ([(5, "LOW", 30, 5), (0, "HIGH", 60, 6)], "HIGH"),
        ([(5, "HIGH", 30, 5), (0, "LOW", 60, 6)], "HIGH"),
        ([(0, "HIGH", 30, 31)], None),
        ([(10, "HIGH", 5, 10), (9, "LOW", 60, 16)], "LOW"),
        ([(10, "HIGH", 5, 10), (9, "LOW", 60, 15)], "HIGH"),
        ([(10, "HIGH", 60, 10), (10, "LOW", 60, 10)], "LOW"),
    ]
    rows = [(f"k{i}", *r) for i, (rs, _) in enumerate(cases) for r in rs]
    got = {r.intersection_id: r.severity for r in fold_incidents(frame(spark, rows)).collect()}
    assert got == {f"k{i}": want for i, (_, want) in enumerate(cases) if want}


def _random_incidents(rng, key, n, span):
    severities = ["LOW", "MEDIUM", "HIGH", "CRITICAL", "NONE", "", None, "ODD"]
    return [
        (key, rng.randrange(span), rng.choice(severities), rng.choice([None, 0, 5, 30, 90, 400]))
        for _ in range(n)
    ]


def _life(rows):
    """(start, sequence, severity, end) with defaults applied, minutes as the unit."""
    return [(r[1], i, r[2] or "NONE", r[1] + (r[3] or 30)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_severity_at_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    rows = [r for k in keys for r in _random_incidents(rng, k, 40, 2000)]
    at = [(rng.choice(["hot", "a", "b", "c", "none", None]), rng.randrange(2600)) for _ in range(600)]
    life = list(zip([r[0] for r in rows], _life(rows)))
    expected = []
    for key, m in at:
        mine = [v for k, v in life if k == key and v[0] <= m]
        last = max(mine) if mine else None
        latest = last[2] if last and last[3] >= m else "NONE"
        ranks = [SEVERITY_RANK.get(v[2], 0) for v in mine if v[3] >= m]
        worst = next(s for s, r in SEVERITY_RANK.items() if r == max(ranks, default=0))
        expected.append((latest, worst, bool(ranks)))
    for options in ({}, {"block": "15 minutes"}, {"grid": "1 minute", "block": "15 minutes"}):
        got = severity_at(points(spark, at), frame(spark, rows), **options).orderBy("point").collect()
        assert [(r.latest_severity, r.worst_severity, r.incident_active) for r in got] == expected


def test_grid_changes_nothing_for_points_on_it(spark):
    rng = random.Random(11)
    rows = [r for k in ("a", "b") for r in _random_incidents(rng, k, 150, 3000)]
    at = points(spark, [(rng.choice("ab"), 60 * rng.randrange(60)) for _ in range(200)])
    plain = severity_at(at, frame(spark, rows))
    assert sorted(plain.collect()) == sorted(severity_at(at, frame(spark, rows), grid="1 hour").collect())


@pytest.mark.parametrize("salts", [1, 3])
def test_interval_join_equals_brute_force(spark, salts):
    rng = random.Random(7)
    rows = [r for k in ("hot", "hot", "a") for r in _random_incidents(rng, k, 30, 1200)]
    rows.append(("a", 0, "LOW", 2000))
    at = [(rng.choice(["hot", "a", "none"]), rng.randrange(1500)) for _ in range(200)]
    life = list(zip([r[0] for r in rows], _life(rows)))
    expected = set()
    for i, (key, m) in enumerate(at):
        hits = [
            (i, f"{v[1]:06d}", v[2]) for k, v in life if k == key and v[0] <= m <= min(v[3], v[0] + 480)
        ]
        expected.update(hits or [(i, None, "NONE")])
    joined = interval_join(points(spark, at), frame(spark, rows), salts=salts).collect()
    got = [(r.point, r.incident_event_id, r.incident_severity) for r in joined]
    assert len(got) == len(set(got)) and set(got) == expected
    inner = interval_join(points(spark, at), frame(spark, rows), how="inner", salts=salts)
    assert inner.count() == sum(1 for e in expected if e[1])


def _fold(rows):
    state = None
    for at, _, time, severity, duration in sorted(rows):
        end = time + (duration or 30)
        if end < at:
            continue
        rank = SEVERITY_RANK.get(severity, 0)
        if state is None or state[2] < at or rank > state[0] or time >= state[1]:
            state = (rank, time, end, severity)
    return state


@pytest.mark.parametrize("partitions", [1, 6])
def test_fold_equals_sequential_replay(spark, partitions):
    """Late, out-of-order and expiring arrivals over stretches cut at any place."""
    rng = random.Random(partitions)
    rows = []
    for key, n, span in [("hot", 400, 300)] + [(f"k{i}", rng.randrange(1, 30), 200) for i in range(60)]:
        for _ in range(n):
            time = rng.randrange(span)
            severity = rng.choice(["LOW", "MEDIUM", "HIGH", "CRITICAL", "NONE"])
            rows.append((key, time, severity, rng.choice([5, 20, 60, 200]), time + rng.randrange(60)))
    for i in range(120):  # arrivals in reverse event order
        rows.append(("reversed", 500 - i, rng.choice(["LOW", "HIGH"]), 900, 500 + i))
    incidents = frame(spark, rows)
    got = {
        r.intersection_id: (r.severity_rank, r.event_time, r.expires_at, r.severity)
        for r in fold_incidents(incidents, partitions=partitions).collect()
    }
    for key in {r[0] for r in rows}:
        mine = [(r[4], i, r[1], r[2], r[3]) for i, r in enumerate(rows) if r[0] == key]
        want = _fold(mine)
        if want is None:
            assert key not in got
        else:
            naive = [t.replace(tzinfo=None) for t in (minute(want[1]), minute(want[2]))]
            assert got[key] == (want[0], *naive, want[3]), key


@pytest.mark.parametrize("stretch, lookups", [(1, 10), (7, 3), (64, 1_000_000)])
def test_fold_over_many_short_stretches(spark, monkeypatch, stretch, lookups):
    """Chains over many stretches, with arrivals that tie, expire late and outrank each other."""
    monkeypatch.setattr(fold, "STRETCH", stretch)
    monkeypatch.setattr(fold, "LOOKUPS", lookups)
    rng = random.Random(stretch)
    rows = []
    for key in ("a", "b", "c", "d"):
        for i in range(90):
            time = {"a": 300 - i, "b": rng.randrange(300), "c": i // 3, "d": 200 - i // 2}[key]
            severity = rng.choice(["LOW", "HIGH"]) if key != "a" else "LOW"
            rows.append((key, time, severity, rng.choice([400, 700]) if key != "c" else 5, 300 + i if key != "c" else i // 3))
    got = {
        r.intersection_id: (r.severity_rank, r.event_time, r.expires_at, r.severity)
        for r in fold_incidents(frame(spark, rows), partitions=3).collect()
    }
    for key in ("a", "b", "c", "d"):
        want = _fold([(r[4], i, r[1], r[2], r[3]) for i, r in enumerate(rows) if r[0] == key])
        naive = [t.replace(tzinfo=None) for t in (minute(want[1]), minute(want[2]))]
        assert got[key] == (want[0], *naive, want[3]), key


def test_first_place_of_at_least():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 7, 8, 9, 100):
        values = rng.integers(0, 20, size)
        start, bound = rng.integers(0, size + 1, 300), rng.integers(0, 22, 300)
        want = [next((k for k in range(s, size) if values[k] >= b), size) for s, b in zip(start, bound)]
        assert fold._first_at_least(start, bound, values).tolist() == want


def test_a_million_reversed_arrivals_of_one_intersection(spark, monkeypatch):
    """Nothing displaces anything: the first arrival stays, and no task holds more than a stretch."""
    monkeypatch.setattr(fold, "STRETCH", 50_000)
    n = 1_000_000
    incidents = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS event_id",
        "'hot' AS intersection_id",
        f"timestamp_seconds(1704067200 + {n} - id) AS event_time",
        "'LOW' AS severity",
        f"{2 * n} AS estimated_duration_min",
        f"timestamp_seconds(1704067200 + {n} + id) AS arrival_ts",
    )
    found = fold_incidents(incidents, partitions=8).collect()
    assert [(r.severity, r.event_time.timestamp()) for r in found] == [("LOW", 1704067200 + n)]


def test_fold_of_ordered_arrivals_is_the_latest(spark):
    rng = random.Random(3)
    times = {k: sorted(rng.sample(range(1000), 50)) for k in ("a", "b")}
    rows = [(k, t, rng.choice(["LOW", "HIGH", "CRITICAL"]), 60) for k, ts in times.items() for t in ts]
    folded = {r.intersection_id: r.severity for r in fold_incidents(frame(spark, rows)).collect()}
    at = points(spark, [(k, ts[-1]) for k, ts in times.items()])
    looked = {r.intersection_id: r.latest_severity for r in severity_at(at, frame(spark, rows)).collect()}
    assert folded == looked
