"""Streams against batch results, over several micro-batches, restarts and late rows."""

import json
import os
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from greenwave.operators.decisions import decide
from greenwave.operators.decode import decode_incidents, decode_vehicles
from greenwave.operators.incidents import interval_join, severity_at
from greenwave.operators.latency import latency_history, latency_summary
from greenwave.operators.metrics import window_metrics
from greenwave.sources.batches import append_batches, last_emission, read_batches
from greenwave.sources.topics import read_json_lines, stream_json_lines
from greenwave.streaming import decisions
from greenwave.streaming.decisions import still_needed, severities, stream_decisions, stream_severities
from greenwave.streaming.incidents import stream_incidents, stream_interval_join
from greenwave.streaming.jobs import counted, run_available, run_slices, start_decision_job, start_monitor_job
from greenwave.streaming.metrics import stream_metrics

T0 = datetime(2024, 1, 1, 8, 0, 0)
KEYS = ["A", "B", "C"]


def iso(second):
    return (T0 + timedelta(seconds=second)).strftime("%Y-%m-%dT%H:%M:%S")


def vehicle(second, key, count, speed=30.0):
    return json.dumps({
        "event_id": f"VEH_{key}_{second}", "timestamp": iso(second), "produced_at": iso(second),
        "intersection_id": key, "vehicle_count": count, "average_speed_kmh": speed,
    })


def incident(second, key, severity, minutes):
    return json.dumps({
        "event_id": f"INC_{key}_{second:06d}", "timestamp": iso(second), "intersection_id": key,
        "severity": severity, "estimated_duration_min": minutes,
    })


class Feed:
    """A folder per topic that receives one file per micro-batch."""

    def __init__(self, root):
        self.root = root
        self.files = 0
        for topic in ("vehicles", "incidents"):
            (root / topic).mkdir()

    def add(self, vehicles=(), incidents=()):
        self.files += 1
        for topic, lines in (("vehicles", vehicles), ("incidents", incidents)):
            file = self.root / topic / f"{self.files:04d}.txt"
            file.write_text("\n".join([*lines, ""]))
            # File sources read in order of modification time.
            os.utime(file, (1_700_000_000 + self.files, 1_700_000_000 + self.files))

    def path(self, topic):
        return str(self.root / topic)


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path)


def drain(spark, stream, mode, folder):
    """Run one query over what is there, keeping its checkpoint in ``folder``."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(append_batches(f"{folder}/rows"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_batches(spark, f"{folder}/rows")


def streams(spark, feed):
    return (
        decode_vehicles(stream_json_lines(spark, feed.path("vehicles"), 1)),
        decode_incidents(stream_json_lines(spark, feed.path("incidents"), 1)),
    )


def batch_decisions(spark, feed, severity="latest_severity"):
    metrics = window_metrics(decode_vehicles(read_json_lines(spark, feed.path("vehicles"))), "10 seconds")
    incidents = decode_incidents(read_json_lines(spark, feed.path("incidents")))
    return facts(decide(severity_at(metrics, incidents), severity))


def facts(decisions):
    return {
        (r.intersection_id, (r.window_end - T0).seconds): (
            r.total_vehicles, r.avg_speed_kmh, r.worst_severity, r.traffic_mode,
        )
        for r in decisions.collect()
    }


def fill_in_order(feed, batches=4):
    """In-order input: every file holds a later stretch of time."""
    for b in range(batches):
        start = 100 * b
        feed.add(
            [vehicle(start + s, k, (s * 7 + i) % 9, 10 + (s + i) % 40) for s in range(0, 100, 3) for i, k in enumerate(KEYS)],
            [incident(start + 5, "A", ["HIGH", "CRITICAL", "LOW", "MEDIUM"][b % 4], 3),
             incident(start + 40, "A", "LOW", 1),
             *[incident(start + 61 + i, "C", sev, m) for i, (sev, m) in enumerate(
                 [("LOW", 2), ("HIGH", 1), ("LOW", 1), ("CRITICAL", 1), ("MEDIUM", 3)])],
             incident(start + 50, "B", "CRITICAL", 1)],
        )


def test_update_metrics_end_as_the_batch_result(spark, feed):
    fill_in_order(feed)
    vehicles, _ = streams(spark, feed)
    emitted = run_available(stream_metrics(vehicles, "10 seconds"), "update", "metrics")
    last = last_emission(emitted, "intersection_id", "window_start")
    batch = window_metrics(decode_vehicles(read_json_lines(spark, feed.path("vehicles"))), "10 seconds")
    assert sorted(map(tuple, last.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_append_metrics_hold_back_open_windows(spark, feed):
    fill_in_order(feed, 2)
    vehicles, _ = streams(spark, feed)
    emitted = run_available(stream_metrics(vehicles, "10 seconds"), "append", "metrics").collect()
    ends = {(r.window_end - T0).seconds for r in emitted}
    assert len(emitted) == len({(r.intersection_id, r.window_start) for r in emitted})
    assert max(ends) == 190 and len(ends) == 19


def test_late_reading_is_dropped(spark, feed):
    feed.add([vehicle(100, "A", 1)])
    feed.add([vehicle(200, "A", 2)])
    feed.add([vehicle(50, "A", 4)])
    vehicles, _ = streams(spark, feed)
    emitted = run_available(stream_metrics(vehicles, "10 seconds"), "update", "metrics").collect()
    assert {(r.window_end - T0).seconds for r in emitted} == {110, 210}


@pytest.mark.parametrize("severity", ["latest_severity", "worst_severity"])
def test_update_decisions_end_as_the_batch_result(spark, feed, severity):
    fill_in_order(feed)
    stream = stream_decisions(*streams(spark, feed), "10 seconds", severity=severity)
    emitted = run_available(stream, "update", "decisions")
    last = last_emission(emitted, "intersection_id", "window_start", "window_end")
    assert facts(last) == batch_decisions(spark, feed, severity)


def test_final_decisions_come_once_and_equal_the_batch(spark, feed):
    fill_in_order(feed)
    feed.add([vehicle(1000, k, 1) for k in KEYS])
    feed.add([vehicle(1001, "A", 1)])
    stream = stream_decisions(*streams(spark, feed), "10 seconds", emit="final")
    emitted = run_available(stream, "append", "decisions")
    got = facts(emitted)
    expected = {k: v for k, v in batch_decisions(spark, feed).items() if k[1] <= 990}
    assert emitted.count() == len(got)
    assert got == expected


def test_restart_keeps_state_and_offsets(spark, feed, tmp_path):
    folder = tmp_path / "job"
    feed.add([vehicle(1, "A", 3)], [incident(0, "A", "CRITICAL", 5)])
    first = drain(spark, stream_decisions(*streams(spark, feed), "10 seconds"), "update", folder)
    assert facts(first)[("A", 10)] == (3, 30.0, "CRITICAL", "EMERGENCY")
    feed.add([vehicle(2, "A", 4), vehicle(12, "A", 1)])
    both = drain(spark, stream_decisions(*streams(spark, feed), "10 seconds"), "update", folder)
    last = facts(last_emission(both, "intersection_id", "window_start", "window_end"))
    assert last == {("A", 10): (7, 30.0, "CRITICAL", "EMERGENCY"), ("A", 20): (1, 30.0, "CRITICAL", "EMERGENCY")}
    assert both.count() == 3


def test_idle_incident_stream_does_not_stall_decisions(spark, feed):
    feed.add([vehicle(1, "A", 3)])
    feed.add([vehicle(11, "A", 3)])
    emitted = run_available(stream_decisions(*streams(spark, feed), "10 seconds"), "update", "decisions")
    assert set(facts(emitted)) == {("A", 10), ("A", 20)}


def test_late_rows_in_update_mode(spark, feed):
    """A late reading is dropped; an incident that arrives late still counts from then on."""
    feed.add([vehicle(100, "A", 1), vehicle(100, "B", 1)])
    feed.add([vehicle(20, "A", 5), vehicle(101, "A", 2)], [incident(30, "A", "HIGH", 10)])
    stream = stream_severities(*streams(spark, feed), "10 seconds")
    rows = run_available(stream, "update", "decisions").orderBy("batch_id").collect()
    got = [(r.intersection_id, (r.window_end - T0).seconds, r.total_vehicles, r.latest_severity) for r in rows]
    assert sorted(got) == [("A", 110, 1, "NONE"), ("A", 110, 3, "HIGH"), ("B", 110, 1, "NONE")]


def test_state_helpers_keep_what_later_windows_see():
    incidents = [(0, "a", "CRITICAL", 100), (10, "b", "LOW", 20), (50, "c", "HIGH", 60)]
    kept = still_needed(incidents, 30)
    assert kept == incidents  # the expired LOW still hides the CRITICAL one
    assert severities([40, 55, 100, 101], kept) == (["NONE", "HIGH", "NONE", "NONE"], ["CRITICAL", "CRITICAL", "CRITICAL", "NONE"])
    assert still_needed(incidents, 70) == [incidents[0], incidents[2]]
    assert still_needed(incidents, 101) == [incidents[2]]


def test_whole_job_with_quarantine(spark, feed, tmp_path):
    feed.add([vehicle(1, "A", 30), "oops", vehicle(1, None, 2)], [incident(0, "A", "HIGH", 5), '{"timestamp":"x"}'])
    queries = start_decision_job(
        stream_json_lines(spark, feed.path("vehicles")),
        stream_json_lines(spark, feed.path("incidents")),
        append_batches(f"{tmp_path}/decisions"),
        append_batches(f"{tmp_path}/quarantine"),
        f"{tmp_path}/checkpoints",
        length="10 seconds",
        trigger=None,
    )
    for query in queries:
        query.awaitTermination()
    decision = read_batches(spark, f"{tmp_path}/decisions").collect()
    assert [(r.intersection_id, r.traffic_mode, r.worst_severity) for r in decision] == [("A", "DENSE", "HIGH")]
    assert decision[0].e2e_latency_ms > 0
    bad = {(r.stream, r.reason) for r in read_batches(spark, f"{tmp_path}/quarantine").collect()}
    assert bad == {
        ("vehicles", "malformed_json"),
        ("vehicles", "missing_intersection"),
        ("incidents", "bad_event_time"),
    }


def test_native_join_gives_the_pairs_of_closed_windows(spark, feed):
    fill_in_order(feed)
    feed.add([vehicle(1000, "A", 1)], [incident(1000, "C", "LOW", 1)])
    stream = stream_interval_join(*streams(spark, feed), "10 seconds")
    emitted = run_available(stream, "append", "pairs")
    metrics = window_metrics(decode_vehicles(read_json_lines(spark, feed.path("vehicles"))), "10 seconds")
    incidents = decode_incidents(read_json_lines(spark, feed.path("incidents")))
    pairs = interval_join(metrics.filter(f"window_end <= TIMESTAMP '{T0 + timedelta(seconds=900)}'"), incidents, how="inner")
    keys = ["intersection_id", "window_end", "incident_event_id", "total_vehicles"]
    got = sorted(map(tuple, emitted.select(*keys).collect()))
    assert got and got == sorted(map(tuple, pairs.select(*keys).collect()))


def test_incident_feed_keeps_late_incidents(spark, feed):
    feed.add(incidents=[incident(500, "A", "LOW", 5)])
    feed.add(incidents=[incident(900, "A", "LOW", 5)])
    feed.add(incidents=[incident(3, "A", "HIGH", 5)])
    _, incidents = streams(spark, feed)
    emitted = run_available(stream_incidents(incidents), "append", "incidents")
    assert {(r.event_time - T0).seconds for r in emitted.collect()} == {3, 500, 900}


def test_monitor_job(spark, feed, tmp_path):
    def decision(key, start, latency):
        record = {"intersection_id": key, "window_start": iso(start), "traffic_mode": "FLUID",
                  "decision_timestamp": iso(start + 1), "e2e_latency_ms": latency}
        return json.dumps(record)

    feed.add([decision("A", 10, 1500.5), decision("B", 10, -1), "junk"])
    feed.add([decision("A", 5, 3000.0), json.dumps({"intersection_id": "B", "e2e_latency_ms": None})])
    raw = stream_json_lines(spark, feed.path("vehicles"), 1).selectExpr(
        "value", "_metadata.file_name AS _file"
    )
    queries = start_monitor_job(
        raw,
        append_batches(f"{tmp_path}/received"),
        append_batches(f"{tmp_path}/state"),
        f"{tmp_path}/checkpoints",
        trigger=None,
        received_at="CAST('2024-01-01 09:00:00' AS TIMESTAMP) "
        "+ make_dt_interval(0, 0, CAST(substr(_file, 1, 4) AS INT))",
    )
    for query in queries:
        query.awaitTermination()
    received = read_batches(spark, f"{tmp_path}/received")
    assert received.count() == 3
    summary = latency_summary(latency_history(received)).first()
    assert (summary.sample_count, summary.max_latency_ms, summary.sla_3sec_compliance_pct) == (2, 3000.0, 50.0)
    state = last_emission(read_batches(spark, f"{tmp_path}/state"), "intersection_id")
    assert {(r.intersection_id, r.window_start) for r in state.collect()} == {("A", iso(5)), ("B", iso(10))}


def test_rows_per_batch_are_observed(spark, feed, tmp_path):
    feed.add([vehicle(1, "A", 1), vehicle(1, "B", 1)])
    vehicles, _ = streams(spark, feed)
    query = (
        counted(vehicles, "readings").writeStream.format("noop").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    query.awaitTermination()
    assert query.recentProgress[0].observedMetrics["readings"]["rows"] == 2


def test_empty_source_gives_no_rows(spark, feed):
    vehicles, _ = streams(spark, feed)
    assert run_available(stream_metrics(vehicles), "update", "metrics").count() == 0


def test_tables_in_folders_stream_completely(spark, tmp_path):
    """The registered streams over a table of four files equal those over one file."""
    import __spark_entry__ as contract

    source = "/root/testdata/sf0.001"
    spark.read.parquet(f"{source}/events.parquet").repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_window_metrics", "stream_latest_state"):
        one, four = (contract.queries()[name](spark, at) for at in (source, str(tmp_path)))
        assert sorted(map(str, one.collect())) == sorted(map(str, four.collect()))
        assert one.count() > 0
    with pytest.raises(Exception):
        contract.queries()["stream_window_metrics"](spark, str(tmp_path / "absent"))


@pytest.mark.parametrize("together", [True, False])
def test_final_totals_do_not_depend_on_batching(spark, tmp_path, together):
    """A reading late in time counts while its window is open, as in the native aggregate."""
    first = [vehicle(s, "A", c) for s, c in ((100, 1), (1000, 2), (1001, 4), (1002, 8))]
    late, end = vehicle(500, "A", 16), vehicle(20_000, "A", 32)
    groups = [first + [late], [end]] if together else [first, [late], [end]]
    totals = {}
    for mode in ("final", "native"):
        folder = tmp_path / mode
        (folder / "v").mkdir(parents=True)
        (folder / "i").mkdir()
        (folder / "i" / "0").write_text(incident(1, "B", "LOW", 1))
        for k, lines in enumerate(groups):
            (folder / "v" / str(k)).write_text("\n".join(lines))
            os.utime(folder / "v" / str(k), (1_600_000_000 + k, 1_600_000_000 + k))
        vehicles = decode_vehicles(stream_json_lines(spark, f"{folder}/v", 1))
        incidents = decode_incidents(stream_json_lines(spark, f"{folder}/i", 1))
        stream = (
            stream_severities(vehicles, incidents, "1 hour", emit="final")
            if mode == "final" else stream_metrics(vehicles, "1 hour")
        )
        rows = run_available(stream, "append", mode).where("intersection_id = 'A'").collect()
        totals[mode] = sorted((r.window_start, r.total_vehicles) for r in rows)
    assert totals["final"] == totals["native"]
    assert totals["final"][0][1] == 31


def test_combining_takes_time_in_proportion_and_little_memory():
    frames = [
        pd.DataFrame({
            "intersection_id": "A", "window_end": np.arange(k * 10_000, (k + 1) * 10_000), "event_time": pd.Timestamp(0),
            "total_vehicles": 1, "speed_sum": 1, "speed_readings": 1, "speed_rest": 0.0, "speed_nans": 0,
            "min_produced_at": 1,
        })
        for k in range(20)
    ]
    out = list(decisions._combiner(decisions._combine_readings)(iter(frames)))
    assert max(map(len, out)) <= 20_000 and sum(map(len, out)) == 200_000


class _Handle:
    """A state handle in memory."""

    def __init__(self):
        self.timers = []

    def getMapState(self, *_):
        return _Map()

    def getValueState(self, *_):
        return _Value()

    def registerTimer(self, at):
        self.timers.append(at)


class _Map(dict):
    def iterator(self):
        return iter(list(self.items()))

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_incidents_of_an_intersection_without_readings_expire():
    second = 1_000_000
    signals = decisions._Signals(second, second, 3600 * second)
    handle = _Handle()
    signals.init(handle)
    for k in range(200):  # one every ten minutes, each over after five
        at = k * 600 * second
        frame = pd.DataFrame({name: [None] for name in decisions._COLUMNS}).assign(
            intersection_id="A", incident_at=at, event_id=f"{k:04d}", severity="LOW", expires_at=at + 300 * second
        )
        list(signals.handleInputRows(("A",), iter([frame]), None))
    assert len(signals.incidents) <= 10


def test_final_is_late_as_the_native_aggregate(spark, tmp_path):
    """One reading per micro-batch: hour windows close and readings drop as in the native aggregate."""
    totals = {}
    for mode in ("final", "native"):
        vehicles = [
            spark.createDataFrame([(vehicle(s, "A", c),)], "value string")
            for s, c in ((100, 1), (3700, 2), (200, 4), (3710, 8), (8000, 16), (300, 32))
        ]

        def make(stream):
            readings = decode_vehicles(stream)
            none = decode_incidents(stream)
            if mode == "native":
                return stream_metrics(readings, "1 hour")
            return stream_severities(readings, none, "1 hour", emit="final")

        rows = run_slices(vehicles, make, "append", mode).collect()
        totals[mode] = sorted((r.slice, (r.window_start - T0).seconds, r.total_vehicles) for r in rows)
    assert totals["final"] == totals["native"]
    assert [t for _, _, t in totals["final"]] == [1, 10]


def test_final_keeps_late_incidents_and_spreads_one_intersection(spark):
    """Blocks of one intersection are worked on apart; severities are those of the batch."""
    rng = np.random.default_rng(8)
    readings = sorted((int(s), int(c)) for s, c in zip(rng.integers(0, 30_000, 400), rng.integers(1, 30, 400)))
    reported = [(int(s), ["LOW", "HIGH", "CRITICAL", "MEDIUM"][k % 4], int(m)) for k, (s, m) in
                enumerate(zip(rng.integers(0, 25_000, 60), rng.integers(1, 400, 60)))]
    lines = [(s, vehicle(s, "A", c)) for s, c in readings]
    slices = []
    for low, high in ((0, 11_000), (11_000, 22_000), (22_000, 40_000)):
        # Incidents come a slice ahead of the windows they are in force for.
        told = [incident(s, "A", sev, m) for s, sev, m in reported if low <= s + 100 < high or (low == 0 and s < 0)]
        part = [x for s, x in lines if low <= s < high] + told
        slices.append(spark.createDataFrame([(x,) for x in part], "value string").repartition(2))
    slices.append(spark.createDataFrame([(vehicle(50_000, "A", 1),)], "value string"))

    def make(stream):
        vehicles = decode_vehicles(stream.where("value LIKE '%VEH_%'"))
        incidents = decode_incidents(stream.where("value LIKE '%INC_%'"))
        found = stream_severities(vehicles, incidents, "60 seconds", emit="final")
        return found.withColumn("task", F.spark_partition_id())

    rows = run_slices(slices, make, "append", "blocks").collect()
    told = spark.createDataFrame([(incident(s, "A", sev, m),) for s, sev, m in reported], "value string")
    points = window_metrics(decode_vehicles(spark.createDataFrame([(x,) for _, x in lines], "value string")), "60 seconds")
    want = severity_at(points, decode_incidents(told)).collect()
    got = {r.window_end: (r.total_vehicles, r.latest_severity, r.worst_severity) for r in rows}
    assert len(got) == len(rows) == len(want)
    assert got == {r.window_end: (r.total_vehicles, r.latest_severity, r.worst_severity) for r in want}
    assert len({v[1:] for v in got.values()}) > 5
    assert all(len({r.task for r in rows if r.slice == k}) > 1 for k in range(3))


def test_jobs_run_on_processing_time_triggers(spark, feed, tmp_path):
    """Two queries go on by themselves: what comes later is decided later, without a restart."""
    feed.add([vehicle(1, "A", 30)], [incident(0, "A", "HIGH", 5)])
    queries = start_decision_job(
        stream_json_lines(spark, feed.path("vehicles")),
        stream_json_lines(spark, feed.path("incidents")),
        append_batches(f"{tmp_path}/decisions"),
        append_batches(f"{tmp_path}/quarantine"),
        f"{tmp_path}/checkpoints",
        length="10 seconds",
        trigger="500 milliseconds",
    )
    try:
        for query in queries:
            query.processAllAvailable()
        feed.add([vehicle(15, "A", 2), "oops"])
        for query in queries:
            query.processAllAvailable()
        assert all(query.isActive for query in queries)
    finally:
        for query in queries:
            query.stop()
    rows = read_batches(spark, f"{tmp_path}/decisions").collect()
    assert sorted((r.intersection_id, r.window_start, r.traffic_mode) for r in rows) == [
        ("A", iso(0), "DENSE"), ("A", iso(10), "FLUID"),
    ]
    assert len({r.batch_id for r in rows}) == 2
    assert [r.reason for r in read_batches(spark, f"{tmp_path}/quarantine").collect()] == ["malformed_json"]
