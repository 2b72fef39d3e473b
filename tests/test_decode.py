"""Decoding of good and bad payloads."""

import json

import pytest

from greenwave.operators.decode import (
    classify_records,
    decode_decisions,
    decode_incidents,
    decode_vehicles,
    split_bad_records,
)
from greenwave.schemas import VEHICLE

GOOD = {
    "event_id": "VEH_A_1",
    "timestamp": "2024-03-24T10:15:32",
    "produced_at": "2024-03-24T10:15:32",
    "intersection_id": "A",
    "direction": "NORD",
    "vehicle_count": 3,
    "vehicle_type": "bus",
    "average_speed_kmh": 31.25,
    "density_level": "LOW",
}


def changed(**fields):
    return json.dumps({k: v for k, v in {**GOOD, **fields}.items() if v != "__drop__"})


PAYLOADS = [
    (json.dumps(GOOD), None),
    ('{"a":', "malformed_json"),
    ("not json", "malformed_json"),
    ("[]", "malformed_json"),
    ("{}", "missing_event_time"),
    ("null", "malformed_json"),
    ("", "missing_event_time"),
    (None, "missing_event_time"),
    (changed(extra=1), None),
    (changed(vehicle_count=3.7), None),
    (changed(vehicle_count="3"), None),
    (changed(intersection_id="__drop__"), "missing_intersection"),
    (changed(timestamp="bad"), "bad_event_time"),
    (changed(timestamp="2024-03-24T10:15:32.5"), "bad_event_time"),
    (changed(timestamp="2024-03-24T10:15:32Z"), "bad_event_time"),
    (changed(timestamp="2024-03-24 10:15:32"), "bad_event_time"),
    (changed(timestamp="2024-3-24T10:15:32"), "bad_event_time"),
    (changed(timestamp="2024-02-30T10:15:32"), "bad_event_time"),
    (changed(timestamp="2024-03-24T10:15:32\n"), "bad_event_time"),
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(None if p is None else bytearray(p.encode()),) for p, _ in PAYLOADS]
    return spark.createDataFrame(rows, "value binary")


def test_reasons(raw):
    got = [r.reason for r in classify_records(raw, VEHICLE).collect()]
    assert got == [reason for _, reason in PAYLOADS]


def test_split_keeps_every_record_once(raw):
    good, bad = split_bad_records(raw, VEHICLE)
    assert good.count() + bad.count() == len(PAYLOADS)
    assert "reason" not in good.columns and bad.columns == ["payload", "reason"]


def test_decode_drops_rows_without_event_time_and_keeps_the_rest(raw):
    rows = decode_vehicles(raw).collect()
    assert len(rows) == 5
    assert [r.vehicle_count for r in rows] == [3, 3, None, None, 3]
    assert rows[2].average_speed_kmh == 31.25
    assert rows[4].intersection_id is None


def test_decoding_parses_each_payload_once(raw):
    frames = [
        decode_vehicles(raw),
        *split_bad_records(raw, VEHICLE),
        decode_decisions(raw).filter("reason IS NULL"),
    ]
    for df in frames:
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_decode_of_some_fields(raw):
    rows = decode_vehicles(raw, fields=["intersection_id"])
    assert rows.columns == ["timestamp", "intersection_id", "event_time"]
    assert [r.intersection_id for r in rows.collect()] == ["A", "A", "A", "A", None]


def test_incident_schema(spark):
    value = json.dumps({"timestamp": "2024-03-24T10:15:32", "intersection_id": "A", "estimated_duration_min": 7})
    row = decode_incidents(spark.createDataFrame([(value,)], "value string")).first()
    assert row.estimated_duration_min == 7 and row.severity is None


def test_decision_records(spark):
    rows = [
        ('{"intersection_id":"A","e2e_latency_ms":5.25}', "A", 5.25, None),
        ('{"intersection_id":"A"}', "A", -1.0, None),
        ('{"e2e_latency_ms":1}', "UNKNOWN", 1.0, None),
        ('{"intersection_id":"A","e2e_latency_ms":null}', "A", -1.0, "bad_latency"),
        ('{"intersection_id":"A","e2e_latency_ms":"x"}', "A", -1.0, "bad_latency"),
        ("[1]", "UNKNOWN", -1.0, "malformed_json"),
        ("oops", "UNKNOWN", -1.0, "malformed_json"),
    ]
    raw = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "offset int, value string")
    got = decode_decisions(raw).orderBy("offset").collect()
    assert [(r.intersection_id, r.e2e_latency_ms, r.reason) for r in got] == [r[1:] for r in rows]
