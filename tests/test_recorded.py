"""Recorded topics: offsets, starts, limits and restarts."""

from datetime import datetime, timedelta

from greenwave.sources import topics
from greenwave.sources.batches import append_batches, read_batches
from greenwave.sources.recorded import _StreamReader, read_recorded, record_topic, stream_recorded

T0 = datetime(2024, 1, 1)


def send(spark, path, rows, partitions=3):
    full = [(k, v, T0 + timedelta(seconds=s)) for k, v, s in rows]
    record_topic(spark.createDataFrame(full, "key string, value string, timestamp timestamp"), path, partitions)


def follow(spark, path, folder, starting):
    query = (
        stream_recorded(spark, path, starting)
        .writeStream.foreachBatch(append_batches(f"{folder}/out"))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def test_offsets_go_on_and_keys_keep_their_partition(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert read_recorded(spark, path).collect() == []
    send(spark, path, [(f"k{i % 5}", f"a{i:02d}", i) for i in range(40)] + [(None, "n", 50)])
    send(spark, path, [(f"k{i % 5}", f"b{i:02d}", 100 + i) for i in range(20)])
    rows = read_recorded(spark, path).collect()
    assert len(rows) == 61
    places = {}
    for r in rows:
        places.setdefault(r.key, set()).add(r.partition)
    assert all(len(p) == 1 for p in places.values())
    for p in {r.partition for r in rows}:
        mine = sorted((r for r in rows if r.partition == p), key=lambda r: r.offset)
        assert [r.offset for r in mine] == list(range(len(mine)))
        assert [r.timestamp for r in mine] == sorted(r.timestamp for r in mine)


def test_a_restarted_query_goes_on_where_it_ended(spark, tmp_path):
    path = str(tmp_path / "topic")
    send(spark, path, [("a", "1", 1), ("b", "2", 2)])
    follow(spark, path, tmp_path / "all", "earliest")
    send(spark, path, [("a", "3", 3), ("c", "4", 4)])
    follow(spark, path, tmp_path / "all", "earliest")
    follow(spark, path, tmp_path / "all", "earliest")
    got = read_batches(spark, f"{tmp_path}/all/out").collect()
    assert sorted((r.batch_id, r.value) for r in got) == [(0, "1"), (0, "2"), (1, "3"), (1, "4")]
    assert {r.value: r.timestamp for r in got} == {str(k): T0 + timedelta(seconds=k) for k in range(1, 5)}


def test_latest_start_leaves_out_what_was_there(spark, tmp_path):
    path = str(tmp_path / "topic")
    send(spark, path, [("a", "old", 1), ("b", "old", 1)])
    follow(spark, path, tmp_path / "new", "latest")  # nothing yet, but its offsets are kept
    send(spark, path, [("a", "new", 2), ("z", "new", 2)])
    follow(spark, path, tmp_path / "new", "latest")
    got = read_batches(spark, f"{tmp_path}/new/out").collect()
    assert sorted((r.key, r.value) for r in got) == [("a", "new"), ("z", "new")]


def test_offsets_per_trigger(spark, tmp_path):
    path = str(tmp_path / "topic")
    send(spark, path, [("a", str(i), i) for i in range(25)] + [("b", "x", 1)], partitions=64)
    reader = _StreamReader({"path": path, "startingoffsets": "earliest", "maxoffsetspertrigger": "10"})
    start, taken = reader.initialOffset(), []
    while (end := reader.latestOffset()) != start:
        taken.append(sum(p.value[3] - p.value[2] for p in reader.partitions(start, end)))
        start = end
    assert sum(taken) == 26 and max(taken) <= 10 and len(taken) >= 3
    restarted = _StreamReader({"path": path, "maxoffsetspertrigger": "10"})
    assert restarted.latestOffset() == end


def test_decisions_of_a_topic_are_decoded(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "topic")
    send(spark, path, [("A", '{"intersection_id":"A","traffic_mode":"FLUID"}', 5), ("A", "oops", 6)])
    monkeypatch.setattr(topics, "read_topic", lambda spark, topic, servers, **o: stream_recorded(spark, path, **o))
    query = (
        topics.read_decision_topic(spark, "broker:9092", starting="earliest")
        .writeStream.foreachBatch(append_batches(f"{tmp_path}/out"))
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    rows = read_batches(spark, f"{tmp_path}/out").orderBy("received_at").collect()
    assert [(r.intersection_id, r.traffic_mode, r.e2e_latency_ms, r.reason) for r in rows] == [
        ("A", "FLUID", -1.0, None), ("UNKNOWN", None, -1.0, "malformed_json"),
    ]
    assert rows[0].received_at == T0 + timedelta(seconds=5)
