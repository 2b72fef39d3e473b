"""The commit log of micro-batch tables, counts per batch, and lookup in live state."""

import time
from datetime import datetime

import pytest

from greenwave.operators.state import latest_state, lookup_state
from greenwave.sources import batches
from greenwave.sources.batches import Entry, append_batches, batch_counts, compact_batches, last_emission, read_batches
from greenwave.streaming.jobs import counted, run_slices
from greenwave.streaming.live import live_state
from greenwave.streaming.progress import CountsListener, batch_counts_table


class Query:
    """Gives ``append_batches`` the query id that a stream would."""

    def __init__(self, spark, path, name):
        self.spark, self.name, self.write = spark, name, append_batches(str(path))

    def batch(self, number, *rows):
        self.spark.sparkContext.setLocalProperty("sql.streaming.queryId", self.name)
        try:
            self.write(self.spark.createDataFrame(list(rows), "k string, v long"), number)
        finally:
            self.spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def table(spark, path):
    return sorted(map(tuple, read_batches(spark, str(path)).select("run", "batch_id", "k", "v").collect()))


def test_retried_half_written_and_empty_batches(spark, tmp_path, monkeypatch):
    query = Query(spark, tmp_path, "q")
    query.batch(0, ("a", 1), ("b", 2))
    query.batch(1)
    with monkeypatch.context() as stopped:  # ends between data and entry
        stopped.setattr(batches, "_commit", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            query.batch(2, ("c", 3))
    assert table(spark, tmp_path) == [(0, 0, "a", 1), (0, 0, "b", 2)]
    query.batch(2, ("c", 3))
    query.batch(2, ("c", 3))  # entered, but the checkpoint was not: written again
    assert table(spark, tmp_path) == [(0, 0, "a", 1), (0, 0, "b", 2), (0, 2, "c", 3)]
    assert sorted(map(tuple, batch_counts(spark, str(tmp_path)).collect())) == [(0, 0, 2), (0, 1, 0), (0, 2, 1)]


def test_runs_are_ordered_and_the_last_emission_is_of_the_later_run(spark, tmp_path):
    first, second = Query(spark, tmp_path, "zz"), Query(spark, tmp_path, "aa")
    first.batch(0, ("a", 1), ("b", 1))
    first.batch(9, ("a", 9))
    second.batch(0, ("a", 20))
    Query(spark, tmp_path, "zz").batch(10, ("c", 10))  # the first query again, restarted
    assert {(r, b) for r, b, *_ in table(spark, tmp_path)} == {(0, 0), (0, 9), (1, 0), (0, 10)}
    last = last_emission(read_batches(spark, str(tmp_path)), "k")
    assert {(r.k, r.v) for r in last.collect()} == {("a", 20), ("b", 1), ("c", 10)}


def test_compaction_swaps_at_once(spark, tmp_path):
    query = Query(spark, tmp_path, "q")
    for k in range(4):
        query.batch(k, ("a", k), ("b", k))
    before = table(spark, tmp_path)
    old = read_batches(spark, str(tmp_path))
    compact_batches(spark, str(tmp_path), 1)
    compact_batches(spark, str(tmp_path), 1)  # nothing left to do
    assert table(spark, tmp_path) == before and len(read_batches(spark, str(tmp_path)).inputFiles()) == 1
    assert old.count() == len(before)
    query.batch(3, ("a", 3), ("b", 3))  # a retry of what is compacted
    query.batch(4, ("a", 4))
    assert table(spark, tmp_path) == [*before, (0, 4, "a", 4)]
    compact_batches(spark, str(tmp_path), 1)
    assert table(spark, tmp_path) == [*before, (0, 4, "a", 4)]
    assert batch_counts(spark, str(tmp_path)).count() == 5


def test_of_overlapping_compactions_one_counts():
    one, two = (Entry("q", 0, k, f"f{k}", 1, k, None) for k in range(2))
    a = Entry(None, None, None, "a", 2, 5, ["f0", "f1"])
    b = Entry(None, None, None, "b", 2, 6, ["f0", "f1"])
    c = Entry(None, None, None, "c", 2, 7, ["a"])
    assert batches.live_entries([one, two, a, b]) == [a]
    assert batches.live_entries([one, two, a, b, c]) == [c]


def test_tables_without_batches(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing is committed"):
        read_batches(spark, str(tmp_path))
    schema = spark.createDataFrame([], "k string, run int, batch_id long").schema
    assert read_batches(spark, str(tmp_path), schema).collect() == []
    compact_batches(spark, str(tmp_path), 1)
    assert batch_counts(spark, str(tmp_path)).count() == 0


def test_counts_of_every_batch_reach_a_table(spark, tmp_path):
    listener = CountsListener(spark, f"{tmp_path}/counts")
    spark.streams.addListener(listener)
    try:
        at = [datetime(2024, 1, 1, h) for h in (1, 2, 12, 3)]  # the last one is late
        slices = [spark.createDataFrame([(t,)] * (k + 1), "t timestamp") for k, t in enumerate(at)]

        def make(stream):
            return counted(stream.withWatermark("t", "1 hour").groupBy("t").count(), "out")

        run_slices(slices, make, "update", "counted")
        deadline = time.time() + 60
        while time.time() < deadline:
            try:
                rows = batch_counts_table(spark, f"{tmp_path}/counts").orderBy("batch_id").collect()
            except Exception:  # noqa: BLE001 - no batch has been counted yet
                rows = []
            if sum(r.input_rows for r in rows) == 10 and sum(r.late_rows for r in rows):
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert [r.input_rows for r in rows if r.input_rows] == [1, 2, 3, 4]
    assert [r.output_rows for r in rows if r.input_rows] == [1, 1, 1, 0]
    assert [r.late_rows > 0 for r in rows if r.input_rows] == [False, False, False, True]
    assert len({r.query for r in rows}) == 1 and len({r.run for r in rows}) > 1


def test_live_state_equals_the_emitted_table_after_each_batch(spark):
    rows = [[("A", 1, "x"), ("B", 5, "y")], [("A", 0, "late"), (None, 2, "n")], [("B", 6, "z")]]
    slices = [spark.createDataFrame(r, "intersection_id string, received_at long, window_start string") for r in rows]
    found = []

    def read(number, query, checkpoint):
        batch = max(p.batchId for p in query.recentProgress if p.numInputRows)
        found.append((batch, checkpoint))

    emitted = run_slices(slices, latest_state, "update", "state", read).collect()
    want = {}
    for number, (batch, checkpoint) in enumerate(found):
        want |= {r.intersection_id: (r.received_at, r.window_start) for r in emitted if r.slice == number}
        state = live_state(spark, checkpoint, batch)
        assert {r.intersection_id: (r.received_at, r.window_start) for r in state.collect()} == want
    now = live_state(spark, found[-1][1])
    assert [r.window_start for r in lookup_state(now, "B").collect()] == ["z"]
    assert lookup_state(now, "C").collect() == [] and lookup_state(now, "UNKNOWN").count() == 1
