"""Exact latency statistics of any number of rows, and kept current on a stream."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from greenwave.operators import selection
from greenwave.operators.latency import latency_history, latency_summary, latency_summary_of
from greenwave.streaming.jobs import run_slices
from greenwave.streaming.latency import CountTree, stream_latency_summary


def brute(values):
    v = sorted(round(x * 100) for x in values if x is not None and x >= 0)
    n = len(v)
    if not n:
        return None
    within = sum(x < 300_000 for x in v)
    whole = [(2 * sum(v) + n) // (2 * n), v[0], v[-1], v[int(n * 0.95)], v[min(int(n * 0.99), n - 1)]]
    return (n, *(x / 100 for x in whole), ((20_000 * within + n) // (2 * n)) / 100)


@pytest.mark.parametrize("small", [100_000, 0])
def test_selected_ranks_are_those_of_sorted_values(spark, monkeypatch, small):
    monkeypatch.setattr(selection, "BINS", 5)
    rng = random.Random(1)
    groups = {
        ("a", 1): [rng.randrange(10**15) for _ in range(300)],
        ("a", None): [7] * 40,
        (None, 1): [rng.randrange(4) for _ in range(200)],
        ("b", 2): [0, 2**62],
    }
    rows = [(*k, v) for k, values in groups.items() for v in values]
    rng.shuffle(rows)
    wanted = [
        (*k, str(rank), rank, min(v), max(v)) for k, v in groups.items() for rank in {0, len(v) // 3, len(v) - 1}
    ]
    found = selection.select_ranks(
        spark.createDataFrame(rows, "x string, y int, v long"),
        spark.createDataFrame(wanted, "x string, y int, name string, rank long, lo long, hi long"),
        ("x", "y"),
        small,
    )
    got = {(r["x"], r["y"], int(r["name"])): r["v"] for r in found.collect()}
    assert got == {(*w[:2], w[3]): sorted(groups[w[:2]])[w[3]] for w in wanted}


def test_summary_of_any_number_of_rows(spark):
    rng = random.Random(2)
    groups = {f"n{n}": [float(k) for k in range(1, n + 1)] for n in (1, 20, 100, 1000)}
    groups |= {
        "sla": [2999.99, 3000.0, 3000.01], "unknown": [-1.0, None], "wide": [0.0, 0.01, 1e12],
        None: [round(rng.uniform(0, 9000), 2) for _ in range(500)] + [-1.0, None],
    }
    rows = [(k, v) for k, values in groups.items() for v in values]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "place string, ms double").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in latency_summary_of(frame, "ms", ("place",)).collect()}
    assert got == {k: brute(v) for k, v in groups.items() if k != "unknown"}
    assert [tuple(r) for r in latency_summary_of(frame, "ms").collect()] == [brute([v for _, v in rows])]
    assert latency_summary_of(frame.where("place = 'unknown'"), "ms").collect() == []


class Nodes(dict):
    """The part of a map state that the tree uses."""

    getValue, containsKey, removeKey = dict.get, dict.__contains__, dict.pop  # noqa: N815
    updateValue = dict.__setitem__  # noqa: N815


def test_count_tree_follows_values_that_come_and_go():
    rng, nodes, held = random.Random(3), Nodes(), Counter()
    for _ in range(30):
        tree = CountTree(nodes)
        for _ in range(20):
            value = rng.choice([rng.randrange(50), rng.randrange(2**40), 4095, 4096, 2**24 - 1, 2**24])
            tree.add(value, 1)
            held[value] += 1
        for value in rng.sample(sorted(held.elements()), 15):
            tree.add(value, -1)
            held[value] -= 1
        tree.flush()
        ordered = sorted(held.elements())
        fresh = CountTree(nodes)
        assert [fresh.select(k) for k in range(len(ordered))] == ordered
    tree = CountTree(nodes)
    for value in held.elements():
        tree.add(value, -1)
    tree.flush()
    assert not nodes


RECEIVED = "intersection_id string, window_start string, received_at timestamp, e2e_latency_ms double"
T0 = datetime(2024, 1, 1)


def test_stream_statistics_equal_the_batch_after_every_micro_batch(spark):
    rng = random.Random(4)
    slices, ties = [], {}  # equal arrivals have equal latencies, or which of them counts would be open
    for number in range(5):
        rows = []
        for k in range(70):  # late arrivals, ties of all columns, unknown values, nulls
            at = T0 + timedelta(seconds=rng.randrange(60) + 40 * number)
            key = rng.choice(["A", "A", "B", None]) if number != 3 else "A"
            start = f"w{rng.randrange(3)}"
            value = len(ties.setdefault((at, key, start), [0] * rng.randrange(1, 600))) * 1000 / 100 + 0.25
            rows.append((key, start, at, rng.choice([value, value, value, -1.0, None])))
        if number == 2:
            rows = [("B", "w", None, 5.0), ("A", "w", T0, -1.0)]
        slices.append(spark.createDataFrame(rows, RECEIVED).repartition(3))
    found = run_slices(
        slices, lambda s: stream_latency_summary(s, ("'ALL'", "intersection_id"), size=40), "update", "statistics"
    )
    got = {(r["slice"], r["scope"]): tuple(r)[1:-1] for r in found.collect()}
    want, so_far = {}, []
    for number, rows in enumerate(s.collect() for s in slices):
        so_far += rows
        known = spark.createDataFrame(so_far, RECEIVED)
        for scope in {"ALL"} | {r[0] for r in rows if r[0] and (r[3] or -1) >= 0}:
            mine = known if scope == "ALL" else known.where(f"intersection_id = '{scope}'")
            want[(number, scope)] = tuple(latency_summary(latency_history(mine, 40)).first())
    assert got == want and {k[0] for k in want} == set(range(5))
