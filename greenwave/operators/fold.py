"""Incident state kept by replaying incidents in arrival order.

The state of an intersection is one incident. An arriving incident is skipped
if it has already expired; it replaces the stored one if none is stored, the
stored one has expired by now, its severity ranks higher, or its event time is
not older. The outcome depends on the order, so this is no ordinary aggregate.

It still splits: a stretch of arrivals acts on the state before it as a function,
and such functions compose. The state either passes or is displaced by the first arrival
that can, and from that arrival on one of few incidents is stored at the end. Spark
range-partitions by (intersection, arrival), so one hot intersection spreads over many
stretches of bounded length. Each works out, as whole arrays, what every arrival leads to at
its end. What a stretch can end in is a node; the first later stretch that displaces it, and
the node it leads to there, its successor. Successors are composed by doubling: after k rounds
a node knows where it is 2^k displacements on, and the first stretch's node where all arrivals
end. No task meets more than a stretch of one intersection at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.operators.incidents import live_incidents
from greenwave.session import stored

#: Arrivals of one intersection that a task holds at once.
STRETCH = 200_000
#: States that one task looks up in a stretch.
LOOKUPS = 1_000_000

_STATE = "rank int, time long, end long, severity string"
#: ``whole``: all arrivals of the intersection lie in the stretch; ``first``: stored at the end if none was before.
_NODES = f"intersection_id string, stretch long, place long, at long, {_STATE}, node long, whole boolean, first boolean"


def _first_at_least(start: np.ndarray, bound: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row the first place from ``start`` on whose value is at least ``bound``, or the length."""
    size = len(values)
    tables = [values]  # largest of 1, 2, 4, ... values from each place on
    while 2 << len(tables) - 1 <= size:
        step = 1 << len(tables) - 1
        tables.append(np.maximum(tables[-1][:-step], tables[-1][step:]))
    at = start.copy()
    for level, table in reversed(list(enumerate(tables))):
        inside = at < len(table)
        at += (inside & (table[np.minimum(at, len(table) - 1)] < bound)) << level
    return at


def _first_displacer(start, state, later) -> np.ndarray:
    """Where each state (``rank``, ``time``, ``end``) is displaced, from ``start`` on in ``later``
    (``rank``, ``time``, ``at``); its length if nowhere."""
    if not len(later[0]):
        return start
    return np.minimum.reduce([
        _first_at_least(start, state[0] + 1, later[0]),
        _first_at_least(start, state[1], later[1]),
        _first_at_least(start, state[2] + 1, later[2]),
    ])


def _endings(rank, time, at, end, stop) -> np.ndarray:
    """For each arrival the one that is stored at ``stop``, the end of its run, if it is stored itself."""
    own = np.arange(len(rank))
    following = _first_displacer(own + 1, (rank, time, end), (rank, time, at))
    node = np.where(following < stop, following, own)
    while True:
        onward = node[node]
        if (onward == node).all():
            return node
        node = onward


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted arrivals, cut into stretches, with the node that each leads to.

    Arrivals that the next one of their intersection outdoes in severity and time lead to the same
    as that one and are left out. Of an intersection that lies whole in a chunk only what it ends in is kept.
    """
    base = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    chunk = 0

    def reduced(table: pa.Table) -> pa.RecordBatch:
        columns = {name: table.column(name).to_numpy() for name in ("at", "rank", "time", "end")}
        key = table.column("intersection_id").combine_chunks().dictionary_encode().indices.to_numpy()
        same = key[1:] == key[:-1]
        outdone = same & (columns["rank"][1:] >= columns["rank"][:-1]) & (columns["time"][1:] >= columns["time"][:-1])
        kept = np.flatnonzero(np.r_[~outdone, True])
        table, key = table.take(pa.array(kept)), key[kept]
        at, rank, time, end = (columns[name][kept] for name in ("at", "rank", "time", "end"))
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        run = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        stops = np.r_[starts[1:], len(key)]
        node = _endings(rank.astype(np.int64), time, at, end, stops[run])
        first = np.zeros(len(key), bool)
        first[node[starts]] = True
        # The intersections at both ends of a chunk may go on elsewhere.
        whole = (run > 0) & (run < run[-1])
        wanted = np.flatnonzero(~whole | first)
        added = {
            "stretch": pa.array(base + 2 * chunk + (run == run[-1]) * 1, pa.int64()),
            "place": pa.array(np.arange(len(key)) - starts[run], pa.int64()),
            "node": pa.array(node - starts[run], pa.int64()),
            "whole": pa.array(whole),
            "first": pa.array(first),
        }
        for name, values in added.items():
            table = table.append_column(name, values)
        names = [part.split()[0] for part in _NODES.split(", ")]
        found = table.take(pa.array(wanted)).select(names).combine_chunks()
        return found.to_batches()[0]

    for batch in batches:
        while batch.num_rows:
            room = STRETCH - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == STRETCH:
                yield reduced(pa.Table.from_batches(held))
                held, chunk = [], chunk + 1
    if held:
        yield reduced(pa.Table.from_batches(held))


def _successors(nodes: DataFrame, arrivals: DataFrame, cuts: list) -> DataFrame:
    """``stretch``, ``place`` of every node that a later stretch displaces, and where that leads: ``to_*``.

    ``cuts`` has a row for each stretch of intersections with several: what displaces most easily in it.
    """
    cuts = sorted(cuts, key=lambda c: c["stretch"])  # so also in order of intersection and arrival
    stretches = np.array([c["stretch"] for c in cuts])
    later = tuple(np.array([c[name] for c in cuts], np.int64) for name in ("rank", "time", "at"))
    keys = [c["intersection_id"] for c in cuts]
    ends = {key: place + 1 for place, key in enumerate(keys)}
    stops = np.array([ends[key] for key in keys])

    def target(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            state = [batch.column(c).to_numpy().astype(np.int64) for c in ("rank", "time", "end")]
            place = np.searchsorted(stretches, batch.column("stretch").to_numpy())
            found = _first_displacer(place + 1, state, later)
            hit = np.flatnonzero(found < stops[place])
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(hit)).columns, pa.array(stretches[found[hit]], pa.int64())],
                [*batch.schema.names, "target"],
            )

    def enter(states: pa.Table, rows: pa.Table) -> pa.Table:
        if not states.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("stretch", "place", "to_stretch", "to_place")})
        rows = rows.sort_by("place")
        later = tuple(rows.column(c).to_numpy().astype(np.int64) for c in ("rank", "time", "at"))
        state = [states.column(c).to_numpy().astype(np.int64) for c in ("rank", "time", "end")]
        # Places count what was kept; rows are all of these, in order.
        found = _first_displacer(np.zeros(states.num_rows, np.int64), state, later)
        return pa.table({
            "stretch": states.column("stretch"),
            "place": states.column("place"),
            "to_stretch": states.column("target"),
            "to_place": rows.column("node").combine_chunks().take(pa.array(found)),
        })

    bounds = "stretch long, place long, rank int, time long, end long"
    aimed = nodes.selectExpr(*[b.split()[0] for b in bounds.split(", ")]).mapInArrow(target, f"{bounds}, target long")
    aimed = stored(aimed, "aimed")
    # A stretch that very many states reach is looked up in parts.
    parts = aimed.groupBy("target").agg(F.expr(f"CAST(ceil(count(1) / {LOOKUPS}) AS INT) AS parts"))
    parts = F.broadcast(stored(parts, "parts"))  # at most a row for each of ``cuts``
    states = aimed.join(parts, "target").withColumn("part", F.expr("CAST(pmod(place, parts) AS INT)"))
    rows = arrivals.join(parts.withColumnRenamed("target", "stretch"), "stretch")
    rows = rows.withColumn("part", F.expr("explode(sequence(0, parts - 1))"))
    return (
        states.select("stretch", "place", "rank", "time", "end", "target", "part")
        .groupBy("target", "part")
        .cogroup(rows.select("stretch", "place", "at", "rank", "time", "node", "part").groupBy("stretch", "part"))
        .applyInArrow(enter, "stretch long, place long, to_stretch long, to_place long")
    )


def _composed(ways: DataFrame) -> DataFrame:
    """``ways`` followed to their ends, each round over twice as many steps."""
    ways = stored(ways, "ways")
    while True:
        onward = ways.selectExpr("stretch AS to_stretch", "place AS to_place", "to_stretch AS s", "to_place AS p")
        longer = ways.join(onward, ["to_stretch", "to_place"], "left").selectExpr(
            "stretch",
            "place",
            "coalesce(s, to_stretch) AS to_stretch",
            "coalesce(p, to_place) AS to_place",
            "s IS NOT NULL AS moved",
        )
        longer = stored(longer, "ways")
        ways = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return ways


def fold_incidents(
    incidents: DataFrame, arrival: str = "arrival_ts", partitions: int | None = None
) -> DataFrame:
    """Incident stored per intersection after all arrivals, in (arrival, event_id) order.

    The driver receives a row of bounds for each stretch of intersections that span several:
    two for each chunk of ``STRETCH`` arrivals at most.
    """
    arrivals = (
        live_incidents(incidents, arrival)
        .filter("intersection_id IS NOT NULL")
        .selectExpr(
            "intersection_id",
            f"unix_micros({arrival}) AS at",
            "CAST(event_id AS STRING) AS event_id",
            "severity_rank AS rank",
            "unix_micros(event_time) AS time",
            "unix_micros(expires_at) AS end",
            "severity",
        )
    )
    order = ["intersection_id", "at", "event_id"]
    ranged = (
        arrivals.repartitionByRange(partitions, *order)
        if partitions
        else arrivals.repartitionByRange(*order)
    )
    rows = stored(ranged.sortWithinPartitions(*order).mapInArrow(_stretches, _NODES), "stretches")
    cuts = rows.where("NOT whole").groupBy("intersection_id", "stretch")
    cuts = cuts.agg(F.max("rank").alias("rank"), F.max("time").alias("time"), F.max("at").alias("at")).collect()
    times: dict[str, int] = {}
    for cut in cuts:
        times[cut["intersection_id"]] = times.get(cut["intersection_id"], 0) + 1
    several = sorted((c for c in cuts if times[c["intersection_id"]] > 1), key=lambda c: c["stretch"])
    ended = rows.where("first")
    if several:
        spark = incidents.sparkSession
        heads = {c["intersection_id"]: c["stretch"] for c in reversed(several)}
        spans = spark.createDataFrame(
            [(c["stretch"], heads[c["intersection_id"]] == c["stretch"]) for c in several], "stretch long, head boolean"
        )
        open_rows = rows.where("NOT whole")
        split = open_rows.join(F.broadcast(spans), "stretch")
        ways = _composed(_successors(split.where("node = place"), split, several))
        start = split.where("head AND first").select("stretch", "place").join(ways, ["stretch", "place"], "left")
        start = start.selectExpr("coalesce(to_stretch, stretch) AS stretch", "coalesce(to_place, place) AS place")
        last = open_rows.join(F.broadcast(start), ["stretch", "place"], "left_semi").select(*rows.columns)
        alone = open_rows.where("first").join(F.broadcast(spans), "stretch", "left_anti").select(*rows.columns)
        ended = ended.where("whole").unionByName(alone).unionByName(last)
    return ended.selectExpr(
        "intersection_id",
        "severity",
        "rank AS severity_rank",
        "timestamp_micros(time) AS event_time",
        "timestamp_micros(end) AS expires_at",
    )
