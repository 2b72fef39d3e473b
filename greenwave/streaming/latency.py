"""Latency statistics kept current on a stream of received decisions.

Every scope, such as all decisions or one intersection, has a ring of its most recently arrived
latencies and a count tree over their values. A micro-batch moves the ring on and adds and takes
only what entered and left; percentiles are read off the tree. Nothing is read again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from greenwave.functions import HISTORY_SIZE, SLA_MS
from greenwave.operators.latency import PERCENTILES

_ROWS = "scope string, arrived long, tie string, v long"
_STATISTICS = (
    "scope string, sample_count long, avg_latency_ms double, min_latency_ms double, max_latency_ms double, "
    + ", ".join(f"{p}_latency_ms double" for p in PERCENTILES)
    + ", sla_3sec_compliance_pct double"
)
#: Bits of a value that one level of the tree tells apart; the root tells the rest apart.
BITS = 12


class CountTree:
    """Counts of non-negative integers by prefix: root, middle and leaves, each child with its count.

    Nodes are read from and written to ``nodes`` (a map of ``(level, prefix)`` to children and
    counts), each at most once until ``flush``.
    """

    ROOT = (2, 0)

    def __init__(self, nodes):
        self.nodes, self.open, self.changed = nodes, {}, set()

    def _node(self, key: tuple[int, int]) -> dict[int, int]:
        if key not in self.open:
            stored = self.nodes.getValue(key) if self.nodes.containsKey(key) else None
            self.open[key] = dict(zip(stored[0], stored[1])) if stored else {}
        return self.open[key]

    @staticmethod
    def _path(value: int):
        """Nodes from the root with the child that ``value`` belongs to."""
        mask = (1 << BITS) - 1
        middle, leaf = value >> 2 * BITS, value >> BITS
        yield CountTree.ROOT, middle
        yield (1, middle), leaf & mask
        yield (0, leaf), value & mask

    def add(self, value: int, times: int) -> None:
        for key, child in self._path(value):
            node = self._node(key)
            node[child] = node.get(child, 0) + times
            if not node[child]:
                del node[child]
            self.changed.add(key)

    def select(self, rank: int) -> int:
        """The value at a 0-based rank."""
        key, prefix = self.ROOT, 0
        while True:
            for child, n in sorted(self._node(key).items()):
                if rank < n:
                    break
                rank -= n
            prefix = child if key[0] == 2 else prefix << BITS | child
            if key[0] == 0:
                return prefix
            key = (key[0] - 1, prefix)

    def flush(self) -> None:
        for key in self.changed:
            node = self.open[key]
            if node:
                self.nodes.updateValue(key, (list(node), list(node.values())))
            elif self.nodes.containsKey(key):
                self.nodes.removeKey(key)
        self.changed.clear()


class _Statistics(StatefulProcessor):
    """Ring and tree of one scope; emits its statistics after every micro-batch that reaches it."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "arrived long, tie string, v long")
        self.nodes = handle.getMapState("tree", "level int, prefix long", "child array<long>, n array<long>")
        self.sums = handle.getValueState("sums", "n long, total long, within long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        old = [tuple(r) for r in self.ring.get()]
        new: list[tuple] = []
        for frame in rows:
            new += frame[["arrived", "tie", "v"]].itertuples(index=False, name=None)
            if len(new) > 2 * self.size:
                new = sorted(new)[-self.size :]
        now = sorted(old + new)[-self.size :]
        moved = Counter(v for *_, v in now)
        moved.subtract(v for *_, v in old)
        tree = CountTree(self.nodes)
        n, total, within = self.sums.get() if self.sums.exists() else (0, 0, 0)
        for value, times in moved.items():
            if times:
                tree.add(int(value), times)
                n, total = n + times, total + int(value) * times
                within += times if value < SLA_MS * 100 else 0
        tree.flush()
        self.ring.put([(int(a), t, int(v)) for a, t, v in now])
        self.sums.update((n, total, within))
        at = [tree.select(min(int(n * p), n - 1)) for p in PERCENTILES.values()]
        numbers = [(2 * total + n) // (2 * n), tree.select(0), tree.select(n - 1), *at, (20_000 * within + n) // (2 * n)]
        yield pd.DataFrame([[key[0], n, *(x / 100 for x in numbers)]], columns=[c.split()[0] for c in _STATISTICS.split(", ")])

    def close(self) -> None:
        pass


def _newest(size: int):
    """Of each source partition and scope only the ``size`` last arrivals can matter."""

    def newest(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values(["arrived", "tie", "v"], kind="stable")
        return ordered.groupby("scope", sort=False).tail(size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for frame in frames:
            kept = newest(frame if kept is None else pd.concat([kept, frame], ignore_index=True))
            if len(kept) > 20 * size + len(frame):  # many scopes: what is left is taken apart later
                yield kept
                kept = None
        if kept is not None and len(kept):
            yield kept

    return run


def stream_latency_summary(
    received: DataFrame,
    scopes: Sequence[str] = ("'ALL'",),
    size: int = HISTORY_SIZE,
    value: str = "e2e_latency_ms",
    arrival: tuple[str, ...] = ("received_at", "intersection_id", "window_start"),
) -> DataFrame:
    """Statistics of the ``size`` most recently arrived latencies, per scope, for update mode.

    A row per scope and micro-batch that holds known latencies of it; the columns are those of
    ``latency_summary`` behind ``scope``, and after each micro-batch its values are those of
    ``latency_summary(latency_history(...))`` over all rows so far. ``scopes`` are expressions: each
    decision counts in all of them. ``arrival`` begins with a timestamp; the rest breaks ties.
    Each source partition sends its ``size`` last arrivals of a scope, however many it holds.
    """
    tie = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in arrival[1:]) or "''"
    scoped = received.where(f"{value} >= 0").selectExpr(
        f"explode(array_distinct(array({', '.join(scopes)}))) AS scope",
        f"coalesce(unix_micros({arrival[0]}), {-(2**62)}L) AS arrived",
        f"concat_ws('\\u0000', {tie}) AS tie",
        f"CAST(round({value} * 100) AS BIGINT) AS v",
    )
    kept = scoped.where("scope IS NOT NULL").mapInPandas(_newest(size), _ROWS)
    return kept.groupBy("scope").transformWithStateInPandas(
        _Statistics(size), outputStructType=_STATISTICS, outputMode="update", timeMode="None"
    )
