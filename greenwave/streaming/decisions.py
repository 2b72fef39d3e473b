"""Signal decisions from a vehicle stream and an incident stream.

A stream-stream join would not do: it emits in append mode only, and an idle
incident stream would hold its watermark, and with it every decision, back.

Two ways to emit:

``update``  a window is emitted as soon as it has data and again on every change.
            Both streams are united and grouped by intersection into one stateful
            operator that keeps the open windows and the incidents still in force.
            Lateness is judged per intersection, by the newest reading seen before
            the micro-batch; incidents are never too late. Rows are combined inside
            each source partition before they are shuffled, so a hot intersection
            sends at most one row per window and input partition; its state lives in
            one task, which sees only those combined rows.
``final``   a window is emitted once, when the watermark of the readings has passed its
            end: the native window aggregate closes it, so readings are late exactly
            when that drops them. Closed windows go to a second stateful operator
            keyed by intersection and block of time, which holds the incidents that
            windows of the block can see. So the open windows of a hot intersection
            are spread by window and its closed ones by block, over as many tasks as
            there are. Incidents are never too late: they count for the windows that
            close after them, or together with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from greenwave.functions import (
    SEVERITY_RANK,
    SignalRules,
    beyond_fixed,
    parse_produced_at,
    to_fixed,
)
from greenwave.operators.decisions import decide
from greenwave.operators.incidents import incident_lifetimes, seconds_of
from greenwave.operators.metrics import window_metrics

_INPUT = (
    "intersection_id string, event_time timestamp, window_end long, total_vehicles long, "
    "speed_sum long, speed_readings long, speed_rest double, speed_nans long, min_produced_at long, "
    "incident_at long, event_id string, severity string, expires_at long"
)
_OUTPUT = (
    "intersection_id string, window_end long, total_vehicles long, speed_sum long, "
    "speed_readings long, speed_rest double, speed_nans long, min_produced_at long, "
    "latest_severity string, worst_severity string"
)
_COLUMNS = [part.split()[0] for part in _INPUT.split(", ")]
_SUMS = ["total_vehicles", "speed_sum", "speed_readings", "speed_rest", "speed_nans"]
_FAR = 2**62
#: What the second operator of ``final`` returns, and the columns that only incidents have.
_CLOSED_TYPES = [
    "intersection_id string", "window_end long", "total_vehicles long", "speed_sum long", "speed_readings long",
    "speed_rest double", "min_produced_at long", "latest_severity string", "worst_severity string",
]
_CLOSED = [part.split()[0] for part in _CLOSED_TYPES]
_REPORTED = [("incident_at", "long"), ("event_id", "string"), ("severity", "string"), ("expires_at", "long")]


def _combine_readings(frame: pd.DataFrame) -> pd.DataFrame:
    grouped = frame.groupby(["intersection_id", "window_end"], as_index=False, sort=False)
    found = grouped.agg(
        event_time=("event_time", "max"),
        total_vehicles=("total_vehicles", "sum"),
        speed_sum=("speed_sum", "sum"),
        speed_readings=("speed_readings", "sum"),
        speed_rest=("speed_rest", "sum"),
        speed_nans=("speed_nans", "sum"),
        min_produced_at=("min_produced_at", "min"),
    )
    # Pandas leaves NaN out of sums: infinities of both signs are counted as NaN instead.
    lost = found["speed_rest"].isna()
    return found.assign(
        speed_rest=found["speed_rest"].mask(lost, 0.0), speed_nans=found["speed_nans"] + lost
    )


def _combine_incidents(frame: pd.DataFrame, grid: int) -> pd.DataFrame:
    """Drop incidents that no window end can tell from another one.

    Incidents between two neighbouring window ends come into view together. Of
    those only the last reported and the longest of each severity can matter.
    """
    frame = frame.assign(_view=-(-frame["incident_at"].astype("int64") // grid))
    view = ["intersection_id", "_view"]
    newest = frame.sort_values(["incident_at", "event_id"]).drop_duplicates(view, keep="last")
    longest = frame.sort_values("expires_at").drop_duplicates([*view, "severity"], keep="last")
    return pd.concat([newest, longest]).drop_duplicates().drop(columns="_view")


def _combiner(combine):
    """Combine rows of a source partition, holding no more than about a frame of them.

    What does not shrink is handed on: rows are combined again behind the shuffle, so
    emitting early changes no result, and time and memory stay in proportion.
    """

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(**{name: None for name in _COLUMNS if name not in frame})[_COLUMNS]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for frame in frames:
            kept = combine(frame if kept is None else pd.concat([kept, frame], ignore_index=True))
            if len(kept) > len(frame):
                yield whole(kept)
                kept = None
        if kept is not None and len(kept):
            yield whole(kept)

    return run


def _gather(
    frames: Iterator[pd.DataFrame], grid: int
) -> tuple[pd.DataFrame | None, pd.DataFrame | None]:
    """Readings and incidents of one key, combined frame by frame as they arrive."""
    combiners = _combine_readings, partial(_combine_incidents, grid=grid)
    parts: tuple[list, list] = [], []
    combined = [0, 0]
    for frame in frames:
        is_incident = frame["incident_at"].notna()
        for i, part in enumerate((frame[~is_incident], frame[is_incident])):
            if len(part):
                parts[i].append(part)
                # Combined at geometric sizes, so that each row is combined few times.
                if sum(map(len, parts[i])) > 2 * combined[i] + 1000:
                    parts[i][:] = [combiners[i](pd.concat(parts[i]))]
                    combined[i] = len(parts[i][0])
    done = [combine(pd.concat(p)) if p else None for combine, p in zip(combiners, parts)]
    return done[0], done[1]


def severities(ends: np.ndarray, incidents: list[tuple]) -> tuple[list[str], list[str]]:
    """``(latest, worst)`` severity at each window end.

    ``incidents`` holds ``(event time, event id, severity, expiry)``.
    """
    ordered = sorted(incidents)
    starts = np.array([i[0] for i in ordered], dtype="int64")
    expiries = np.array([i[3] for i in ordered], dtype="int64")
    index = np.searchsorted(starts, ends, side="right") - 1
    latest = [
        ordered[i][2] if i >= 0 and ordered[i][3] >= end else "NONE" for i, end in zip(index, ends)
    ]
    worst = np.zeros(len(ends), dtype="int64")
    for severity, rank in SEVERITY_RANK.items():
        own = np.array([i[2] == severity for i in ordered], dtype=bool)
        if rank == 0 or not own.any():
            continue
        until = np.maximum.accumulate(np.where(own, expiries, -_FAR))
        active = (index >= 0) & (until[np.maximum(index, 0)] >= ends)
        worst = np.maximum(worst, np.where(active, rank, 0))
    names = {rank: severity for severity, rank in SEVERITY_RANK.items()}
    return latest, [names[int(rank)] for rank in worst]


def still_needed(incidents: list[tuple], horizon: int) -> list[tuple]:
    """Incidents that windows ending after ``horizon`` can still see.

    An expired one is kept if it is the newest up to the horizon, since it hides
    older ones from the ``latest`` reading.
    """
    past = [i for i in incidents if i[0] <= horizon]
    newest = max(past) if past else None
    return [i for i in incidents if i[3] >= horizon or i is newest]


class _Signals(StatefulProcessor):
    """Open windows and live incidents of one intersection."""

    def __init__(self, length_micros: int, delay_micros: int, idle_micros: int):
        self.length = length_micros
        self.delay = delay_micros
        self.idle = idle_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState(
            "windows",
            "window_end long",
            "total_vehicles long, speed_sum long, speed_readings long, speed_rest double, "
            "speed_nans long, min_produced_at long",
        )
        self.incidents = handle.getMapState(
            "incidents", "incident_at long, event_id string", "severity string, expires_at long"
        )
        self.clock = handle.getValueState("clock", "newest long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        readings, reported = _gather(rows, self.length)
        known = self._load_incidents()
        if reported is not None:
            for row in reported.itertuples(index=False):
                known[(int(row.incident_at), row.event_id)] = (row.severity, int(row.expires_at))
        newest = self.clock.get()[0] if self.clock.exists() else None
        if readings is None:
            readings = pd.DataFrame(columns=_COLUMNS)
        elif newest is not None:
            readings = readings[readings["window_end"] > newest - self.delay]
        open_windows = self._load_windows()
        changed = {}
        for row in readings.itertuples(index=False):
            end = int(row.window_end)
            changed[end] = _merged(
                open_windows.get(end),
                (
                    int(row.total_vehicles),
                    int(row.speed_sum),
                    int(row.speed_readings),
                    float(row.speed_rest),
                    int(row.speed_nans),
                    None if pd.isna(row.min_produced_at) else int(row.min_produced_at),
                ),
            )
        if changed:
            yield self._emit(key[0], changed, known)
            seen = int(readings["event_time"].max().value // 1000)
            newest = seen if newest is None else max(newest, seen)
            self.clock.update((newest,))
        if newest is not None:
            horizon = newest - self.delay
            for end in open_windows:
                if end <= horizon:
                    self.windows.removeKey((end,))
            for end, value in changed.items():
                if end > horizon:
                    self.windows.updateValue((end,), value)
            known = self._pruned(known, horizon)
        elif known:
            # No reading has come yet: expired incidents wait for late ones, but not for ever.
            known = self._pruned(known, max(at for at, _ in known) - self.idle)
        self._store_incidents(known)

    def close(self) -> None:
        pass

    def _load_windows(self) -> dict:
        return {k[0]: tuple(v) for k, v in self.windows.iterator()}

    def _load_incidents(self) -> dict:
        self._stored = {tuple(k): tuple(v) for k, v in self.incidents.iterator()}
        return dict(self._stored)

    def _store_incidents(self, known: dict) -> None:
        for k in self._stored.keys() - known.keys():
            self.incidents.removeKey(k)
        for k, v in known.items():
            if self._stored.get(k) != v:
                self.incidents.updateValue(k, v)

    @staticmethod
    def _pruned(known: dict, horizon: int) -> dict:
        kept = still_needed([(*k, *v) for k, v in known.items()], horizon)
        return {i[:2]: i[2:] for i in kept}

    @staticmethod
    def _emit(key: str, windows: dict, known: dict) -> pd.DataFrame:
        ends = np.array(sorted(windows), dtype="int64")
        latest, worst = severities(ends, [(*k, *v) for k, v in known.items()])
        values = [windows[end] for end in ends]
        return pd.DataFrame({
            "intersection_id": key,
            "window_end": ends,
            **{name: [v[i] for v in values] for i, name in enumerate(_SUMS)},
            "min_produced_at": pd.array([v[-1] for v in values], dtype="Int64"),
            "latest_severity": latest,
            "worst_severity": worst,
        })


class _Blocks(StatefulProcessor):
    """Incidents that the windows of one intersection and block of time can see."""

    def __init__(self, length_micros: int, block_micros: int):
        self.length = length_micros
        self.block = block_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.incidents = handle.getMapState(
            "incidents", "incident_at long, event_id string", "severity string, expires_at long"
        )

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        windows, reported = [], None
        for frame in rows:
            is_incident = frame["incident_at"].notna()
            windows.append(frame[~is_incident])
            if is_incident.any():
                both = frame[is_incident] if reported is None else pd.concat([reported, frame[is_incident]])
                reported = _combine_incidents(both, self.length)
        if reported is not None:
            for row in reported.itertuples(index=False):
                self.incidents.updateValue(
                    (int(row.incident_at), row.event_id), (row.severity, int(row.expires_at))
                )
        # The block ends for good when the watermark has closed its last window.
        self.handle.registerTimer((int(key[1]) + 1) * self.block // 1000)
        closed = pd.concat(windows)
        if len(closed):
            known = [(*k, *v) for k, v in self.incidents.iterator()]
            latest, worst = severities(closed["window_end"].to_numpy("int64"), known)
            numbers = {name: closed[name].to_numpy() for name in _CLOSED[1:-2]}
            yield pd.DataFrame(
                {"intersection_id": key[0], **numbers, "latest_severity": latest, "worst_severity": worst}
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.incidents.clear()
        return iter(())

    def close(self) -> None:
        pass


def _final_severities(
    vehicles: DataFrame, incidents: DataFrame, length: str, delay: str, block: str, horizon: str
) -> DataFrame:
    size, width = seconds_of(length) * 1_000_000, seconds_of(block) * 1_000_000
    if width % size:
        raise ValueError(f"a block ({block}) must hold whole windows ({length})")
    metrics = window_metrics(
        vehicles.filter("intersection_id IS NOT NULL").withWatermark("event_time", delay), length, with_event_time=True
    )
    values = [c.split()[0] for c in _CLOSED_TYPES[2:-2]]
    windows = metrics.selectExpr(
        "intersection_id",
        f"(unix_micros(window_end) - 1) div {width}L AS block",
        "window_time",
        "unix_micros(window_end) AS window_end",
        "unix_micros(min_produced_at) AS min_produced_at",
        *[v for v in values if v != "min_produced_at"],
        *[f"CAST(NULL AS {kind}) AS {name}" for name, kind in _REPORTED],
    )
    reported = incidents.mapInPandas(_combiner(partial(_combine_incidents, grid=size)), _INPUT)
    last = f"greatest(expires_at, incident_at + {seconds_of(horizon)} * 1000000L)"
    reported = reported.selectExpr(
        "intersection_id",
        # A window that ends at the incident's time, in the block before, sees it too.
        f"explode(sequence((incident_at - 1) div {width}L, {last} div {width}L)) AS block",
        # Not an event time: an incident is never late, and cannot move the watermark.
        "TIMESTAMP'2200-01-01 00:00:00' AS window_time",
        "CAST(NULL AS LONG) AS window_end",
        "CAST(NULL AS LONG) AS min_produced_at",
        *[f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in _CLOSED_TYPES[2:-2] if "min_prod" not in c],
        *[name for name, _ in _REPORTED],
    )
    return (
        windows.unionByName(reported)
        .groupBy("intersection_id", "block")
        .transformWithStateInPandas(
            _Blocks(size, width), outputStructType=", ".join(_CLOSED_TYPES), outputMode="append", timeMode="EventTime"
        )
    )


def _merged(old, new):
    if old is None:
        return new
    produced = [p for p in (old[-1], new[-1]) if p is not None]
    sums = [a + b for a, b in zip(old[:-1], new[:-1])]
    if sums[3] != sums[3]:
        sums[3], sums[4] = 0.0, sums[4] + 1
    return (*sums, min(produced) if produced else None)


def stream_severities(
    vehicles: DataFrame,
    incidents: DataFrame,
    length: str = "1 second",
    delay: str = "1 second",
    emit: str = "update",
    idle: str = "1 hour",
    block: str = "1 hour",
    horizon: str = "8 hours",
) -> DataFrame:
    """Window metrics with ``latest_severity`` and ``worst_severity`` from two decoded streams.

    Write the result in update mode for ``emit="update"`` and in append mode for
    ``"final"``. Rows without an intersection have no key and must be split off
    before (``split_bad_records``); they are left out here. An intersection without any
    reading forgets incidents that expired ``idle`` before its newest one (``update``).

    ``final`` copies an incident to each ``block`` within ``horizon`` of its time or, if that is
    later, until it expires. A newer incident hides older ones from ``latest_severity`` that
    long, so ``horizon`` should be no less than the longest life.
    """
    if emit not in ("update", "final"):
        raise ValueError(f"emit must be 'update' or 'final', not {emit!r}")
    size = seconds_of(length)
    reported = (
        incident_lifetimes(incidents)
        .filter("intersection_id IS NOT NULL AND expires_at >= event_time")
        .selectExpr(
            "intersection_id",
            "event_time",
            "unix_micros(event_time) AS incident_at",
            "CAST(event_id AS STRING) AS event_id",
            "severity",
            "unix_micros(expires_at) AS expires_at",
        )
    )
    if emit == "final":
        closed = _final_severities(vehicles, reported, length, delay, block, horizon)
        return _named(closed, size, "speed_rest")
    produced = "produced_at"
    if dict(vehicles.dtypes)[produced] == "string":
        produced = parse_produced_at(produced)
    speed = to_fixed("average_speed_kmh")
    readings = vehicles.filter("intersection_id IS NOT NULL").selectExpr(
        "intersection_id",
        "event_time",
        f"1000000L * {size} * (unix_seconds(event_time) div {size} + 1) AS window_end",
        "coalesce(CAST(vehicle_count AS BIGINT), 0L) AS total_vehicles",
        f"coalesce({speed}, 0L) AS speed_sum",
        "if(average_speed_kmh IS NULL, 0L, 1L) AS speed_readings",
        f"if(isnan(average_speed_kmh), 0D, {beyond_fixed('average_speed_kmh')}) AS speed_rest",
        "if(isnan(average_speed_kmh), 1L, 0L) AS speed_nans",
        f"unix_micros({produced}) AS min_produced_at",
    )
    united = readings.mapInPandas(_combiner(_combine_readings), _INPUT).unionByName(
        reported.mapInPandas(
            _combiner(partial(_combine_incidents, grid=size * 1_000_000)), _INPUT
        )
    )
    emitted = united.groupBy("intersection_id").transformWithStateInPandas(
        _Signals(size * 1_000_000, seconds_of(delay) * 1_000_000, seconds_of(idle) * 1_000_000),
        outputStructType=_OUTPUT,
        outputMode="update",
        timeMode="None",
    )
    return _named(emitted, size, "if(speed_nans > 0, double('NaN'), speed_rest)")


def _named(emitted: DataFrame, size: int, speed_rest: str) -> DataFrame:
    return emitted.selectExpr(
        "intersection_id",
        f"timestamp_micros(window_end - {size} * 1000000L) AS window_start",
        "timestamp_micros(window_end) AS window_end",
        "total_vehicles",
        "speed_sum",
        "speed_readings",
        f"{speed_rest} AS speed_rest",
        "timestamp_micros(min_produced_at) AS min_produced_at",
        "latest_severity",
        "worst_severity",
    )


def stream_decisions(
    vehicles: DataFrame,
    incidents: DataFrame,
    length: str = "1 second",
    delay: str = "1 second",
    emit: str = "update",
    severity: str = "latest_severity",
    rules: SignalRules = SignalRules(),
) -> DataFrame:
    """Signal plans as they become known; the rule itself stays a native expression."""
    found = stream_severities(vehicles, incidents, length, delay, emit)
    return decide(found, severity, rules)
