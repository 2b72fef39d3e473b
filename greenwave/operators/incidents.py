"""Incident life times and the incident state in force at a point in time.

Two readings of "the incident at time t" are offered and never mixed:

``latest``  the incident reported last up to t, if it has not expired by t;
            a later minor incident hides an earlier severe one.
``worst``   the highest severity among all incidents active at t.

Both bounds are inclusive: an incident counts from its event time up to and
including its expiry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.functions import (
    DEFAULT_DURATION_MIN,
    SEVERITY_RANK,
    expiry,
    or_default,
    severity_rank,
)

# Severities that outrank NONE, worst first, each with its "furthest expiry" column.
_UNTIL = {
    severity: f"_until_{severity.lower()}"
    for severity, rank in sorted(SEVERITY_RANK.items(), key=lambda item: -item[1])
    if rank > 0
}


def incident_lifetimes(incidents: DataFrame) -> DataFrame:
    """Defaults applied, with ``severity_rank`` and ``expires_at`` added.

    Duration 0 or NULL means 30 minutes; severity '' or NULL means NONE.
    """
    filled = {
        "estimated_duration_min": or_default("estimated_duration_min", 0, DEFAULT_DURATION_MIN),
        "severity": or_default("severity", "", "NONE"),
    }
    return incidents.selectExpr(
        *[f"{filled[c]} AS {c}" if c in filled else c for c in incidents.columns]
    ).selectExpr(
        "*",
        f"{severity_rank('severity')} AS severity_rank",
        f"{expiry('event_time', 'estimated_duration_min')} AS expires_at",
    )


def live_incidents(incidents: DataFrame, arrival: str | None = None) -> DataFrame:
    """Life times of the incidents that had not expired when they arrived.

    Without an ``arrival`` column the arrival is the event time (in-order replay).
    """
    if arrival:
        return incident_lifetimes(incidents).filter(f"expires_at >= {arrival}")
    # The same test against the event time, on a stored column so that scans can use it.
    return incident_lifetimes(
        incidents.filter("estimated_duration_min IS NULL OR estimated_duration_min >= 0")
    )


def severity_at(
    points: DataFrame,
    incidents: DataFrame,
    time: str = "window_end",
    horizon: str | None = None,
    grid: str | None = None,
    block: str = "6 hours",
    want: Sequence[str] = ("latest_severity", "worst_severity", "incident_active"),
) -> DataFrame:
    """``points`` with ``latest_severity``, ``worst_severity`` and ``incident_active``.

    An as-of join and a stabbing-maximum join in one sort, with no pairs formed:

    * incidents at one instant of one intersection collapse to one row, after
      which a group holds at most one incident row per instant; with ``grid``,
      those that come into view at the same grid point collapse;
    * time is cut into ``block``s and every window function runs per
      (intersection, block), so a hot intersection is spread over as many tasks
      as it has blocks;
    * what is still in force when a block begins is carried in as one row,
      worked out on one small row per (intersection, block with incidents);
    * ``latest`` is the last incident row seen, ``worst`` needs only the furthest
      expiry seen so far for each severity.

    ``horizon`` bounds how long after its event time an incident may match,
    whatever its duration. ``grid`` promises that all points lie on multiples of a
    length, as the ends of windows of that length do. Points without an
    intersection match nothing. Name in ``want`` only the columns in use: both uses
    of the collapsed incidents then need the same columns, and Spark shuffles them
    once.
    """
    block_of = f"unix_seconds({{}}) div {seconds_of(block)}".format
    until = f"least(expires_at, event_time + INTERVAL {horizon})" if horizon else "expires_at"
    in_view = "event_time"
    if grid:
        micros = f"unix_micros(event_time) + pmod(-unix_micros(event_time), {seconds_of(grid)}000000L)"
        in_view = f"timestamp_micros({micros})"
    life = (
        live_incidents(incidents)
        .filter("intersection_id IS NOT NULL")
        .selectExpr("*", f"{in_view} AS _at")
        .selectExpr(
            "intersection_id",
            "_at",
            f"{block_of('_at')} AS _block",
            "event_time",
            "event_id",
            "severity",
            f"{until} AS _end",
        )
    )
    # Furthest expiry so far, by what it is for; all are running maxima.
    ends = {}
    if "worst_severity" in want:
        for severity, name in _UNTIL.items():
            ends[name] = f"max(CASE WHEN severity = '{severity}' THEN _end END)"
    if "incident_active" in want:
        ends["_until_any"] = "max(_end)"
    newest = ["_severity", "_expires_at"] if "latest_severity" in want else []
    collapse, pick_newest, unpack = [f"{e} AS {n}" for n, e in ends.items()], [], []
    if newest:
        collapse.append(
            "max(struct(event_time, event_id, severity AS _severity, _end AS _expires_at)) AS _last"
        )
        pick_newest = ["max(struct(_at, _severity, _expires_at)) AS _last"]
        unpack = [f"_last.{name} AS {name}" for name in newest]
    instants = (
        life.groupBy("intersection_id", "_block", "_at")
        .agg(*map(F.expr, collapse))
        .selectExpr("intersection_id", "_block", "_at", "1 AS _order", *unpack, *ends)
    )

    # One row per (intersection, block with incidents): what holds after that block,
    # wanted in the blocks up to its last expiry or the next block with incidents.
    by_block = "(PARTITION BY intersection_id ORDER BY _block{})".format
    up_to_here = by_block(" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    heads = (
        instants.groupBy("intersection_id", "_block")
        .agg(*map(F.expr, [*pick_newest, *[f"max({name}) AS {name}" for name in ends]]))
        .selectExpr(
            "intersection_id",
            *unpack,
            *[f"max({name}) OVER {up_to_here} AS {name}" for name in ends],
            "_block + 1 AS _from",
            f"lead(_block) OVER {by_block('')} AS _next",
        )
    )
    last_blocks = ", ".join(block_of(name) for name in [*newest[1:], *ends])
    carried = heads.selectExpr(
        "*", f"least(array_max(array({last_blocks})), _next) AS _to"
    ).selectExpr(
        "intersection_id",
        "explode(CASE WHEN _to >= _from THEN sequence(_from, _to) END) AS _block",
        "CAST(NULL AS TIMESTAMP) AS _at",
        "0 AS _order",
        *newest,
        *ends,
    )

    marked = points.selectExpr(
        "*", f"{block_of(time)} AS _block", f"{time} AS _at", "2 AS _order"
    )
    merged = marked.unionByName(instants.unionByName(carried), allowMissingColumns=True)
    # A carried row has no instant and so opens its block (nulls sort first); at one
    # instant the incident comes before the points.
    seen = (
        "(PARTITION BY intersection_id, _block ORDER BY _at, _order "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    scanned = merged.selectExpr(
        *points.columns,
        "_order",
        *[f"last({name}, true) OVER {seen} AS {name}" for name in newest],
        *[f"max({name}) OVER {seen} AS {name}" for name in ends],
    ).filter("_order = 2")
    active = " ".join(f"WHEN {name} >= {time} THEN '{sev}'" for sev, name in _UNTIL.items())
    answers = {
        "latest_severity": f"CASE WHEN _expires_at >= {time} THEN _severity ELSE 'NONE' END",
        "worst_severity": f"CASE {active} ELSE 'NONE' END",
        "incident_active": f"coalesce(_until_any >= {time}, false)",
    }
    return scanned.selectExpr(*points.columns, *[f"{answers[name]} AS {name}" for name in want])


def interval_join(
    points: DataFrame,
    incidents: DataFrame,
    time: str = "window_end",
    horizon: str = "8 hours",
    bucket: str = "1 hour",
    how: str = "left",
    salts: int = 1,
    grid: str | None = None,
) -> DataFrame:
    """Every point with every incident active at it, one row per matching pair.

    Matches satisfy ``event_time <= time <= event_time + horizon`` and
    ``time <= expires_at``. Incidents are listed under each time bucket they
    touch and joined by equality on (intersection, bucket); a point lies in
    exactly one bucket, so no pair comes twice. The result has as many rows as
    there are matches; where only the severity is wanted, ``severity_at`` gives
    it without forming pairs.

    With ``how="left"`` unmatched points follow with severity NONE. They are found
    by ``severity_at`` rather than an outer join: an inner join may be split by
    AQE on either skewed side, an outer one only on the points' side. ``salts``
    splits each bucket's incidents ahead of time at the price of copying points;
    ``grid`` is as in ``severity_at``.
    """
    bucket_of = f"unix_seconds({{}}) div {seconds_of(bucket)}".format
    right = live_incidents(incidents).filter("intersection_id IS NOT NULL").selectExpr(
        "intersection_id AS _at_intersection",
        "event_id AS incident_event_id",
        "event_time AS incident_time",
        "severity AS incident_severity",
        "severity_rank AS incident_rank",
        "expires_at",
        f"least(expires_at, event_time + INTERVAL {horizon}) AS _until",
        *([f"pmod(xxhash64(event_id), {salts}) AS _salt"] if salts > 1 else []),
    )
    right = right.selectExpr(
        "*",
        f"explode(sequence({bucket_of('incident_time')}, {bucket_of('_until')})) AS _at_bucket",
    )
    left = points.selectExpr("*", f"{bucket_of(time)} AS _bucket")
    # Null-safe conditions: others would filter nulls out below the points, whose
    # shuffle could then not be shared with the search for unmatched ones.
    on = (
        "intersection_id <=> _at_intersection AND _bucket <=> _at_bucket "
        f"AND if({time} IS NULL, false, {time} BETWEEN incident_time AND _until)"
    )
    if salts > 1:
        left = left.selectExpr("*", f"explode(sequence(0L, {salts - 1}L)) AS _copy")
        on += " AND _copy = _salt"
    matched = (
        left.join(right, F.expr(on), "inner")
        .select(
            *points.columns,
            "incident_event_id",
            "incident_time",
            "incident_severity",
            "incident_rank",
            "expires_at",
        )
    )
    if how == "inner":
        return matched
    if how != "left":
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    unmatched = (
        severity_at(points, incidents, time, horizon, grid, want=("incident_active",))
        .filter("NOT incident_active")
        .selectExpr(*points.columns, "'NONE' AS incident_severity", "0 AS incident_rank")
    )
    return matched.unionByName(unmatched, allowMissingColumns=True)


def seconds_of(length: str) -> int:
    """Seconds in a length such as ``"6 hours"``."""
    count, unit = length.split()
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(count) * sizes[unit.rstrip("s")]
