"""The same queries as SQL for DuckDB, written independently of the operators.

Speeds are kept as integer hundredths and rounded half up in integers.
"""

from __future__ import annotations

from greenwave.functions.constants import (
    CAPACITY_REDUCTION,
    DIRECTIONS,
    HISTORY_SIZE,
    INCIDENT_TYPES,
    INTERSECTIONS,
    MODE_LABEL,
    MODE_SYMBOL,
    SEVERITY_SYMBOL,
    VEHICLE_TYPES,
)
from greenwave.plans.fixtures import TYPE_BY_K

ISO = "'%Y-%m-%dT%H:%M:%S'"


def _iso(column: str) -> str:
    return f"strftime({column}, {ISO})"


def _pick(values: list[str], index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {index} {cases} END)"


def _map(column: str, table: dict[str, str], default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"(CASE {column} {cases} ELSE '{default}' END)"


def _types() -> str:
    low = 0
    rows = []
    for last, name in TYPE_BY_K:
        severity, shortest, longest, frequency = INCIDENT_TYPES[name]
        lo, hi = CAPACITY_REDUCTION[severity]
        rows.append(
            f"('{name}', '{severity}', {shortest}, {longest}, {frequency}::DOUBLE, "
            f"{lo}::DOUBLE, {hi}::DOUBLE, {low}, {last})"
        )
        low = last + 1
    return ", ".join(rows)


RANK = "(CASE severity WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 WHEN 'CRITICAL' THEN 4 ELSE 0 END)"

BASE = f"""
incident_types(incident_type, severity, dmin, dmax, freq, cmin, cmax, k_lo, k_hi) AS (VALUES {_types()}),
vehicle_events AS (
  SELECT event_id, date_trunc('second', ts) AS event_time,
         {_pick(INTERSECTIONS, 'user_id % 8')} AS intersection_id,
         {_pick(DIRECTIONS, 'event_id % 4')} AS direction,
         CAST((event_id * 7) % 16 AS INTEGER) AS vehicle_count,
         {_pick(VEHICLE_TYPES, 'greatest(event_id % 10 - 5, 0)')} AS vehicle_type,
         500 + (event_id * 37) % 4000 AS speed_centi,
         CASE WHEN event_id % 17 = 0 OR (event_id * 7) % 16 > 10 THEN 'MEDIUM' ELSE 'LOW' END AS density_level
  FROM events WHERE event_type <> 'error'),
incident_events AS (
  SELECT e.event_id, date_trunc('second', e.ts) AS event_time,
         {_pick(INTERSECTIONS, 'e.user_id % 8')} AS intersection_id,
         t.incident_type, t.severity,
         CAST(dmin + e.event_id % (dmax - dmin + 1) AS INTEGER) AS estimated_duration_min,
         (10 + e.event_id % 91) / 100.0::DOUBLE AS capacity_reduction_factor,
         CAST(CASE WHEN t.severity IN ('HIGH', 'CRITICAL') THEN 1 + e.event_id % 2
                   ELSE e.event_id % 11 % 2 END AS INTEGER) AS lanes_blocked
  FROM events e JOIN incident_types t
    ON CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 25 BETWEEN k_lo AND k_hi
  WHERE e.event_type = 'error'),
incident_life AS (
  SELECT *, {RANK} AS severity_rank,
         event_time + to_minutes(estimated_duration_min) AS expires_at
  FROM incident_events)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join([BASE, *parts]) + "\n"


def _metrics(unit: str) -> str:
    start = f"date_trunc('{unit}', event_time)"
    return f"""
metrics AS (
  SELECT intersection_id, {start} AS window_start, {start} + INTERVAL 1 {unit} AS window_end,
         CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles,
         CAST(sum(speed_centi) AS BIGINT) AS centi, count(*) AS n,
         min(event_time) AS produced, min(event_id) AS first_event_id
  FROM vehicle_events GROUP BY ALL)"""


LATEST = """
one_per_instant AS (
  SELECT * FROM incident_life
  QUALIFY row_number() OVER (PARTITION BY intersection_id, event_time ORDER BY event_id DESC) = 1),
rated AS (
  SELECT m.*, CASE WHEN i.expires_at >= m.window_end THEN i.severity ELSE 'NONE' END AS sev
  FROM metrics m ASOF LEFT JOIN one_per_instant i
    ON m.intersection_id = i.intersection_id AND m.window_end >= i.event_time)"""

WORST = """
rated AS (
  SELECT m.*, CASE max(i.severity_rank) WHEN 4 THEN 'CRITICAL' WHEN 3 THEN 'HIGH'
              WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' ELSE 'NONE' END AS sev
  FROM metrics m LEFT JOIN incident_life i
    ON m.intersection_id = i.intersection_id
   AND m.window_end BETWEEN i.event_time AND i.expires_at
  GROUP BY ALL)"""

SPEED = "((2 * centi + n) // (2 * n))"


def _mode(total: str, speed_centi: str, severity: str) -> str:
    return f"""(CASE WHEN {severity} = 'CRITICAL' THEN 'EMERGENCY'
      WHEN {speed_centi} < 1500 THEN 'CONGESTION'
      WHEN (CASE WHEN {total} > 20 THEN 80 WHEN {total} > 10 THEN 50 ELSE 20 END)
         + (CASE {severity} WHEN 'CRITICAL' THEN 40 WHEN 'HIGH' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 0 END) >= 80
      THEN 'DENSE'
      WHEN (CASE WHEN {total} > 20 THEN 80 WHEN {total} > 10 THEN 50 ELSE 20 END)
         + (CASE {severity} WHEN 'CRITICAL' THEN 40 WHEN 'HIGH' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 0 END) >= 50
      THEN 'MODERATE' ELSE 'FLUID' END)"""


GREEN = (
    "CAST(CASE traffic_mode WHEN 'EMERGENCY' THEN 5 WHEN 'CONGESTION' THEN 60 WHEN 'DENSE' THEN 60 "
    "WHEN 'MODERATE' THEN 40 ELSE 20 END AS INTEGER)"
)

PLANS = f"""
moded AS (SELECT *, {_mode('total_vehicles', SPEED, 'sev')} AS traffic_mode FROM rated),
plans AS (
  SELECT intersection_id, {_iso('window_start')} AS window_start, {_iso('window_end')} AS window_end,
         total_vehicles, {SPEED} / 100.0::DOUBLE AS avg_speed_kmh, sev AS worst_severity, traffic_mode,
         {GREEN} AS green_duration_sec, CAST(90 - {GREEN} AS INTEGER) AS red_duration_sec,
         window_end + to_seconds(first_event_id % 5) AS decided, produced, first_event_id
  FROM moded)"""

DECISION_COLUMNS = (
    "intersection_id, window_start, window_end, total_vehicles, avg_speed_kmh, worst_severity, "
    "traffic_mode, green_duration_sec, red_duration_sec"
)

RECORD_REST = [*DECISION_COLUMNS.split(", ")[1:], "decision_timestamp"]

RECORDS = f"""
records AS (
  SELECT {DECISION_COLUMNS}, {_iso('decided')} AS decision_timestamp,
         CAST(epoch_ms(decided) - epoch_ms(produced) AS DOUBLE) AS e2e_latency_ms, decided, first_event_id
  FROM plans),
received AS (
  SELECT * EXCLUDE (decided, first_event_id),
         decided + to_milliseconds(first_event_id % 700) AS received_at,
         CAST(first_event_id % 700 AS DOUBLE) AS latency_ms
  FROM records)"""

SECOND_RECORDS = (_metrics("second"), LATEST, PLANS, RECORDS)

STATE = """
state AS (
  SELECT * FROM received
  QUALIFY row_number() OVER (PARTITION BY intersection_id ORDER BY received_at DESC, window_start DESC) = 1)"""

STATE_COLUMNS = "* REPLACE (strftime(received_at, '%Y-%m-%dT%H:%M:%S.%g') AS received_at)"


def _decode(table: str, prefix: str, columns: str) -> str:
    present = "CASE WHEN event_id % 100 <> 7 THEN intersection_id END"
    return _with() + f"""
SELECT '{prefix}_' || intersection_id || '_' || epoch_ms(event_time) AS event_id,
       {_iso('event_time')} AS "timestamp", {present} AS intersection_id,
       {columns}, {_iso('event_time')} AS event_time
FROM {table} WHERE event_id % 100 NOT BETWEEN 1 AND 6"""


def _severity(rated: str, column: str) -> str:
    return _with(_metrics("second"), rated) + (
        f"SELECT intersection_id, {_iso('window_end')} AS window_end, sev AS {column} FROM rated"
    )


def _decisions(rated: str) -> str:
    return _with(_metrics("hour"), rated, PLANS) + f"SELECT {DECISION_COLUMNS} FROM plans"


def _window_metrics(unit: str) -> str:
    return _with(_metrics(unit)) + f"""
SELECT intersection_id, {_iso('window_start')} AS window_start, {_iso('window_end')} AS window_end,
       total_vehicles, CAST(centi * 100 AS DOUBLE) / (n * 10000.0::DOUBLE) AS avg_speed_kmh,
       {_iso('produced')} AS min_produced_at
FROM metrics"""


def _number(column: str) -> str:
    """Milliseconds as a float prints in the log; fixture values are whole."""
    return f"CAST(CAST({column} AS BIGINT) AS VARCHAR) || '.0'"


SPEED_TEXT = "regexp_replace(CAST(CAST(avg_speed_kmh AS DECIMAL(30, 2)) AS VARCHAR), '([.][0-9])0$', '\\1')"

VIOLATION = "count(*) FILTER (WHERE NOT coalesce({}, false))"


def _conformance() -> str:
    where = ", ".join(f"'{i}'" for i in INTERSECTIONS)
    incident_rules = {
        "known_type": "t.incident_type IS NOT NULL",
        "known_intersection": f"i.intersection_id IN ({where})",
        "severity_of_type": "i.severity = t.severity",
        "duration_in_range": "i.estimated_duration_min BETWEEN t.dmin AND t.dmax",
        "capacity_in_range": "i.capacity_reduction_factor BETWEEN t.cmin AND t.cmax",
        "lanes_by_severity": "CASE WHEN i.severity IN ('HIGH', 'CRITICAL') "
        "THEN i.lanes_blocked BETWEEN 1 AND 2 ELSE i.lanes_blocked = 0 END",
    }
    vehicle_rules = {
        "known_intersection": f"intersection_id IN ({where})",
        "count_not_negative": "vehicle_count >= 0",
        "speed_at_least_minimum": "speed_centi >= 500",
        "density_matches_count": "density_level = CASE WHEN vehicle_count > 20 THEN 'HIGH' "
        "WHEN vehicle_count > 10 THEN 'MEDIUM' ELSE 'LOW' END",
    }
    parts = [
        f"SELECT 'incidents' AS stream, '{name}' AS rule, count(*) AS checked, "
        f"{VIOLATION.format(rule)} AS violations FROM incident_events i "
        "LEFT JOIN incident_types t ON i.incident_type = t.incident_type"
        for name, rule in incident_rules.items()
    ] + [
        f"SELECT 'vehicles' AS stream, '{name}' AS rule, count(*) AS checked, "
        f"{VIOLATION.format(rule)} AS violations FROM vehicle_events"
        for name, rule in vehicle_rules.items()
    ]
    return _with() + "\nUNION ALL\n".join(parts)


BAND = """CASE WHEN h BETWEEN 7 AND 9 OR h BETWEEN 17 AND 19 THEN {0}
 WHEN h BETWEEN 12 AND 14 THEN {1} WHEN h BETWEEN 0 AND 5 THEN {2} ELSE {3} END"""

FOLD_STEP = """
 CASE WHEN acc.time IS NULL OR acc.expires_at < x.arrived OR x.rank > acc.rank OR x.time >= acc.time
      THEN x ELSE acc END"""

#: A decision for every single reading.
SINGLE = f""", single AS (
  SELECT intersection_id, {_iso('event_time')} AS window_start,
         {_iso('event_time + INTERVAL 1 SECOND')} AS window_end,
         CAST(vehicle_count AS BIGINT) AS total_vehicles, speed_centi / 100.0::DOUBLE AS avg_speed_kmh,
         'NONE' AS worst_severity,
         {_mode('vehicle_count', 'speed_centi', "'NONE'")} AS traffic_mode,
         {_iso('event_time + INTERVAL 1 SECOND')} AS decision_timestamp, 1000.0::DOUBLE AS e2e_latency_ms,
         event_time + to_seconds(event_id * 7919 % 7200) AS arrived,
         CAST(1000 * (event_id * 7919 % 7200 - 1) AS DOUBLE) AS latency_ms
  FROM vehicle_events)"""

#: Slice of the month in which a stream meets an event.
BORN = "(CASE WHEN day(ts) < 9 THEN 0 WHEN day(ts) < 17 THEN 1 WHEN day(ts) < 25 THEN 2 ELSE 3 END)"


def _statistics(rows: str, keys: str) -> str:
    """Latency statistics per ``keys`` of whole numbers ``v``."""
    return f"""ranked AS (
  SELECT {keys}, v, row_number() OVER (PARTITION BY {keys} ORDER BY v) - 1 AS i, count(*) OVER (PARTITION BY {keys}) AS n
  FROM {rows})
SELECT {keys}, any_value(n) AS sample_count,
       CAST((2 * CAST(sum(v) AS HUGEINT) * 100 + any_value(n)) // (2 * any_value(n)) AS DOUBLE) / 100.0::DOUBLE
         AS avg_latency_ms,
       min(v) AS min_latency_ms, max(v) AS max_latency_ms,
       max(v) FILTER (WHERE i = CAST(floor(n * 0.95::DOUBLE) AS BIGINT)) AS p95_latency_ms,
       max(v) FILTER (WHERE i = least(CAST(floor(n * 0.99::DOUBLE) AS BIGINT), n - 1)) AS p99_latency_ms,
       ((2 * 10000 * count(*) FILTER (WHERE v < 3000) + any_value(n)) // (2 * any_value(n))) / 100.0::DOUBLE
         AS sla_3sec_compliance_pct
FROM ranked GROUP BY {keys}"""


ORACLE: dict[str, str] = {
    "decode_vehicle_json": _decode(
        "vehicle_events",
        "VEH",
        f"{_iso('event_time')} AS produced_at, direction, vehicle_count, vehicle_type, "
        "speed_centi / 100.0::DOUBLE AS average_speed_kmh, density_level",
    ),
    "decode_incident_json": _decode(
        "incident_events",
        "INC",
        "incident_type, severity, estimated_duration_min, capacity_reduction_factor, lanes_blocked, "
        "incident_type || ' signalé à ' || intersection_id AS description",
    ),
    "bad_record_split": _with() + """
SELECT stream, CASE e WHEN 1 THEN 'malformed_json' WHEN 2 THEN 'malformed_json'
         WHEN 3 THEN 'missing_event_time' WHEN 4 THEN 'malformed_json'
         WHEN 5 THEN 'bad_event_time' WHEN 6 THEN 'bad_event_time'
         WHEN 7 THEN 'missing_intersection' ELSE 'ok' END AS reason, count(*) AS records
FROM (SELECT CASE WHEN event_type = 'error' THEN 'incidents' ELSE 'vehicles' END AS stream,
             event_id % 100 AS e FROM events)
GROUP BY 1, 2""",
    "composed_texts": _with() + """
SELECT event_id, 'INC_' || intersection_id || '_' || epoch_ms(event_time) AS incident_key,
       incident_type || ' signalé à ' || intersection_id AS description FROM incident_events""",
    "window_metrics_1s": _window_metrics("second"),
    "window_metrics_1h": _window_metrics("hour"),
    "incident_expiry": _with() + f"""
SELECT event_id, intersection_id, event_time, severity, {RANK} AS severity_rank, estimated_duration_min,
       strftime(strptime(event_time, {ISO}) + to_minutes(estimated_duration_min), {ISO}) AS expires_at
FROM (SELECT event_id, intersection_id, {_iso('event_time')} AS event_time,
             CASE WHEN event_id % 13 IN (0, 1) THEN 'NONE' ELSE severity END AS severity,
             CASE WHEN event_id % 11 IN (0, 1) THEN 30 ELSE estimated_duration_min END AS estimated_duration_min
      FROM incident_events)""",
    "incident_asof": _severity(LATEST, "latest_severity"),
    "worst_active_severity": _severity(WORST, "worst_severity"),
    "incident_interval_join": _with(_metrics("hour")) + f"""
SELECT m.intersection_id, {_iso('m.window_end')} AS window_end, m.total_vehicles,
       i.event_id AS incident_event_id, {_iso('i.event_time')} AS incident_time,
       coalesce(i.severity, 'NONE') AS incident_severity, coalesce(i.severity_rank, 0) AS incident_rank,
       {_iso('i.expires_at')} AS expires_at
FROM metrics m LEFT JOIN incident_life i
  ON m.intersection_id = i.intersection_id AND m.window_end >= i.event_time
 AND m.window_end <= i.event_time + INTERVAL 8 HOUR AND m.window_end <= i.expires_at""",
    "incident_fold": _with() + f"""
SELECT intersection_id, s.severity AS severity, s.rank AS severity_rank,
       {_iso('s.time')} AS event_time, {_iso('s.expires_at')} AS expires_at
FROM (SELECT intersection_id, list_reduce(
        list({{'severity': severity, 'rank': severity_rank, 'time': event_time,
               'expires_at': expires_at, 'arrived': arrived}} ORDER BY arrived, event_id),
        lambda acc, x: {FOLD_STEP}) AS s
      FROM (SELECT *, event_time + to_seconds((event_id * 7919) % 7200) AS arrived FROM incident_life)
      WHERE expires_at >= arrived GROUP BY intersection_id)""",
    "decisions_latest": _decisions(LATEST),
    "decisions_worst": _decisions(WORST),
    "decision_grid": f"""
WITH cases AS (
  SELECT event_id, CASE WHEN event_id % 41 = 0 THEN 0 ELSE event_id * 7 % 45 END AS total_vehicles,
         CASE WHEN event_id % 43 = 0 THEN 0 ELSE (14000 + event_id * 137 % 2000 + 5) // 10 END AS centi,
         CASE event_id % 7 WHEN 1 THEN 'LOW' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'HIGH'
           WHEN 4 THEN 'CRITICAL' WHEN 5 THEN 'UNKNOWN_X' ELSE 'NONE' END AS worst_severity
  FROM events),
moded AS (SELECT *, {_mode('total_vehicles', 'centi', 'worst_severity')} AS traffic_mode FROM cases)
SELECT event_id, total_vehicles, centi / 100.0::DOUBLE AS avg_speed_kmh, worst_severity, traffic_mode,
       {GREEN} AS green_duration_sec, CAST(90 - {GREEN} AS INTEGER) AS red_duration_sec FROM moded""",
    "decision_json": _with(*SECOND_RECORDS)
    + f"SELECT intersection_id AS key, {DECISION_COLUMNS}, decision_timestamp, e2e_latency_ms FROM records",
    "status_line": _with(*SECOND_RECORDS) + f"""
SELECT intersection_id, window_start, '[Spark] ' || {_map('traffic_mode', MODE_LABEL, '?')} || ' ' || intersection_id
  || ' | ' || traffic_mode || ' | Veh:' || total_vehicles || ' | ' || {SPEED_TEXT} || 'km/h | Sev:' || worst_severity
  || ' | Vert:' || green_duration_sec || 's Rouge:' || red_duration_sec || 's | Latence E2E:'
  || {_number('e2e_latency_ms')} || 'ms' AS line FROM records""",
    "receipt_line": _with(*SECOND_RECORDS) + f"""
SELECT intersection_id, window_start, '[DecisionService] ' || {_map('traffic_mode', MODE_SYMBOL, '⚪')} || ' '
  || intersection_id || ' | Mode: ' || traffic_mode || ' | Vert: ' || green_duration_sec || 's | Véhicules: '
  || total_vehicles || ' | Latence Kafka: ' || {_number('latency_ms')} || 'ms | Latence E2E: '
  || {_number('e2e_latency_ms')} || 'ms' AS line FROM received""",
    "logged_time": f"""
SELECT event_id, CASE event_id % 8 WHEN 0 THEN sec WHEN 1 THEN mic WHEN 2 THEN replace(sec, 'T', ' ')
         WHEN 3 THEN replace(mic, 'T', ' ') WHEN 4 THEN '  ' || replace(sec, 'T', ' ') || ' '
         WHEN 5 THEN left(sec, 10) WHEN 6 THEN sec || 'Z' ELSE '' END AS logged,
       CASE WHEN event_id % 8 IN (0, 2, 4) THEN sec || '.000000'
            WHEN event_id % 8 IN (1, 3) THEN mic END AS parsed
FROM (SELECT event_id, {_iso('ts')} AS sec, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS mic FROM events)""",
    "e2e_latency": _with(*SECOND_RECORDS)
    + "SELECT intersection_id, window_start, e2e_latency_ms FROM received",
    "hop_latency": _with(*SECOND_RECORDS)
    + "SELECT intersection_id, window_start, latency_ms FROM received",
    "latency_history": _with(*SECOND_RECORDS) + f"""
SELECT intersection_id, window_start, e2e_latency_ms FROM received WHERE e2e_latency_ms >= 0
ORDER BY received_at DESC, intersection_id DESC, window_start DESC LIMIT {HISTORY_SIZE}""",
    "latency_summary": _with(*SECOND_RECORDS) + f"""
, history AS (
  SELECT e2e_latency_ms AS v FROM received WHERE e2e_latency_ms >= 0
  ORDER BY received_at DESC, intersection_id DESC, window_start DESC LIMIT {HISTORY_SIZE}),
ranked AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM history)
SELECT any_value(n) AS sample_count,
       CAST((2 * CAST(sum(v) AS HUGEINT) * 100 + any_value(n)) // (2 * any_value(n)) AS DOUBLE) / 100.0::DOUBLE
         AS avg_latency_ms,
       min(v) AS min_latency_ms, max(v) AS max_latency_ms,
       max(v) FILTER (WHERE i = CAST(floor(n * 0.95::DOUBLE) AS BIGINT)) AS p95_latency_ms,
       max(v) FILTER (WHERE i = least(CAST(floor(n * 0.99::DOUBLE) AS BIGINT), n - 1)) AS p99_latency_ms,
       ((2 * 10000 * count(*) FILTER (WHERE v < 3000) + any_value(n)) // (2 * any_value(n))) / 100.0::DOUBLE
         AS sla_3sec_compliance_pct
FROM ranked""",
    "latency_summary_all": _with(*SECOND_RECORDS) + f"""
, scoped AS (
  SELECT unnest(['ALL', intersection_id]) AS scope, e2e_latency_ms, latency_ms FROM received),
vals AS (
  SELECT scope, 'e2e' AS measure, e2e_latency_ms AS v FROM scoped WHERE e2e_latency_ms >= 0
  UNION ALL SELECT scope, 'hop', latency_ms FROM scoped WHERE latency_ms >= 0),
{_statistics("vals", "scope, measure")}""",
    "latest_state": _with(*SECOND_RECORDS, STATE) + f"SELECT {STATE_COLUMNS} FROM state",
    "state_report": _with(*SECOND_RECORDS, STATE) + f"""
SELECT intersection_id, {_map('traffic_mode', MODE_SYMBOL, '')} AS mode_symbol, traffic_mode, total_vehicles,
       ((CAST(round(avg_speed_kmh * 100) AS BIGINT) + 5) // 10) / 10.0::DOUBLE AS avg_speed_kmh,
       {_map('worst_severity', SEVERITY_SYMBOL, '')} AS severity_symbol, worst_severity,
       green_duration_sec, red_duration_sec, latency_ms, e2e_latency_ms FROM state""",
    "state_lookup": _with(*SECOND_RECORDS, STATE)
    + f"SELECT {STATE_COLUMNS} FROM state WHERE intersection_id = '{INTERSECTIONS[1]}'",
    "state_counts": _with(*SECOND_RECORDS, STATE)
    + "SELECT count(DISTINCT intersection_id) AS intersections_monitored FROM state",
    "density_class": _with() + """
SELECT event_id, vehicle_count, density_level, density_class, density_level = density_class AS density_agrees
FROM (SELECT *, CASE WHEN vehicle_count > 20 THEN 'HIGH' WHEN vehicle_count > 10 THEN 'MEDIUM'
             ELSE 'LOW' END AS density_class FROM vehicle_events)""",
    "hour_band": _with() + f"""
SELECT event_id, {_iso('event_time')} AS event_time,
       {BAND.format("'PEAK'", "'MIDDAY'", "'NIGHT'", "'NORMAL'")} AS hour_band,
       {BAND.format('1.5::DOUBLE', '1.0::DOUBLE', '0.1::DOUBLE', '0.5::DOUBLE')} AS min_factor,
       {BAND.format('2.5::DOUBLE', '1.5::DOUBLE', '0.3::DOUBLE', '1.0::DOUBLE')} AS max_factor
FROM (SELECT *, hour(event_time) AS h FROM vehicle_events)""",
    "incident_enriched": _with() + f"""
SELECT i.* REPLACE ({_iso('i.event_time')} AS event_time), t.severity AS type_severity,
       t.dmin AS min_duration, t.dmax AS max_duration, t.freq AS type_frequency,
       t.cmin AS min_capacity_reduction, t.cmax AS max_capacity_reduction
FROM incident_events i LEFT JOIN incident_types t ON i.incident_type = t.incident_type""",
    "conformance_report": _conformance(),
    "stream_window_metrics": _window_metrics("hour"),
    "stream_decisions": _decisions(LATEST),
    "stream_latest_state": _with() + f"""
{SINGLE}
SELECT * EXCLUDE (arrived), {GREEN} AS green_duration_sec, CAST(90 - {GREEN} AS INTEGER) AS red_duration_sec,
       strftime(arrived, '%Y-%m-%dT%H:%M:%S.%g') AS received_at
FROM single
QUALIFY row_number() OVER (PARTITION BY intersection_id ORDER BY arrived DESC, window_start DESC) = 1""",
    "stream_latency_summary": _with() + f"""
, arrived AS (
  SELECT intersection_id, event_time, event_time + to_seconds(event_id * 7919 % 7200) AS arrived,
         CAST(1000 * (event_id * 7919 % 7200 - 1) AS DOUBLE) AS v,
         {BORN} AS born
  FROM vehicle_events JOIN (SELECT event_id, ts FROM events) USING (event_id)),
scoped AS (SELECT *, unnest(['ALL', intersection_id]) AS scope FROM arrived WHERE v >= 0),
upto AS (SELECT slice, scoped.* FROM scoped JOIN (SELECT unnest([0, 1, 2, 3]) AS slice) ON born <= slice),
recent AS (
  SELECT slice, scope, v, max(born) OVER (PARTITION BY slice, scope) AS newest FROM upto
  QUALIFY row_number() OVER (PARTITION BY slice, scope
                             ORDER BY arrived DESC, intersection_id DESC, event_time DESC) <= {HISTORY_SIZE}),
current AS (SELECT CAST(slice AS INTEGER) AS slice, scope, v FROM recent WHERE newest = slice),
{_statistics("current", "slice, scope")}""",
    # The watermark is an hour behind the newest reading of all slices so far. A reading counts unless the
    # watermark of the slices before has passed its window; a slice closes what its watermark passes.
    "stream_final_decisions": _with() + f"""
, arrivals AS (
  SELECT event_id, least(3, {BORN} + CASE WHEN event_id % 19 = 0 THEN 1 ELSE 0 END) AS born FROM events),
readings AS (
  SELECT *, date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end
  FROM vehicle_events JOIN arrivals USING (event_id)),
marks AS (
  SELECT k AS slice, max(event_time) - INTERVAL 1 HOUR AS mark
  FROM (SELECT unnest([0, 1, 2, 3]) AS k) JOIN readings ON born <= k GROUP BY k),
metrics AS (
  SELECT intersection_id, window_end, CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles,
         CAST(sum(speed_centi) AS BIGINT) AS centi, count(*) AS n
  FROM readings LEFT JOIN marks ON marks.slice = born - 1
  WHERE mark IS NULL OR window_end > mark GROUP BY ALL),
closed AS (
  SELECT m.*, CAST(min(slice) AS INTEGER) AS slice FROM metrics m JOIN marks ON mark >= window_end GROUP BY ALL),
told AS (SELECT * FROM incident_life JOIN arrivals USING (event_id)),
newest AS (
  SELECT c.*, arg_max(i.expires_at, (i.event_time, CAST(i.event_id AS VARCHAR))) AS until,
         arg_max(i.severity, (i.event_time, CAST(i.event_id AS VARCHAR))) AS last_severity
  FROM closed c LEFT JOIN told i
    ON i.intersection_id = c.intersection_id AND i.event_time <= c.window_end AND i.born <= c.slice
  GROUP BY ALL),
rated AS (SELECT *, CASE WHEN until >= window_end THEN last_severity ELSE 'NONE' END AS sev FROM newest),
moded AS (SELECT *, {_mode('total_vehicles', SPEED, 'sev')} AS traffic_mode FROM rated)
SELECT slice, intersection_id, {_iso('window_end - INTERVAL 1 HOUR')} AS window_start, {_iso('window_end')} AS window_end,
       total_vehicles, {SPEED} / 100.0::DOUBLE AS avg_speed_kmh, sev AS worst_severity, traffic_mode,
       {GREEN} AS green_duration_sec, CAST(90 - {GREEN} AS INTEGER) AS red_duration_sec FROM moded""",
    "stream_batch_counts": _with() + f"""
, born AS (SELECT event_id, event_type, {BORN} AS slice FROM events),
incidents AS (
  SELECT 'incidents' AS stream, slice, count(*) AS input_rows, count(*) FILTER (event_type = 'error') AS output_rows
  FROM born GROUP BY slice),
windows AS (
  SELECT slice, count(DISTINCT (intersection_id, date_trunc('hour', event_time))) AS output_rows
  FROM vehicle_events JOIN born USING (event_id) GROUP BY slice)
SELECT * FROM incidents
UNION ALL SELECT 'metrics', slice, input_rows, windows.output_rows FROM incidents JOIN windows USING (slice)""",
    "stream_live_state": _with() + f"""
{SINGLE},
upto AS (
  SELECT CAST(k AS INTEGER) AS slice, single.*
  FROM (SELECT *, {BORN} AS born FROM (SELECT *, CAST(window_start AS TIMESTAMP) AS ts FROM single)) single
  JOIN (SELECT unnest([0, 1, 2, 3]) AS k) ON born <= k)
SELECT * EXCLUDE (arrived, born, ts), {GREEN} AS green_duration_sec, CAST(90 - {GREEN} AS INTEGER) AS red_duration_sec,
       strftime(arrived, '%Y-%m-%dT%H:%M:%S.%g') AS received_at
FROM upto
QUALIFY row_number() OVER (PARTITION BY slice, intersection_id ORDER BY arrived DESC, window_start DESC) = 1""",
    "topic_decisions": _with(*SECOND_RECORDS) + f"""
, sent AS (
  SELECT *, first_event_id % 100 = 4 AS bad, CASE WHEN day(CAST(window_start AS TIMESTAMP)) < 17 THEN 0 ELSE 1 END AS slice
  FROM records)
SELECT CAST(slice AS INTEGER) AS slice, {_iso('decided')} AS received_at,
       CASE WHEN bad THEN 'UNKNOWN' ELSE intersection_id END AS intersection_id,
       {", ".join(f"CASE WHEN NOT bad THEN {c} END AS {c}" for c in RECORD_REST)},
       CASE WHEN bad THEN -1.0::DOUBLE ELSE e2e_latency_ms END AS e2e_latency_ms,
       CASE WHEN bad THEN 'malformed_json' END AS reason
FROM sent""",
    "stream_incident_feed": _with() + f"""
SELECT incident_events.* REPLACE ({_iso('event_time')} AS event_time), born AS slice
FROM incident_events JOIN (
  SELECT event_id, CAST(least(3, {BORN} + CASE WHEN event_id % 19 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS born FROM events)
USING (event_id)""",
}
