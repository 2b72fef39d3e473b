"""Every registered query, each over the whole ``events`` table of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from greenwave.functions import INTERSECTIONS, iso_seconds, lookup, parse_logged_time
from greenwave.operators import decode, fold, latency, quality, state
from greenwave.operators.decisions import decide, keyed_json, receipt_line, status_line
from greenwave.operators.incidents import incident_lifetimes, interval_join, severity_at
from greenwave.operators.metrics import window_metrics
from greenwave.plans import fixtures
from greenwave.schemas import DECISION, INCIDENT, VEHICLE
from greenwave.session import shared_folder
from greenwave.sources.batches import append_batches, last_emission, read_batches
from greenwave.sources.recorded import record_topic, stream_recorded
from greenwave.sources.topics import received_decisions, stream_parquet
from greenwave.streaming.decisions import stream_decisions
from greenwave.streaming.incidents import stream_incidents
from greenwave.streaming.jobs import counted, run_available, run_slices
from greenwave.streaming.latency import stream_latency_summary as stream_latency
from greenwave.streaming.live import live_state
from greenwave.streaming.metrics import stream_metrics
from greenwave.streaming.progress import counts_frame

Query = Callable[[SparkSession, str], DataFrame]


def _iso(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as ISO text, so that results compare across engines."""
    return df.selectExpr(
        *[f"{iso_seconds(c)} AS {c}" if c in names else c for c in df.columns]
    )


def decode_vehicle_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(decode.decode_vehicles(fixtures.vehicle_payloads(spark, sf_dir)), "event_time")


def decode_incident_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(decode.decode_incidents(fixtures.incident_payloads(spark, sf_dir)), "event_time")


def bad_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per stream and verdict."""
    streams = [
        ("vehicles", fixtures.vehicle_payloads(spark, sf_dir), VEHICLE),
        ("incidents", fixtures.incident_payloads(spark, sf_dir), INCIDENT),
    ]
    verdicts = [
        decode.classify_records(raw, schema).select(
            F.lit(name).alias("stream"), F.coalesce("reason", F.lit("ok")).alias("reason")
        )
        for name, raw, schema in streams
    ]
    return (
        verdicts[0]
        .unionByName(verdicts[1])
        .groupBy("stream", "reason")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def _metrics(length: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = window_metrics(fixtures.vehicles(spark, sf_dir), length)
        return _iso(metrics, "window_start", "window_end", "min_produced_at").drop(
            "speed_sum", "speed_readings", "speed_rest"
        )

    return query


def incident_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = fixtures.incidents(spark, sf_dir).selectExpr(
        "event_id",
        "intersection_id",
        "event_time",
        "CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 13 > 1 THEN severity END AS severity",
        "CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 11 > 1 THEN estimated_duration_min END"
        " AS estimated_duration_min",
    )
    return _iso(incident_lifetimes(gaps), "event_time", "expires_at").select(
        "event_id",
        "intersection_id",
        "event_time",
        "severity",
        "severity_rank",
        "estimated_duration_min",
        "expires_at",
    )


def _severity(length: str, column: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = window_metrics(fixtures.vehicles(spark, sf_dir), length)
        found = severity_at(
            metrics.select("intersection_id", "window_end"),
            fixtures.incidents(spark, sf_dir),
            grid=length,
            want=(column,),
        )
        return _iso(found, "window_end").select("intersection_id", "window_end", column)

    return query


def incident_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour windows with the incidents active at their end: at most one match per hour of life."""
    points = window_metrics(fixtures.vehicles(spark, sf_dir), "1 hour").select(
        "intersection_id", "window_end", "total_vehicles"
    )
    joined = interval_join(points, fixtures.incidents(spark, sf_dir), grid="1 hour")
    return _iso(joined, "window_end", "incident_time", "expires_at")


def incident_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored incident after all arrivals, which come up to two hours late and out of order."""
    arriving = fixtures.incidents(spark, sf_dir).selectExpr(
        "lpad(CAST(event_id AS STRING), 20, '0') AS event_id",
        "intersection_id",
        "event_time",
        "severity",
        "estimated_duration_min",
        "timestamp_seconds(unix_seconds(event_time) + event_id * 7919 % 7200) AS arrival_ts",
    )
    return _iso(fold.fold_incidents(arriving), "event_time", "expires_at")


def _decisions(length: str, column: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = window_metrics(fixtures.vehicles(spark, sf_dir), length)
        incidents = fixtures.incidents(spark, sf_dir)
        found = severity_at(metrics, incidents, grid=length, want=(column,))
        plans = decide(found, column)
        return _iso(plans, "window_start", "window_end").select(
            "intersection_id",
            "window_start",
            "window_end",
            "total_vehicles",
            "avg_speed_kmh",
            "worst_severity",
            "traffic_mode",
            "green_duration_sec",
            "red_duration_sec",
        )

    return query


def decision_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision rule on a total, speed and severity drawn from every event."""
    severities = dict(enumerate(["NONE", "LOW", "MEDIUM", "HIGH", "CRITICAL", "UNKNOWN_X"]))
    cases = fixtures.read_events(spark, sf_dir).selectExpr(
        "event_id",
        "CASE WHEN event_id % 41 > 0 THEN event_id * 7 % 45 END AS total_vehicles",
        "CASE WHEN event_id % 43 > 0 THEN (14000 + event_id * 137 % 2000) / 1000D END AS avg_speed_kmh",
        f"{lookup('event_id % 7', severities, None)} AS worst_severity",
    )
    return decide(cases)


def decision_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published records read back field by field from their JSON."""
    published = keyed_json(fixtures.decided(spark, sf_dir))
    return published.select("key", F.from_json("value", DECISION).alias("d")).select("key", "d.*")


def status_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fixtures.decided(spark, sf_dir)
    return records.selectExpr("intersection_id", "window_start", f"{status_line()} AS line")


def receipt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = fixtures.received(spark, sf_dir)
    return received.selectExpr("intersection_id", "window_start", f"{receipt_line()} AS line")


def logged_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time written in one of eight ways and read back, invalid ones as NULL."""
    micro = """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""
    second = iso_seconds("ts")
    written = f"""CASE event_id % 8
      WHEN 0 THEN {second}
      WHEN 1 THEN {micro}
      WHEN 2 THEN translate({second}, 'T', ' ')
      WHEN 3 THEN translate({micro}, 'T', ' ')
      WHEN 4 THEN '  ' || translate({second}, 'T', ' ') || ' '
      WHEN 5 THEN left({second}, 10)
      WHEN 6 THEN {second} || 'Z'
      ELSE '' END"""
    return (
        fixtures.read_events(spark, sf_dir)
        .selectExpr("event_id", f"{written} AS logged")
        .selectExpr("event_id", "logged", f"{parse_logged_time('logged')} AS ts")
        .selectExpr("event_id", "logged", f"{micro} AS parsed")
    )


def _latency_of(column: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fixtures.received(spark, sf_dir).select("intersection_id", "window_start", column)

    return query


def latency_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = latency.latency_history(fixtures.received(spark, sf_dir))
    return history.select("intersection_id", "window_start", "e2e_latency_ms")


def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.latency_summary(latency.latency_history(fixtures.received(spark, sf_dir)))


def latency_summary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of both latencies over every decision, overall and by intersection."""
    both = "array(struct('e2e' AS measure, e2e_latency_ms AS ms), struct('hop' AS measure, latency_ms AS ms))"
    scoped = fixtures.received(spark, sf_dir).selectExpr(
        "explode(array('ALL', intersection_id)) AS scope", f"{both} AS both"
    )
    measured = scoped.selectExpr("scope", "inline(both)")
    return latency.latency_summary_of(measured, "ms", ("scope", "measure"))


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.latest_state(fixtures.received(spark, sf_dir).drop("first_event_id"))


def _state_columns(df: DataFrame) -> DataFrame:
    return df.withColumn("received_at", F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSS"))


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_columns(_state(spark, sf_dir))


def state_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.state_report(_state(spark, sf_dir))


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state_columns(state.lookup_state(_state(spark, sf_dir), INTERSECTIONS[1]))


def state_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.state_counts(_state(spark, sf_dir))


def density_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_density_class(fixtures.vehicles(spark, sf_dir)).select(
        "event_id", "vehicle_count", "density_level", "density_class", "density_agrees"
    )


def hour_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(quality.with_hour_band(fixtures.vehicles(spark, sf_dir)), "event_time").select(
        "event_id", "event_time", "hour_band", "min_factor", "max_factor"
    )


def incident_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = quality.enrich_incidents(fixtures.incidents(spark, sf_dir))
    return _iso(enriched, "event_time")


def conformance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = quality.enrich_incidents(fixtures.incidents(spark, sf_dir))
    on_incidents = quality.conformance_report(enriched, quality.INCIDENT_RULES, "incidents")
    vehicles = fixtures.vehicles(spark, sf_dir)
    on_vehicles = quality.conformance_report(vehicles, quality.VEHICLE_RULES, "vehicles")
    return on_incidents.unionByName(on_vehicles)


def composed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.incidents(spark, sf_dir).selectExpr(
        "event_id",
        f"{quality.compose_event_id('INC', 'intersection_id', 'event_time')} AS incident_key",
        f"{quality.incident_description('incident_type', 'intersection_id')} AS description",
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = StructType.fromDDL(fixtures.EVENTS_SCHEMA)
    return stream_parquet(spark, f"{sf_dir}/events.parquet", schema)


def stream_window_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update-mode hour metrics over the events as a stream; last emission per window."""
    stream = stream_metrics(fixtures.vehicles_from(_event_stream(spark, sf_dir)), "1 hour")
    emitted = run_available(stream, "update", "stream_window_metrics")
    return _iso(
        last_emission(emitted, "intersection_id", "window_start"),
        "window_start",
        "window_end",
        "min_produced_at",
    ).drop("speed_sum", "speed_readings", "speed_rest")


def stream_decision_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of the stateful streaming operator at hour windows; last emission per window."""
    stream = stream_decisions(
        fixtures.vehicles_from(_event_stream(spark, sf_dir)),
        fixtures.incidents_from(_event_stream(spark, sf_dir)),
        "1 hour",
    )
    emitted = run_available(stream, "update", "stream_decisions")
    final = last_emission(emitted, "intersection_id", "window_start")
    return _iso(final, "window_start", "window_end").drop(
        "min_produced_at", "latest_severity", "speed_sum", "speed_readings", "speed_rest"
    )


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published records read back as a stream and reduced to the last arrival per intersection."""
    records = fixtures.reading_records(_event_stream(spark, sf_dir))
    raw = keyed_json(records, keep=("received_at",)).drop("key")
    usable = decode.decode_decisions(raw).filter("reason IS NULL").drop("reason")
    stream = state.latest_state(latency.receive(usable, "received_at"))
    emitted = run_available(stream, "update", "stream_latest_state")
    return _state_columns(last_emission(emitted, "intersection_id"))


#: Days of the month at which the events are cut into slices that a stream meets one by one.
SLICES = (9, 17, 25)


def _slices(spark: SparkSession, sf_dir: str, late: str = "false") -> list[DataFrame]:
    """Events by the slice they arrive in; those that are ``late`` arrive one slice later."""
    events = fixtures.read_events(spark, sf_dir)
    born = " + ".join(f"CAST(day(ts) >= {d} AS INT)" for d in SLICES)
    arrives = f"least({born} + CAST({late} AS INT), {len(SLICES)})"
    return [events.where(f"{arrives} = {k}") for k in range(len(SLICES) + 1)]


def stream_latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hop latency statistics after each of four micro-batches of single-reading records."""

    def statistics(events: DataFrame) -> DataFrame:
        records = latency.receive(fixtures.reading_records(events), "received_at")
        return stream_latency(records, ("'ALL'", "intersection_id"), value="latency_ms")

    return run_slices(_slices(spark, sf_dir), statistics, "update", "stream_latency_summary")


def stream_final_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on the hour windows that each of four micro-batches closes.

    Every nineteenth event arrives a slice late: readings too late for their window are dropped,
    incidents count for the windows that close after them.
    """

    def decisions(events: DataFrame) -> DataFrame:
        return stream_decisions(
            fixtures.vehicles_from(events), fixtures.incidents_from(events), "1 hour", "1 hour", "final"
        )

    emitted = run_slices(_slices(spark, sf_dir, "event_id % 19 = 0"), decisions, "append", "stream_final")
    return _iso(emitted, "window_start", "window_end").drop(
        "min_produced_at", "latest_severity", "speed_sum", "speed_readings", "speed_rest"
    )


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in and out of each micro-batch of the incident feed and of the hour metrics."""
    streams = {
        "incidents": (lambda events: stream_incidents(fixtures.incidents_from(events)), "append"),
        "metrics": (lambda events: stream_metrics(fixtures.vehicles_from(events), "1 hour"), "update"),
    }
    tables = []
    for name, (make, mode) in streams.items():
        seen: list[tuple[int, list]] = []
        run_slices(
            _slices(spark, sf_dir),
            lambda events: counted(make(events), name),
            mode,
            f"counts-{name}",
            lambda number, query, _: seen.append((number, query.recentProgress)),
        )
        for number, progress in seen:
            rows = counts_frame(spark, [p for p in progress if p.numInputRows])
            tables.append(rows.selectExpr(f"'{name}' AS stream", f"{number} AS slice", "input_rows", "output_rows"))
    return reduce(DataFrame.unionByName, tables)


def stream_live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each intersection after each of four micro-batches, read from the state store."""
    snapshots = []

    def read(number: int, query, checkpoint: str) -> None:
        batch = max(p.batchId for p in query.recentProgress if p.numInputRows)
        snapshots.append(live_state(spark, checkpoint, batch).withColumn("slice", F.lit(number)))

    def latest(events: DataFrame) -> DataFrame:
        return state.latest_state(latency.receive(fixtures.reading_records(events), "received_at"))

    run_slices(_slices(spark, sf_dir), latest, "update", "live_state", read)
    return _state_columns(reduce(DataFrame.unionByName, snapshots))


def stream_incident_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents as the append-mode feed hands them on, late ones too, by the micro-batch they came in."""
    feed = run_slices(
        _slices(spark, sf_dir, "event_id % 19 = 0"),
        lambda events: stream_incidents(fixtures.incidents_from(events)),
        "append",
        "incident_feed",
    )
    return _iso(feed, "event_time")


def topic_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published decisions recorded in a topic and followed by offset, over two micro-batches.

    Every hundredth payload is damaged.
    """
    sent = keyed_json(fixtures.decided(spark, sf_dir), keep=("first_event_id", "decision_timestamp", "window_start"))
    sent = sent.selectExpr(
        "key",
        "IF(first_event_id % 100 = 4, left(value, 20), value) AS value",
        "CAST(decision_timestamp AS TIMESTAMP) AS timestamp",
        "window_start",
    )
    folder = shared_folder(spark, "topic_decisions")
    for early in (True, False):
        part = sent.where(f"(day(window_start) < {SLICES[1]}) = {early}").drop("window_start")
        record_topic(part, f"{folder}/topic")
        messages = stream_recorded(spark, f"{folder}/topic", "earliest")
        query = (
            received_decisions(messages)
            .writeStream.foreachBatch(append_batches(f"{folder}/received"))
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    received = _iso(read_batches(spark, f"{folder}/received"), "received_at")
    return received.selectExpr("CAST(batch_id AS INT) AS slice", "received_at", *DECISION.fieldNames(), "reason")


QUERIES: dict[str, Query] = {
    "decode_vehicle_json": decode_vehicle_json,
    "decode_incident_json": decode_incident_json,
    "bad_record_split": bad_record_split,
    "composed_texts": composed_texts,
    "window_metrics_1s": _metrics("1 second"),
    "window_metrics_1h": _metrics("1 hour"),
    "incident_expiry": incident_expiry,
    "incident_asof": _severity("1 second", "latest_severity"),
    "worst_active_severity": _severity("1 second", "worst_severity"),
    "incident_interval_join": incident_interval_join,
    "incident_fold": incident_fold,
    "decisions_latest": _decisions("1 hour", "latest_severity"),
    "decisions_worst": _decisions("1 hour", "worst_severity"),
    "decision_grid": decision_grid,
    "decision_json": decision_json,
    "status_line": status_lines,
    "receipt_line": receipt_lines,
    "logged_time": logged_time,
    "e2e_latency": _latency_of("e2e_latency_ms"),
    "hop_latency": _latency_of("latency_ms"),
    "latency_history": latency_history,
    "latency_summary": latency_summary,
    "latency_summary_all": latency_summary_all,
    "latest_state": latest_state,
    "state_report": state_report,
    "state_lookup": state_lookup,
    "state_counts": state_counts,
    "density_class": density_class,
    "hour_band": hour_band,
    "incident_enriched": incident_enriched,
    "conformance_report": conformance_report,
    "stream_window_metrics": stream_window_metrics,
    "stream_decisions": stream_decision_rows,
    "stream_latest_state": stream_latest_state,
    "stream_latency_summary": stream_latency_summary,
    "stream_final_decisions": stream_final_decisions,
    "stream_batch_counts": stream_batch_counts,
    "stream_incident_feed": stream_incident_feed,
    "topic_decisions": topic_decisions,
    "stream_live_state": stream_live_state,
}
