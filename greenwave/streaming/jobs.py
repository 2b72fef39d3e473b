"""Running streams: to completion over what is there, or continuously."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from greenwave.functions import SignalRules
from greenwave.operators.decisions import decision_records
from greenwave.operators.decode import classify_records, decode_decisions
from greenwave.operators.latency import receive
from greenwave.operators.state import latest_state
from greenwave.schemas import DECISION, INCIDENT, VEHICLE
from greenwave.session import shared_folder
from greenwave.streaming.decisions import stream_decisions
from greenwave.streaming.latency import stream_latency_summary


def run_available(stream: DataFrame, output_mode: str, purpose: str) -> DataFrame:
    """Process everything the sources hold now and return the emitted rows.

    Rows carry the ``batch_id`` they were emitted in. Output and checkpoint go to
    the shared folder; nothing passes through the driver.
    """
    spark = stream.sparkSession
    folder = shared_folder(spark, purpose)

    def write(batch: DataFrame, batch_id: int) -> None:  # the folder is this run's own
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    write(spark.createDataFrame([], stream.schema), -1)  # so that there is a table without input
    query = (
        stream.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    schema = StructType([*stream.schema.fields, StructField("batch_id", IntegerType())])
    return spark.read.schema(schema).parquet(f"{folder}/rows")


def run_slices(
    slices: Sequence[DataFrame],
    make: Callable[[DataFrame], DataFrame],
    output_mode: str,
    purpose: str,
    after: Callable[[int, StreamingQuery, str], None] | None = None,
) -> DataFrame:
    """One query that meets ``slices`` one after the other; its rows with the ``slice`` they came from.

    Each slice is added to a folder in the shared storage, then the query built by ``make`` on the
    stream of that folder is started on the same checkpoint and stops when it has read what is
    new. So every slice is a micro-batch of its own, state and watermark go from one to the next,
    and every start recovers them.
    """
    spark = slices[0].sparkSession
    folder = shared_folder(spark, purpose)
    source = spark.readStream.schema(slices[0].schema)
    schema = None
    for number, rows in enumerate(slices):
        rows.write.parquet(f"{folder}/input/{number:05d}")
        stream = make(source.parquet(f"{folder}/input/*"))
        schema = schema or StructType([*stream.schema.fields, StructField("slice", IntegerType())])

        def write(batch: DataFrame, batch_id: int, number: int = number) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/rows/slice={number}/part={batch_id}")

        query = (
            stream.writeStream.outputMode(output_mode)
            .foreachBatch(write)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if after:
            after(number, query, f"{folder}/checkpoint")
    return spark.read.schema(schema).parquet(f"{folder}/rows").drop("part")


def counted(stream: DataFrame, name: str) -> DataFrame:
    """The stream with its rows per micro-batch observed.

    The count shows under ``name`` in the ``observedMetrics`` of the query's progress.
    """
    return stream.observe(name, F.count(F.lit(1)).alias("rows"))


def _start(name: str, stream: DataFrame, mode: str, write, checkpoints: str, trigger: str | None):
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return (
        counted(stream, name)
        .writeStream.queryName(name)
        .outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .trigger(**when)
        .start()
    )


def start_decision_job(
    vehicles: DataFrame,
    incidents: DataFrame,
    publish: Callable[[DataFrame, int], None],
    quarantine: Callable[[DataFrame, int], None],
    checkpoints: str,
    length: str = "1 second",
    delay: str = "1 second",
    trigger: str | None = "1 second",
    severity: str = "latest_severity",
    rules: SignalRules = SignalRules(),
) -> list[StreamingQuery]:
    """Start the whole job on two raw payload streams; returns its running queries.

    ``publish`` and ``quarantine`` are ``foreachBatch`` functions. Every query has
    its own checkpoint below ``checkpoints``, so offsets and state survive a
    restart. With ``trigger=None`` the queries stop once the sources are drained.
    Wait with ``spark.streams.awaitAnyTermination()``.
    """
    spark = vehicles.sparkSession
    sides = [classify_records(vehicles, VEHICLE), classify_records(incidents, INCIDENT)]
    good = [rows.filter("reason IS NULL").drop("reason", "payload") for rows in sides]
    bad = [
        rows.filter("reason IS NOT NULL").selectExpr(f"'{name}' AS stream", "payload", "reason")
        for name, rows in zip(("vehicles", "incidents"), sides)
    ]
    decisions = stream_decisions(*good, length, delay, "update", severity, rules)
    spark.streams.resetTerminated()
    return [
        _start("decisions", decision_records(decisions), "update", publish, checkpoints, trigger),
        _start("quarantine", bad[0].unionByName(bad[1]), "append", quarantine, checkpoints, trigger),
    ]


def start_monitor_job(
    decisions: DataFrame,
    history: Callable[[DataFrame, int], None],
    state: Callable[[DataFrame, int], None],
    checkpoints: str,
    trigger: str | None = "1 second",
    received_at: str = "current_timestamp()",
    statistics: Callable[[DataFrame, int], None] | None = None,
) -> list[StreamingQuery]:
    """Follow published decisions: every received one, the latest per intersection, latencies.

    ``decisions`` holds JSON payloads in ``value``; further columns, such as the
    broker's arrival time, may be named in the ``received_at`` expression. Unusable
    records are left out. ``state`` receives each intersection that changed, ``statistics``
    the latency statistics over the most recent decisions, of all and of each intersection.
    """
    usable = decode_decisions(decisions).filter("reason IS NULL").drop("reason")
    received = receive(usable, received_at)
    received = received.select(*DECISION.fieldNames(), "received_at", "latency_ms")
    queries = [
        _start("received", received, "append", history, checkpoints, trigger),
        _start("latest_state", latest_state(received), "update", state, checkpoints, trigger),
    ]
    if statistics:
        summary = stream_latency_summary(received, ("'ALL'", "intersection_id"))
        queries.append(_start("latency", summary, "update", statistics, checkpoints, trigger))
    return queries
