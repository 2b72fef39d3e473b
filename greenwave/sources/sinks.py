"""Stream and batch outputs. Rows go from executors to the sink, never through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from greenwave.operators.decisions import keyed_json, status_line


def write_topic(
    records: DataFrame, topic: str, servers: str, checkpoint: str, trigger: str = "1 second"
) -> DataStreamWriter:
    """Decision records to a topic, keyed by intersection, as JSON.

    Delivery is at least once: a batch repeated after a failure is published again.
    """
    return (
        keyed_json(records)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(processingTime=trigger)
    )


def write_topic_batch(records: DataFrame, topic: str, servers: str) -> None:
    (
        keyed_json(records)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def status_lines(records: DataFrame, checkpoint: str, trigger: str = "1 second") -> DataStreamWriter:
    """One log line per decision on the console."""
    return (
        records.selectExpr(f"{status_line()} AS line")
        .writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(processingTime=trigger)
    )
