"""Event-stream readers with one shape: a ``value`` payload column, batch or streaming."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from greenwave.operators.decode import decode_decisions

VEHICLES_TOPIC = "vehicles"
INCIDENTS_TOPIC = "incidents"
DECISIONS_TOPIC = "traffic_decisions"


def kafka_options(
    topic: str,
    servers: str,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic(
    spark: SparkSession,
    topic: str,
    servers: str,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Subscribe to one topic. Needs the spark-sql-kafka connector on the class path.

    A trigger takes all there is unless ``max_offsets_per_trigger`` says otherwise.
    Offsets live in the query's checkpoint rather than in a consumer group.
    """
    options = kafka_options(topic, servers, starting, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_batch(
    spark: SparkSession, topic: str, servers: str, starting: str = "earliest"
) -> DataFrame:
    """The retained content of a topic as a batch."""
    options = kafka_options(topic, servers, starting, None)
    return spark.read.format("kafka").options(**options).load()


def received_decisions(messages: DataFrame) -> DataFrame:
    """Decision messages of a topic with decoded columns and ``reason`` for unusable records.

    A message's ``timestamp`` is its arrival time.
    """
    return decode_decisions(messages.select("value", F.col("timestamp").alias("received_at")))


def read_decision_topic(spark: SparkSession, servers: str, **options) -> DataFrame:
    """The decision topic of a broker as a stream, decoded by ``received_decisions``."""
    return received_decisions(read_topic(spark, DECISIONS_TOPIC, servers, **options))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """A folder of files with one payload per line, as a batch."""
    return spark.read.text(path)


def stream_json_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of files with one payload per line, as a stream."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A Parquet table as a stream, be it a folder of files or one file.

    New files of a folder are found as they come. A file source watches folders only, so
    a single file is read as its folder, filtered to its name. A path without files raises.
    """
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if not files:
        raise ValueError(f"no file to stream in {path}")
    plain = urlparse(path).path.rstrip("/")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if len(files) == 1 and unquote(urlparse(files[0]).path) == plain:
        folder, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
