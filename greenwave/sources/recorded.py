"""Recorded topics: partitions, offsets and segments in the shared storage, streamed by offset.

A recorded topic is a folder of Parquet segments, ``partition=<n>/<segment>``, with the offset of
each message. It is written by Spark and read as a stream by a Python data source: the offsets
reached lie in the query's checkpoint, so a restarted query goes on where it ended. It stands where
a broker's connector would, with the same columns, and holds what a broker has retained.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

MESSAGE = "key string, value string, partition int, offset long, timestamp timestamp"
_ARROW = pa.schema([
    ("key", pa.string()),
    ("value", pa.string()),
    ("partition", pa.int32()),
    ("offset", pa.int64()),
    ("timestamp", pa.timestamp("us", "UTC")),
])


def record_topic(messages: DataFrame, path: str, partitions: int = 8) -> None:
    """Append ``messages`` (``key``, ``value``, ``timestamp``) to the topic at ``path``.

    Messages of one key go to one partition, as with a broker, in order of time (then text); their
    offsets go on from the last one there. One writer at a time.
    """
    try:
        last = messages.sparkSession.read.parquet(path).groupBy("partition").agg(F.max("offset").alias("last"))
        next_of = {r["partition"]: r["last"] + 1 for r in last.collect()}  # one row per partition
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        next_of = {}
    begin = "CASE partition " + " ".join(f"WHEN {p} THEN {n}L" for p, n in next_of.items()) + " ELSE 0L END"
    order = Window.partitionBy("partition").orderBy("timestamp", "value")
    placed = messages.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp",
        F.expr(f"CAST(pmod(xxhash64(key), {partitions}) AS INT)").alias("partition"),
    )
    placed = placed.withColumn("offset", F.row_number().over(order) - 1 + F.expr(begin if next_of else "0L"))
    placed.write.partitionBy("partition").mode("append").parquet(path)


class _Stretch(InputPartition):
    """Offsets ``low`` up to ``high`` of one segment."""

    def __init__(self, file: str, partition: int, low: int, high: int):
        super().__init__((file, partition, low, high))


class _Segments:
    """The segments of a topic with the offsets each holds; a segment's footer is read once."""

    def __init__(self, path: str):
        self.store, self.root = fs.FileSystem.from_uri(path)
        self.known: dict[str, tuple[int, int, int]] = {}

    def refresh(self) -> None:
        selector = fs.FileSelector(self.root, allow_not_found=True, recursive=True)
        for info in self.store.get_file_info(selector):
            name = info.path[len(self.root) :].strip("/")
            folder, _, file = name.rpartition("/")
            if file.startswith(("_", ".")) or not folder.startswith("partition=") or info.path in self.known:
                continue
            if info.type is not fs.FileType.File or not file.endswith(".parquet") or "/" in folder:
                continue
            footer = pq.read_metadata(info.path, filesystem=self.store)
            place = footer.schema.names.index("offset")
            bounds = [footer.row_group(k).column(place).statistics for k in range(footer.num_row_groups)]
            if bounds:
                low, high = min(b.min for b in bounds), max(b.max for b in bounds) + 1
                self.known[info.path] = (int(folder.removeprefix("partition=")), low, high)

    def ends(self) -> dict[str, int]:
        found: dict[str, int] = {}
        for partition, _, high in self.known.values():
            found[str(partition)] = max(high, found.get(str(partition), 0))
        return found

    def stretches(self, start: dict, end: dict) -> list[_Stretch]:
        out = []
        for file, (partition, low, high) in sorted(self.known.items()):
            low = max(low, start.get(str(partition), 0))
            high = min(high, end.get(str(partition), 0))
            if low < high:
                out.append(_Stretch(file, partition, low, high))
        return out


def _messages(path: str, stretch: _Stretch) -> Iterator[pa.RecordBatch]:
    file, partition, low, high = stretch.value
    store, _ = fs.FileSystem.from_uri(path)
    with store.open_input_file(file) as source:
        for batch in pq.ParquetFile(source).iter_batches(columns=["key", "value", "offset", "timestamp"]):
            offset = batch.column("offset")
            batch = batch.filter(pc.and_(pc.greater_equal(offset, low), pc.less(offset, high)))
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["partition"] = pa.array([partition] * batch.num_rows, pa.int32())
            times = columns["timestamp"]
            if times.type.tz is None:
                times = times.cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
            columns["timestamp"] = times
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in _ARROW], schema=_ARROW)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.earliest = options.get("startingoffsets", "latest") == "earliest"
        self.limit = int(options.get("maxoffsetspertrigger", 0))
        self.segments = _Segments(self.path)
        self.reached: dict[str, int] | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        self.segments.refresh()
        ends = self.segments.ends()
        self.reached = {p: 0 for p in ends} if self.earliest else ends
        return self.reached

    def latestOffset(self) -> dict:  # noqa: N802
        self.segments.refresh()
        ends = self.segments.ends()
        # What a restarted query has reached is known from its first micro-batch on.
        if not self.limit or self.reached is None:
            return ends
        behind = [p for p, end in ends.items() if end > self.reached.get(p, 0)]
        share = -(-self.limit // max(1, len(behind)))
        return {p: min(end, self.reached.get(p, 0) + share) for p, end in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[_Stretch]:
        self.segments.refresh()
        self.reached = end
        return self.segments.stretches(start, end)

    def read(self, partition: _Stretch) -> Iterator[pa.RecordBatch]:
        return _messages(self.path, partition)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]

    def partitions(self) -> list[_Stretch]:
        segments = _Segments(self.path)
        segments.refresh()
        return segments.stretches({}, segments.ends())

    def read(self, partition: _Stretch) -> Iterator[pa.RecordBatch]:
        return _messages(self.path, partition) if partition is not None else iter(())


class RecordedTopic(DataSource):
    """Format ``recorded_topic``: ``path``, ``startingOffsets`` (latest or earliest), ``maxOffsetsPerTrigger``."""

    @classmethod
    def name(cls) -> str:
        return "recorded_topic"

    def schema(self) -> str:
        return MESSAGE

    def _options(self) -> dict:
        return {name.lower(): value for name, value in self.options.items()}

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(self._options())


def stream_recorded(
    spark: SparkSession, path: str, starting: str = "latest", max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """A recorded topic as a stream of messages, from its ends or from its beginning.

    A trigger takes all there is or about ``max_offsets_per_trigger`` messages, shared evenly
    among the partitions that lie behind; the first one after a restart takes all there is.
    """
    spark.dataSource.register(RecordedTopic)
    reader = spark.readStream.format("recorded_topic").option("startingOffsets", starting)
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load(path)


def read_recorded(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a recorded topic, as a batch."""
    spark.dataSource.register(RecordedTopic)
    return spark.read.format("recorded_topic").load(path)
