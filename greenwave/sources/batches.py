"""Tables of micro-batches with a commit log.

Every attempt to write a micro-batch has a data folder of its own, and a batch counts once its
entry is in the log. An entry is one file, written whole and then renamed, so it is there or not:
half-written batches never show. A retried batch has two entries, of which readers take one.
Compaction rewrites folders into one and swaps them by a single entry that names those it covers.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOG = (
    "query string, run int, batch_id long, folder string, rows long, committed long, covers array<string>"
)


class Entry(NamedTuple):
    """A committed micro-batch; with ``covers``, a compacted folder in place of these."""

    query: str | None
    run: int | None
    batch_id: int | None
    folder: str
    rows: int
    committed: int
    covers: list[str] | None


def _log(spark: SparkSession, path: str) -> list[Entry]:
    """All entries in order of commit: one short row per micro-batch."""
    try:
        rows = spark.read.schema(_LOG).json(f"{path}/log").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((Entry(*r) for r in rows), key=lambda e: (e.committed, e.folder))


def _commit(spark: SparkSession, path: str, entry: Entry) -> None:
    spark.createDataFrame([entry], _LOG).coalesce(1).write.mode("append").json(f"{path}/log")


def live_entries(entries: list[Entry]) -> list[Entry]:
    """What readers see: each micro-batch once, and compacted folders in place of what they cover.

    Of overlapping compactions the first counts. A batch that is retried after its first copy was
    compacted stays covered.
    """
    covered: set[str] = set()
    whole = []
    for entry in entries:
        if entry.covers is not None and not covered & set(entry.covers):
            covered |= set(entry.covers)
            whole.append(entry)
    done = {(e.query, e.batch_id) for e in entries if e.covers is None and e.folder in covered}
    last = {(e.query, e.batch_id): e for e in entries if e.covers is None}
    batches = [e for key, e in last.items() if key not in done]
    return [e for e in whole if e.folder not in covered] + batches


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends micro-batches to the table at ``path``.

    Rows get the columns ``run`` and ``batch_id``. Runs are numbered in the order in which queries
    first wrote here; a query that restarts from its checkpoint goes on with its number.
    """
    runs: dict[str, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        if query not in runs:
            known = _log(spark, path)
            mine = [e.run for e in known if e.query == query]
            runs[query] = mine[0] if mine else 1 + max([e.run for e in known if e.run is not None], default=-1)
        folder, counted = uuid.uuid4().hex, Observation()
        rows = batch.observe(counted, F.count(F.lit(1)).alias("rows"))
        rows = rows.withColumns({"run": F.lit(runs[query]), "batch_id": F.lit(batch_id).cast("long")})
        rows.write.parquet(f"{path}/data/{folder}")
        _commit(
            spark, path, Entry(query, runs[query], batch_id, folder, counted.get["rows"], time.time_ns(), None)
        )

    return write


def read_batches(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The committed rows of a table of ``append_batches``, with ``run`` and ``batch_id``.

    A table without any batch needs ``schema``, that of the rows with these two columns.
    """
    folders = [f"{path}/data/{e.folder}" for e in live_entries(_log(spark, path))]
    if folders:
        return spark.read.parquet(*folders)
    if schema is None:
        raise ValueError(f"nothing is committed in {path}")
    return spark.createDataFrame([], schema)


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    """``run``, ``batch_id``, ``rows`` of every committed micro-batch, compacted ones too."""
    last = {(e.query, e.batch_id): e for e in _log(spark, path) if e.covers is None}
    return spark.createDataFrame(
        [(e.run, e.batch_id, e.rows) for e in last.values()], "run int, batch_id long, rows long"
    )


def compact_batches(spark: SparkSession, path: str, files: int) -> None:
    """Rewrite what is committed now into ``files`` files; readers switch over at once.

    Queries may go on writing. The old folders stay for readers that have begun with them.
    """
    live = live_entries(_log(spark, path))
    if len(live) < 2:
        return
    folder, counted = uuid.uuid4().hex, Observation()
    rows = spark.read.parquet(*[f"{path}/data/{e.folder}" for e in live])
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows")).repartition(files)
    rows.write.parquet(f"{path}/data/{folder}")
    covers = [e.folder for e in live]
    _commit(spark, path, Entry(None, None, None, folder, counted.get["rows"], time.time_ns(), covers))


def last_emission(batches: DataFrame, *keys: str) -> DataFrame:
    """Final row per key of a table of micro-batches from update-mode queries: latest run, latest batch."""
    when = [c for c in ("run", "batch_id") if c in batches.columns]
    rest = [c for c in batches.columns if c not in keys and c not in when]
    return (
        batches.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*when)).alias("_last"))
        .select(*keys, "_last.*")
    )
