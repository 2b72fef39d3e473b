"""Rows per micro-batch as a table, from the progress of running queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_COUNTS = (
    "query string, name string, run string, batch_id long, input_rows long, output_rows long, "
    "late_rows long, watermark string"
)


def counts_of(progress) -> tuple:
    """One row of counts; output rows are known of streams that ``jobs.counted`` observes.

    Late rows are those that stateful operators dropped, as combined before they reached them.
    """
    observed = [dict(r.asDict()).get("rows") for r in progress.observedMetrics.values()]
    known = [n for n in observed if n is not None]
    return (
        str(progress.id),
        progress.name,
        str(progress.runId),
        progress.batchId,
        progress.numInputRows,
        sum(known) if known else None,
        sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
        progress.eventTime.get("watermark"),
    )


def counts_frame(spark: SparkSession, progress: Iterable) -> DataFrame:
    return spark.createDataFrame([counts_of(p) for p in progress], _COUNTS)


class CountsListener(StreamingQueryListener):
    """Appends the counts of every micro-batch of all queries of the session to a table.

    Register with ``spark.streams.addListener``. The table outlives the session: a restarted
    query goes on under its id. ``batch_counts_table`` reads it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        rows = counts_frame(self.spark, [event.progress])
        rows.coalesce(1).write.mode("append").json(self.path)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def batch_counts_table(spark: SparkSession, path: str) -> DataFrame:
    """Counts per query and micro-batch; a batch that was run again counts as it went last."""
    rows = spark.read.schema(_COUNTS).json(path)
    keys = ("query", "batch_id")
    rest = [c for c in rows.columns if c not in keys]
    # The attempt that got further is the one that was not cut short.
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct("input_rows", "output_rows", "run")).alias("_last"))
        .select(*keys, "_last.*")
    )
