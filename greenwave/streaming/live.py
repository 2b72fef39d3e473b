"""Lookup in the checkpointed state of a running or stopped query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def live_state(
    spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0
) -> DataFrame:
    """The latest-state table as it lies in the state store of a ``latest_state`` query.

    One row per intersection with the columns of the decisions, after the last completed
    micro-batch or after ``batch_id``, without running the query and without its output. Intersections are the
    key of the state, the decision its value.
    """
    reader = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load().select("key.*", "value.*")
    value = state.columns[-1]
    return state.selectExpr(f"coalesce({state.columns[0]}, 'UNKNOWN') AS intersection_id", f"`{value}`.*")
