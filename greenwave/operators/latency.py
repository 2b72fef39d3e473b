"""Received decisions, their latency history and its summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.functions import (
    HISTORY_SIZE,
    SLA_MS,
    elapsed_ms,
    hundredths,
    parse_logged_time,
    ratio_half_up,
)
from greenwave.operators.selection import select_ranks
from greenwave.session import stored


def receive(decisions: DataFrame, received_at: str = "current_timestamp()") -> DataFrame:
    """Add ``received_at`` and the consumer-hop latency ``latency_ms``.

    A missing or unreadable decision time gives -1. ``received_at`` is an
    expression; by default the time the query (or the micro-batch) runs.
    """
    hop = elapsed_ms("received_at", parse_logged_time("decision_timestamp"))
    kept = [c for c in decisions.columns if c != "received_at"]
    return decisions.selectExpr(*kept, f"{received_at} AS received_at").selectExpr(
        "*", f"{hop} AS latency_ms"
    )


def latency_history(
    received: DataFrame,
    size: int = HISTORY_SIZE,
    value: str = "e2e_latency_ms",
    arrival: tuple[str, ...] = ("received_at", "intersection_id", "window_start"),
) -> DataFrame:
    """The ``size`` most recently arrived known latencies; negative values are unknown.

    A top-k plan: each task keeps ``size`` rows, so nothing is sorted globally.
    """
    return (
        received.filter(f"{value} >= 0").orderBy(*[F.desc(c) for c in arrival]).limit(size)
    )


def latency_summary(history: DataFrame, value: str = "e2e_latency_ms") -> DataFrame:
    """One row of statistics at two decimals over a bounded history; none if it is empty.

    Percentiles are nearest-rank on the 0-based index ``int(n * p)``. The values
    are gathered into one array, so the input must be bounded (``latency_history``).
    """
    gathered = history.agg(
        F.expr(f"sort_array(collect_list(CAST(round({value} * 100) AS BIGINT))) AS v")
    ).selectExpr("v", "CAST(size(v) AS BIGINT) AS n")

    def at(p: float) -> str:
        return hundredths(f"get(v, CAST(least(floor(n * {p}D), n - 1) AS INT))")

    total = "aggregate(v, 0L, (a, x) -> a + x)"
    within = f"10000L * size(filter(v, x -> x < {SLA_MS * 100}))"
    return gathered.filter("n > 0").selectExpr(
        "n AS sample_count",
        f"{hundredths(ratio_half_up(total, 'n'))} AS avg_latency_ms",
        f"{hundredths('array_min(v)')} AS min_latency_ms",
        f"{hundredths('array_max(v)')} AS max_latency_ms",
        f"{at(0.95)} AS p95_latency_ms",
        f"{at(0.99)} AS p99_latency_ms",
        f"{hundredths(ratio_half_up(within, 'n'))} AS sla_3sec_compliance_pct",
    )


#: Statistics with the share of values below them, by name.
PERCENTILES = {"p95": 0.95, "p99": 0.99}


def latency_summary_of(values: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """The statistics of ``latency_summary`` over any number of rows, one row per ``keys``.

    Negative and null values are unknown and do not count; a key without known values gives no
    row. Values count with two decimals. Percentiles are exact and nothing is sorted or gathered:
    see ``select_ranks``. Null keys are a group of their own.
    """
    keys = list(keys)
    known = stored(
        values.where(f"{value} >= 0").selectExpr(*keys, f"CAST(round({value} * 100) AS BIGINT) AS v"), "latencies"
    )
    sums = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("v").cast("decimal(38,0)")).alias("total"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
        F.count_if(F.col("v") < SLA_MS * 100).alias("within"),
    )
    sums = stored(sums.where("n > 0"), "sums")
    ranks = ", ".join(
        f"struct('{name}' AS name, CAST(least(floor(n * {p}D), n - 1) AS BIGINT) AS rank)" for name, p in PERCENTILES.items()
    )
    wanted = sums.selectExpr(*keys, "lo", "hi", f"inline(array({ranks}))")
    found = select_ranks(known, wanted, keys).groupBy(*keys)
    found = found.agg(*[F.max(F.when(F.col("name") == p, F.col("v"))).alias(p) for p in PERCENTILES])
    found = found.select(*[F.col(k).alias(f"_{k}") for k in keys], *PERCENTILES)
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return sums.join(found, on).selectExpr(
        *keys,
        "n AS sample_count",
        f"{hundredths('(2 * total + n) div (2 * n)')} AS avg_latency_ms",
        f"{hundredths('lo')} AS min_latency_ms",
        f"{hundredths('hi')} AS max_latency_ms",
        *[f"{hundredths(p)} AS {p}_latency_ms" for p in PERCENTILES],
        f"{hundredths('(20000 * within + n) div (2 * n)')} AS sla_3sec_compliance_pct",
    )
