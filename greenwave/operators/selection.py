"""Exact order statistics of any number of rows, without sorting them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from greenwave.session import stored

#: Buckets into which a range of values is divided at a time.
BINS = 4096


def _equal(names: Sequence[str]) -> Column:
    """Equality, nulls included, of columns with those of the other side, which begin with ``_``."""
    return reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names], F.lit(True))


def select_ranks(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], small: int = 100_000) -> DataFrame:
    """The values at given ranks: ``keys``, ``name``, ``v``.

    ``rows`` holds ``keys`` and a bigint ``v``, stored or cheap to read; ``wanted`` holds ``keys``,
    ``name``, the 0-based ``rank`` among a key's sorted values, and their least and greatest, ``lo``
    and ``hi``. Values are counted by bucket of the open range, the bucket that holds the rank
    becomes the range, and so on until it holds one value: a pass over the rows for every 12 bits
    of range, each with a map-side part, so that a key with most rows leaves each input partition
    as one row per bucket. The open ranges are broadcast up to ``small`` of them; beyond that they
    are joined by key.
    """
    keys = list(keys)
    state = stored(wanted.select(*keys, "name", "rank", "lo", "hi"), "ranks")
    done = None
    while True:
        closed = state.where("lo = hi").selectExpr(*keys, "name", "lo AS v")
        done = closed if done is None else done.unionByName(closed)
        state = state.where("lo < hi")
        ranges = state.select(*keys, "lo", "hi").distinct()
        many = ranges.count()
        if not many:
            return done
        ranges = ranges.select(*[F.col(k).alias(f"_{k}") for k in keys], "lo", "hi")
        ranges = F.broadcast(ranges) if many <= small else ranges
        width = f"((hi - lo) div {BINS} + 1)"
        counts = (
            rows.join(ranges, _equal(keys))
            .where("v BETWEEN lo AND hi")
            .groupBy(*keys, "lo", "hi", F.expr(f"(v - lo) div {width}").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        order = Window.partitionBy(*keys, "lo", "hi").orderBy("bucket")  # at most BINS rows each
        counts = counts.withColumn("upto", F.sum("n").over(order))
        found = state.join(
            counts.select(*[F.col(c).alias(f"_{c}") for c in counts.columns]),
            _equal([*keys, "lo", "hi"]) & F.expr("rank >= _upto - _n AND rank < _upto"),
        )
        state = stored(
            found.selectExpr(
                *keys,
                "name",
                "rank - (_upto - _n) AS rank",
                f"lo + _bucket * {width} AS lo",
                f"least(hi, lo + _bucket * {width} + {width} - 1) AS hi",
            ),
            "ranks",
        )
