"""Mixing sources to target weights by nested hash thresholds, without sorting rows.

Every row has a fixed hash. A source takes the rows below a threshold, so that a larger
budget takes a superset. The threshold is found from histograms: sizes are summed by source
and hash bucket, the bucket in which the budget ends is refined into finer buckets, and so
on; only sums leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenwave.llm.common import WORD, broadcast_below, stored

#: Hash bits, and bits by which each refinement divides a bucket.
BITS, STEP = 60, 12


def source_targets(sizes: dict[str | None, int], weights=(3, 1, 2), share: float = 1.5, most: float = 2.0):
    """Target of each source: budget by weight, at most ``most`` times its size.

    Sources in code point order, null last, take ``weights`` in turn. What exceeds a
    source's limit is shared among the others by weight until none is above its limit.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    limit = {s: most * sizes[s] for s in names}
    left, open_ = share * sum(sizes.values()), list(names)
    targets: dict[str | None, float] = {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > limit[s]]
        if not over:
            return targets | {s: left * weight[s] / total for s in open_}
        for s in over:
            targets[s] = float(limit[s])
        left -= sum(limit[s] for s in over)
        open_ = [s for s in open_ if s not in targets]
    return targets


def _thresholds(rows: DataFrame, extra: dict[str | None, float]) -> DataFrame:
    """For each source: ``cut`` (hashes below are taken) and, at ``cut``, ``part`` of ``whole`` words."""
    spark = rows.sparkSession
    state = {s: (0, 0) for s in extra}  # where the open bucket begins, words below it
    done: dict[str | None, tuple[int, int, int]] = {}
    for level in range(BITS // STEP):
        shift = BITS - STEP * (level + 1)
        known = [(s, lo, below, float(extra[s])) for s, (lo, below) in state.items() if s not in done]
        if not known:
            break
        at = spark.createDataFrame(known, "at string, lo long, below long, extra double")
        buckets = (
            rows.join(broadcast_below(at, 1_000_000), F.col("source").eqNullSafe(F.col("at")))
            .where(f"mark >= lo AND mark - lo < {1 << (shift + STEP)}")
            .groupBy("at", "lo", "below", "extra", F.expr(f"shiftright(mark - lo, {shift})").alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("mark").alias("first"), F.max("mark").alias("last"))
        )
        order = Window.partitionBy("at").orderBy("bucket")  # at most 2**STEP rows each
        ends = buckets.withColumn("upto", F.sum("words").over(order)).where("below + upto > extra")
        ends = ends.withColumn("place", F.row_number().over(order)).where("place = 1").collect()
        crossed = {r["at"] for r in ends}
        for s, *_ in known:
            if s not in crossed:
                done[s] = (1 << BITS, 0, 0)  # the budget covers all rows
        for r in ends:
            below = r["below"] + r["upto"] - r["words"]
            if r["first"] == r["last"]:
                done[r["at"]] = (r["first"], int(extra[r["at"]] - below), r["words"])
            else:
                state[r["at"]] = (r["lo"] + (r["bucket"] << shift), below)
    found = [(s, *cut) for s, cut in done.items()]
    return spark.createDataFrame(found, "at string, cut long, part long, whole long")


def _planned(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """``mix`` with ``mark`` (hash of ``doc_id`` and text) and ``source``, by which rows are known.

    The driver holds one number per source.
    """
    rows = stored(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.expr(f"xxhash64(doc_id, text) & {(1 << BITS) - 1}").alias("mark"),
        ),
        "sizes",
    )
    totals = {r["source"]: r["total"] for r in rows.groupBy("source").agg(F.sum("size").alias("total")).collect()}
    targets = source_targets(totals, weights, share, most)
    repeats = {s: min(most, int(targets[s] // n)) if n else 0 for s, n in totals.items()}
    cuts = _thresholds(rows, {s: targets[s] - repeats[s] * n for s, n in totals.items()})
    plan = docs.sparkSession.createDataFrame(
        [(s, n, float(targets[s]), repeats[s]) for s, n in totals.items()],
        "name string, source_size long, target double, repeats int",
    )
    plan = plan.join(cuts, F.col("name").eqNullSafe(F.col("at"))).drop("at")
    taken = f"""least({most} * size, repeats * size + CASE
        WHEN mark < cut THEN size
        WHEN mark > cut OR whole = 0 THEN 0
        ELSE (size * part) div whole END)"""
    return rows.join(broadcast_below(plan, 1_000_000), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "source_size", "target", F.expr(taken).alias("taken"), "mark", "source"
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    ``size`` is the number of words (null text: 0). ``taken`` counts repeats: of a target
    of r times the source, every row is taken floor(r) times and the rest goes to the rows of
    least hash of (``doc_id``, text). Of the row at which the budget ends as many words are
    taken as are left; equal rows there (same id and text) share these evenly.
    No row exceeds ``most`` times its size. Null sources are one source. Other columns of
    ``docs`` are ignored.

    ``options``: ``weights``, ``share`` and ``most`` of ``source_targets``. An empty table gives no rows.
    """
    return _planned(docs, **options).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0, 1, 2, ... times).

    The row at which a source's budget ends is taken whole or not, whichever is nearer. Rows
    without words cost nothing: they stay once. A row is known by id, text and source; columns
    may have any names.
    """
    plan = _planned(docs, **options).selectExpr(
        "doc_id", "source", "mark", "IF(size = 0, 1, CAST(round(taken / size) AS INT)) AS copies"
    ).distinct()
    # The whole row lies in one column, so that its names cannot clash with those used here.
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("row_id"),
        F.col("source").cast("string").alias("row_source"),
        F.expr(f"xxhash64(doc_id, text) & {(1 << BITS) - 1}").alias("row_mark"),
    )
    same = (F.col("row_mark") == F.col("mark")) & F.col("row_id").eqNullSafe(F.col("doc_id"))
    same = same & F.col("row_source").eqNullSafe(F.col("source"))
    copied = whole.join(plan, same).select("row", F.explode(F.expr("array_repeat(0, copies)")).alias("copy"))
    return copied.select("row.*")
