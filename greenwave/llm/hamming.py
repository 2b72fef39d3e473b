"""Nearest neighbours by multi-index hashing of learned binary codes.

A rotation learned on a bounded sample (principal axes, then alternating sign codes and
orthogonal Procrustes steps) turns each vector into a binary code. The code is split into
substrings and each substring is indexed. Two codes within Hamming radius ``r`` of each
other agree in at least one of ``m`` substrings up to ``r // m`` bits (one bit less in all but
the first ``r % m + 1`` of them), so probing those buckets retrieves every code within the
radius. What is found is ranked by exact distances of the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenwave.llm.common import stored

POPCOUNT = np.array([bin(k).count("1") for k in range(1 << 16)], np.uint8)


@dataclass(frozen=True)
class Codes:
    """Centre and rotation; a code's bits lie in substrings of at most 16 bits."""

    centre: np.ndarray
    rotation: np.ndarray

    @property
    def widths(self) -> list[int]:
        bits = self.rotation.shape[1]
        tables = max(1, -(-bits // 16))
        return [bits // tables + (k < bits % tables) for k in range(tables)]

    def of(self, rows: np.ndarray) -> list[np.ndarray]:
        """For each substring its value for each row."""
        signs = (rows - self.centre) @ self.rotation > 0
        parts, at = [], 0
        for width in self.widths:
            bits = signs[:, at : at + width].astype(np.uint16)
            parts.append((bits << np.arange(width, dtype=np.uint16)).sum(axis=1).astype(np.uint16))
            at += width
        return parts


def learn_codes(sample: np.ndarray, bits: int = 64, steps: int = 40) -> Codes:
    """Codes of at most ``bits`` bits from ``sample``; the same sample gives the same codes."""
    size = sample.shape[1]
    bits = min(bits, size)
    if not len(sample):
        return Codes(np.zeros(size), np.eye(size)[:, :bits])
    centre = sample.mean(axis=0)
    _, axes = np.linalg.eigh((sample - centre).T @ (sample - centre))
    axes = axes[:, ::-1][:, :bits]
    flat = (sample - centre) @ axes
    turn = np.linalg.qr(np.random.default_rng(7).normal(size=(bits, bits)))[0]
    for _ in range(steps):
        u, _, vt = np.linalg.svd(np.sign(flat @ turn).T @ flat)
        turn = vt.T @ u.T
    return Codes(centre, axes @ turn)


def substring_radii(radius: int, tables: int) -> list[int]:
    """Radii to probe so that every code within ``radius`` is met in some table."""
    return [radius // tables - (k > radius % tables) for k in range(tables)]


def within(query: list[int], index: list[tuple[np.ndarray, np.ndarray]], parts, radius: int) -> np.ndarray:
    """Rows whose code is within ``radius``: probe the buckets, then count all bits."""
    met = np.zeros(len(parts[0]), bool)
    for value, (buckets, member), limit in zip(
        query, index, substring_radii(radius, len(index)), strict=True
    ):
        if limit >= 0:
            met |= (POPCOUNT[buckets ^ np.uint16(value)] <= limit)[member]
    found = np.flatnonzero(met)
    bits = np.zeros(len(found), np.int64)
    for value, part in zip(query, parts, strict=True):
        bits += POPCOUNT[part[found] ^ np.uint16(value)]
    return found[bits <= radius]


def _nearest(rows: np.ndarray, ids: np.ndarray, square: np.ndarray, query: np.ndarray, own, found: np.ndarray, k: int):
    """The ``k`` nearest of ``found`` by (exact distance, id)."""
    found = found[ids[found] != own]
    if len(found) > k:
        rough = square[found] - 2 * (rows[found] @ query)
        edge = np.partition(rough, k - 1)[k - 1]
        found = found[rough <= edge + 1e-9 * (1 + abs(edge) + query @ query)]
    exact = np.sqrt(((rows[found] - query) ** 2).sum(axis=1))
    best = np.lexsort((ids[found], exact))[:k]
    return exact[best], ids[found][best]


def _search_block(vectors: DataFrame, queries: list, codes: Codes, k: int, radius: int) -> DataFrame:
    """The ``k`` nearest within the radius of each query, per partition of ``vectors``."""
    points = np.array([q["vector"] for q in queries], float)
    names = [q["vec_id"] for q in queries]
    wanted = np.column_stack(codes.of(points)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.empty(0), np.empty(0, np.int64)) for _ in names]
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            rows = flat.reshape(len(ids), -1)
            square = (rows**2).sum(axis=1)
            parts = codes.of(rows)
            index = [np.unique(p, return_inverse=True) for p in parts]
            for q, own in enumerate(names):
                found = within(wanted[q], index, parts, radius)
                far, near = _nearest(rows, ids, square, points[q], own, found, k)
                far = np.concatenate([best[q][0], far])
                near = np.concatenate([best[q][1], near])
                keep = np.lexsort((near, far))[:k]
                best[q] = (far[keep], near[keep])
        yield pa.RecordBatch.from_pydict(
            {
                "query_id": pa.array(np.repeat(np.array(names, np.int64), [len(b[0]) for b in best])),
                "vec_id": pa.array(np.concatenate([b[1] for b in best]), pa.int64()),
                "score": pa.array(np.concatenate([b[0] for b in best]), pa.float64()),
            }
        )

    return vectors.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: str,
    k: int = 10,
    bits: int = 64,
    radius_share: float = 0.47,
    sample_rows: int = 5000,
    query_block: int = 10_000,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (Euclidean distance), nearest first.

    Queries are the rows of ``vectors`` (``vec_id`` long, ``embedding``) that meet the condition
    ``is_query``; candidates are all rows of another ``vec_id``. Every row is indexed; codes
    are learned on the ``sample_rows`` rows of least ``xxhash64(vec_id)``. Codes within
    ``radius_share`` of their bits are retrieved and ranked by exact distance, ties to the
    smaller id. A query with fewer than ``k`` found is searched again with the full radius,
    so it gets ``k`` or all candidates.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor
    do ids that are null and vectors of another length than the commonest (the longer of two).
    Repeated rows are candidates each. Queries pass through the driver in blocks of
    ``query_block``, one scan of the rows for each block.
    """
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    good = (
        vectors.where(f"vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND {finite}")
        .where("exists(embedding, x -> x <> 0)")
        .selectExpr("vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS vector", "size(embedding) AS length")
    )
    lengths = good.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    spark = vectors.sparkSession
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = lengths["length"]
    good = good.where(F.col("length") == size).drop("length")
    order = [F.xxhash64("vec_id"), "vec_id", F.xxhash64("vector")]
    sample = good.orderBy(*order).limit(sample_rows).collect()
    codes = learn_codes(np.array([r["vector"] for r in sample], float).reshape(-1, size), bits)
    total = codes.rotation.shape[1]

    def search(asked: DataFrame, radius: int) -> DataFrame | None:
        """Blocks by ranges of the id: each is one condition on the rows, never all queries at once."""
        count = asked.count()
        if not count:
            return None
        blocks = -(-count // query_block)
        place = F.expr(f"pmod(xxhash64(vec_id), {blocks})")
        parts = [
            _search_block(good, rows, codes, k, radius)
            for b in range(blocks)
            if (rows := asked.where(place == b).collect())
        ]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return stored(found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "found")

    queries = stored(good.where(is_query), "queries")
    found = search(queries, int(radius_share * total))
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    full = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = queries.join(full, queries["vec_id"] == full["query_id"], "left_anti")
    again = search(short, total)
    if again is not None:
        found = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(
            again, allowMissingColumns=True
        )
    return found.select("query_id", "rank", "vec_id", "score")
