"""Quality classifier: ordinal cumulative-link regression on hashed text features.

``P(grade <= k) = sigmoid(threshold_k - w . x)`` with one weight vector for all grades and
rising thresholds. ``x`` is a text's hashed character 3-grams and 6-grams of character
classes, as roots of their relative frequencies (length one for each half).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HALF = 4096
PRIME = np.uint32(2654435761)
#: Character classes of bytes: lower, upper, digit, space, line end, other ASCII, beyond ASCII.
CLASSES = np.full(256, 5, np.uint32)
CLASSES[128:] = 0
CLASSES[ord("a") : ord("z") + 1] = 0
CLASSES[ord("A") : ord("Z") + 1] = 1
CLASSES[ord("0") : ord("9") + 1] = 2
CLASSES[ord(" ")] = 3
CLASSES[[9, 10, 11, 12, 13]] = 4


def _counts(codes: np.ndarray) -> np.ndarray:
    found = np.bincount((codes * PRIME) >> np.uint32(20), minlength=HALF).astype(np.float32)
    total = found.sum()
    return np.sqrt(found / total) if total else found


def features(text: str | None) -> np.ndarray:
    """``2 * HALF`` numbers; all zero for null, empty and very short texts."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    small = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint32)
    grams = small[:-2] | small[1:-1] << np.uint32(8) | small[2:] << np.uint32(16)
    kind = CLASSES[raw]
    shapes = np.zeros(max(0, len(raw) - 5), np.uint32)
    for at in range(6):
        shapes = shapes * np.uint32(7) + kind[at : at + len(shapes)]
    return np.concatenate([_counts(grams), _counts(shapes + np.uint32(1))])


def packed(row: np.ndarray) -> bytes:
    """The features of a text as half-precision numbers: the places of those that are not zero, then these."""
    small = row.astype(np.float16)
    at = np.flatnonzero(small)
    return at.astype(np.uint16).tobytes() + small[at].tobytes()


def unpacked(raw: bytes, width: int = 2 * HALF) -> np.ndarray:
    row = np.zeros(width, np.float16)
    half = len(raw) // 2
    row[np.frombuffer(raw[:half], np.uint16)] = np.frombuffer(raw[half:], np.float16)
    return row


@dataclass(frozen=True)
class OrdinalModel:
    """Weights, rising thresholds between the sorted ``grades``."""

    grades: tuple[float, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, rows: np.ndarray) -> np.ndarray:
        """P(grade > grades[k]) for each row and k below the last."""
        at = self.thresholds[None, :] - (rows @ self.weights)[:, None]
        return 1 / (1 + np.exp(np.clip(at, -60, 60)))


def fit_ordinal(rows: np.ndarray, ratings: np.ndarray, steps: int = 200, decay: float = 1e-4) -> OrdinalModel:
    """Maximum likelihood with a weight penalty, by full-batch Adam from a fixed start.

    Without ratings every text gets grade 0; with a single grade every text gets it.
    """
    grades = np.unique(ratings)
    cuts = len(grades) - 1
    if cuts < 1:
        return OrdinalModel(tuple(grades.tolist()) or (0.0,), np.zeros(rows.shape[1]), np.empty(0))
    level = np.searchsorted(grades, ratings)
    below = np.array([np.clip((level <= k).mean(), 1e-3, 1 - 1e-3) for k in range(cuts)])
    start = np.log(below / (1 - below))
    gaps = np.log(np.maximum(np.diff(start), 1e-3))
    theta = np.concatenate([np.zeros(rows.shape[1]), start[:1], gaps])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    width = rows.shape[1]
    each = np.arange(len(level))
    rows = np.ascontiguousarray(rows, np.float32)  # products stay in single precision
    for step in range(1, steps + 1):
        first, rise = theta[width], np.exp(theta[width + 1 :])
        cut = first + np.concatenate([[0.0], np.cumsum(rise)])
        under = 1 / (1 + np.exp(-np.clip(cut[None, :] - (rows @ theta[:width].astype(np.float32))[:, None], -40, 40)))
        full = np.column_stack([np.zeros(len(level)), under, np.ones(len(level))])
        slope = full * (1 - full)
        high, low = full[each, level + 1], full[each, level]
        mass = np.maximum(high - low, 1e-9)
        # d(-log mass) by the latent value and by each threshold
        latent = (slope[each, level + 1] - slope[each, level]) / mass / len(level)
        push = np.zeros((len(level), cuts + 2))
        push[each, level + 1] -= slope[each, level + 1] / mass
        push[each, level] += slope[each, level] / mass
        by_cut = push[:, 1:-1].mean(axis=0)
        tail = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.concatenate(
            [rows.T @ latent.astype(np.float32) + decay * theta[:width], tail[:1], tail[1:] * rise]
        )
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= 0.2 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    cut = theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1 :]))])
    return OrdinalModel(tuple(grades.tolist()), theta[:width], cut)


def train(docs: DataFrame, ratings: DataFrame, grade: str, max_rows: int = 3000) -> OrdinalModel:
    """A model from at most ``max_rows`` rated documents, the same ones on each run.

    Those of least ``xxhash64(doc_id)`` are taken; ratings or texts that are null are not. Where
    an id has several texts, those of least hash are taken, and equal rows count once.
    The driver receives ``max_rows`` feature vectors, without their zeros.
    """
    chosen = (
        ratings.select("doc_id", F.col(grade).cast("double").alias("grade"))
        .where("doc_id IS NOT NULL AND grade IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade")
        .limit(max_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [packed(features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), pa.array(rows, pa.binary())],
                ["doc_id", "grade", "x"],
            )

    # max_rows bounds what is broadcast.
    rated = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    rated = rated.groupBy("doc_id", "grade", F.xxhash64("text").alias("mark")).agg(F.min("text").alias("text"))
    rated = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade", "mark").limit(max_rows)
    kind = rated.schema["doc_id"].dataType.simpleString()
    found = rated.select("doc_id", "grade", "text").mapInArrow(
        run, f"doc_id {kind}, grade double, x binary"
    )
    got = sorted(found.collect(), key=lambda r: (r["doc_id"], r["grade"]))
    grades = np.array([r["grade"] for r in got], float)
    rows = np.empty((len(got), 2 * HALF), np.float32)
    k = 0
    for _, same in groupby(got, lambda r: (r["doc_id"], r["grade"])):
        for row in sorted((unpacked(bytes(r["x"])) for r in same), key=lambda x: x.tobytes()):
            rows[k] = row
            k += 1
    return fit_ordinal(rows, grades)


def score(docs: DataFrame, model: OrdinalModel, above: float | None = None, keep_mark: bool = False) -> DataFrame:
    """``doc_id``, ``expected_grade``, ``tail_probability`` (of a grade over ``above``) per row.

    ``above`` is the least grade by default. Null and empty texts are scored as texts
    without features, repeated rows each, other columns are ignored, and an empty table
    gives no rows. ``keep_mark`` adds ``mark``, the hash of the text.
    """
    above = model.grades[0] if above is None else above
    steps = np.diff(np.array(model.grades))
    tail = next((k for k, g in enumerate(model.grades[:-1]) if g >= above), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tails = np.zeros((len(texts), len(steps)))
            for row, text in enumerate(texts):
                tails[row] = model.tails(features(text)[None, :])[0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(model.grades[0] + tails @ steps),
                    pa.array(tails[:, tail] if tail is not None else np.zeros(len(texts))),
                    *([batch.column("mark")] if keep_mark else []),
                ],
                ["doc_id", "expected_grade", "tail_probability"] + ["mark"] * keep_mark,
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    mark = [F.xxhash64("text").alias("mark")] if keep_mark else []
    return docs.select("doc_id", "text", *mark).mapInArrow(
        run, f"doc_id {kind}, expected_grade double, tail_probability double" + ", mark long" * keep_mark
    )


def good_documents(docs: DataFrame, model: OrdinalModel, least_tail: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all columns, whose tail probability is ``least_tail`` or more.

    Each row is judged by its own text, whatever other rows have its ``doc_id``.
    """
    scored = score(docs.select("doc_id", "text"), model, keep_mark=True)
    bad = scored.where(F.col("tail_probability") < least_tail)
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark")).distinct()
    on = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_mark"])
    return docs.join(bad, on, "left_anti")
