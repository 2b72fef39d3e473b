"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words is the product of their weighted counts of character triples,
where a triple may skip up to two characters and counts ``decay`` to the power of its span,
divided by the words' norms. Inserted characters therefore leave most of an insult's
triples in place. ``m`` words of the labelled texts serve as landmarks; a word's feature
vector is its kernel values times the root of the inverse landmark matrix, and a linear
machine on these vectors is trained on whole labelled texts as bags of words: of a toxic
text the word that scores highest counts as positive, of a clean one all words are negative.

The trained function is a sum over landmarks of kernel values, hence a sum over the word's
triples of one number each: scoring looks these up and never evaluates a kernel.
A text's score is a logistic function of the scores of its three worst words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DECAY = 0.75
#: Places of a triple's characters, by span.
TRIPLES = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
EDGE = 63
SPACE = re.compile(r"\s+")
#: Letters that stand alone, a space or mark apart, are read as one word.
LONE = re.compile(r"(?<!\w)(?:[^\W\d_][ .*_-]){2,}[^\W\d_](?!\w)")
BETWEEN = re.compile(r"[ .*_-]")


def _codes(text: str) -> np.ndarray:
    """Character codes 1..62 and, at the edges of words, EDGE; 0 between words. None without words."""
    text = LONE.sub(lambda m: BETWEEN.sub("", m.group()), text)
    text = " " + SPACE.sub(" ", text.lower()).strip(" ") + " "
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = (points >= 97) & (points <= 122)
    codes = np.where(letters, points - 96, 27 + points % 36).astype(np.int32)
    spaces = points == 32
    # Marks such as "!!" or "***" at a word's end are no part of it.
    strip = ~letters & (points < 128) & ~spaces & ~((points >= 48) & (points <= 57))
    order = np.where(spaces | ~strip, np.arange(len(points)), 0)
    back = np.where(spaces | ~strip, np.arange(len(points)), len(points))
    before = np.maximum.accumulate(order)
    after = np.minimum.accumulate(back[::-1])[::-1]
    edge = strip & (spaces[before] | spaces[np.minimum(after, len(points) - 1)])
    codes, spaces = codes[~edge], spaces[~edge]
    if spaces.all():
        return np.empty(0, np.int32)
    # Each space becomes EDGE 0 EDGE, so that the ends of words take part in triples.
    out = np.repeat(codes, np.where(spaces, 3, 1))
    at = np.cumsum(np.where(spaces, 3, 1))[spaces]
    out[at - 3], out[at - 2], out[at - 1] = EDGE, 0, EDGE
    return out[1:-1]


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape of triple: its code at each start, whether it lies in one word, weight."""
    size = len(codes)
    ends = np.cumsum(codes == 0)
    for second, third in TRIPLES:
        n = size - third
        if n <= 0:
            continue
        whole = (ends[:n] == ends[third:]) & (codes[:n] > 0)
        yield (
            (codes[:n] << 12) | (codes[second : second + n] << 6) | codes[third:],
            whole,
            DECAY ** (third + 1),
        )


def _words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the words in ``codes`` and the norm of each."""
    starts = np.flatnonzero(np.concatenate([[True], codes[:-1] == 0]) & (codes > 0))
    if not len(starts):
        return starts, np.empty(0)
    square = np.zeros(len(codes))
    for _, whole, weight in _triples(codes):
        square[: len(whole)] += whole * weight**2
    return starts, np.sqrt(np.maximum(np.add.reduceat(square, starts), 1e-9))


def word_scores(text: str | None, table: np.ndarray) -> np.ndarray:
    """The score of each word of ``text``, without the machine's offset."""
    codes = _codes(text or "")
    starts, norms = _words(codes)
    if not len(starts):
        return np.empty(0)
    total = np.zeros(len(codes), np.float32)
    for code, whole, weight in _triples(codes):
        total[: len(code)] += np.where(whole, table[code], 0) * np.float32(weight)
    return np.add.reduceat(total, starts) / norms


def worst_three(scores: np.ndarray) -> np.ndarray:
    """The three highest word scores, highest first; none below -1, which is what missing words count."""
    return np.sort(np.concatenate([np.full(3, -1.0), scores]))[:-4:-1]


def word_vector(word: str) -> dict[int, float]:
    """A word's triples with their weights, of norm about one."""
    codes = _codes(word)
    _, norms = _words(codes)
    out: dict[int, float] = {}
    for code, whole, weight in _triples(codes):
        for c in code[whole].tolist():
            out[c] = out.get(c, 0.0) + weight / norms[0]
    return out


@dataclass(frozen=True)
class ToxicityModel:
    """A number for each triple; slopes and offset that turn the worst scores into a probability."""

    table: np.ndarray
    slopes: np.ndarray
    offset: float

    def probability(self, text: str | None) -> float:
        latent = worst_three(word_scores(text, self.table)) @ self.slopes + self.offset
        return float(1 / (1 + np.exp(-np.clip(latent, -30, 30))))


def _sorted_words(text: str) -> list[str]:
    text = LONE.sub(lambda m: BETWEEN.sub("", m.group()), text).lower()
    return sorted({w for w in (re.sub(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", "", x) for x in text.split()) if w})


def _kernel(vectors: list[dict[int, float]], landmarks: list[dict[int, float]]) -> np.ndarray:
    """Kernel values of words against landmarks, through the landmarks' own triples."""
    place = {c: k for k, c in enumerate(sorted({c for v in landmarks for c in v}))}
    dense = np.zeros((len(place), len(landmarks)), np.float32)
    for k, vector in enumerate(landmarks):
        for c, x in vector.items():
            dense[place[c], k] = x
    out = np.zeros((len(vectors), len(landmarks)), np.float32)
    for start in range(0, len(vectors), 2000):
        part = vectors[start : start + 2000]
        rows = np.zeros((len(part), len(place)), np.float32)
        for r, vector in enumerate(part):
            for c, x in vector.items():
                if c in place:
                    rows[r, place[c]] = x
        out[start : start + 2000] = rows @ dense
    return out


def _hinge(rows: np.ndarray, signs: np.ndarray, weight: np.ndarray, steps: int = 150) -> np.ndarray:
    """Squared-hinge machine with an offset (last number), by accelerated gradient steps."""
    rows = np.column_stack([rows, np.ones(len(rows), np.float32)])
    weight = weight / weight.sum()
    moment = (rows * weight[:, None]).T @ rows
    rate = 1 / (2 * np.linalg.eigvalsh(moment)[-1] + 1e-4)
    now = ahead = np.zeros(rows.shape[1])
    for step in range(steps):
        slack = np.maximum(0, 1 - signs * (rows @ ahead))
        gradient = -2 * rows.T @ (weight * signs * slack) + 1e-4 * ahead
        new = ahead - rate * gradient
        ahead = new + step / (step + 3) * (new - now)
        now = new
    return now


def fit(texts: list[str], labels: list[int], landmarks: int = 160, rounds: int = 4) -> ToxicityModel:
    """The machine from labelled texts (1: toxic). One class only gives a constant score."""
    signs = np.array(labels)
    if not len(signs) or signs.min() == signs.max():
        rate = float(signs.mean()) if len(signs) else 0.0
        return ToxicityModel(np.zeros(1 << 18, np.float32), np.zeros(3), 6.0 * (2 * rate - 1))
    bags = [_sorted_words(t) for t in texts]
    names = sorted({w for b in bags for w in b})
    number = {w: k for k, w in enumerate(names)}
    bags = [np.array([number[w] for w in b], np.int64) for b in bags]
    hot, cold = np.zeros(len(names)), np.zeros(len(names))
    for bag, label in zip(bags, signs, strict=True):
        (hot if label else cold)[bag] += 1
    # A word about as frequent in clean texts cannot be what makes a text toxic.
    rate = hot / max(1, signs.sum())
    fit_for = rate >= 4 * cold / max(1, (1 - signs).sum())
    lift = np.where(fit_for, (hot + 0.1) / (hot + cold + 1.0) * np.log1p(hot), -1.0)
    # Negative words: those of clean texts that are commonest, or look most like insults.
    order = np.lexsort((np.arange(len(names)), -lift))
    picked = order[: landmarks * 4 // 5]
    common = np.lexsort((np.arange(len(names)), -cold))[: landmarks // 5]
    chosen = sorted({*picked.tolist(), *common.tolist()})
    vectors = {k: word_vector(names[k]) for k in chosen}
    marks = [vectors[k] for k in chosen]
    base = _kernel(marks, marks).astype(float)
    values, basis = np.linalg.eigh(base)
    keep = values > 1e-3
    root = basis[:, keep] / np.sqrt(values[keep])
    table = np.zeros(1 << 18, np.float32)
    scores = lift
    for turn in range(rounds):
        able = [b[fit_for[b]] for b, y in zip(bags, signs, strict=True) if y]
        witness = [b[np.argmax(scores[b])] for b in able if len(b)]
        positive, times = np.unique(witness, return_counts=True)
        clean = np.flatnonzero(cold > 0)
        hard = clean[np.lexsort((clean, -scores[clean]))[:4000]]
        negative = np.setdiff1d(np.union1d(hard, common[cold[common] > 0]), positive)
        both = np.concatenate([positive, negative])
        rows = _kernel([vectors.setdefault(k, word_vector(names[k])) for k in both.tolist()], marks) @ root
        weight = np.concatenate([
            np.sqrt(times) / np.sqrt(times).sum(),
            np.sqrt(cold[negative]) / np.sqrt(cold[negative]).sum(),
        ])
        target = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        plane = _hinge(rows, target, weight)
        share = root @ plane[:-1]
        table = np.zeros(1 << 18, np.float32)
        for vector, x in zip(marks, share, strict=True):
            for c, v in vector.items():
                table[c] += x * v
        whole = "\n".join(names)
        scores = word_scores(whole, table)
        if len(scores) != len(names):  # a name without letters: score words one by one
            scores = np.array([max(word_scores(w, table), default=-1.0) for w in names])
    worst = np.array([worst_three(word_scores(t, table)) for t in texts])
    return ToxicityModel(table, *_platt(worst, signs))


def _platt(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic slopes (never negative) and offset by projected Newton steps.

    Clean texts weigh three quarters, whatever their share of the sample.
    """
    share = np.where(labels == 1, 0.25 / max(1, labels.sum()), 0.75 / max(1, (1 - labels).sum()))
    rows = np.column_stack([values, np.ones(len(values))])
    at = np.zeros(rows.shape[1])
    at[0] = 1.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ at, -30, 30)))
        gradient = rows.T @ (share * (p - labels)) + 1e-4 * at
        curve = (rows * (share * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(len(at))
        at = at - np.clip(np.linalg.solve(curve, gradient), -1, 1)
        at[:-1] = np.maximum(at[:-1], 0)
    return at[:-1], float(at[-1])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1500, fold: str = "true", **options) -> ToxicityModel:
    """A model from at most ``per_class`` labelled texts of each class, the same on each run.

    ``fold`` is a condition on ``doc_id`` that rows to learn from meet. Those of least
    ``xxhash64(doc_id)`` are taken; where an id has several texts, those of least hash, and equal
    rows count once. Texts go whole to the driver, at most ``2 * per_class`` of them.
    """
    rated = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        f"doc_id IS NOT NULL AND toxic IN (0, 1) AND ({fold})"
    )
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = rated.where("toxic = 1").orderBy(*order).limit(per_class).unionByName(
        rated.where("toxic = 0").orderBy(*order).limit(per_class)
    )
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    mark = F.xxhash64("text").alias("mark")
    rows = rows.groupBy("doc_id", "toxic", mark).agg(F.min("text").alias("text"))
    got = [rows.where(f"toxic = {k}").orderBy(*order, "mark").limit(per_class) for k in (0, 1)]
    got = sorted(got[0].unionByName(got[1]).collect(), key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    return fit([r["text"] for r in got], [r["toxic"] for r in got], **options)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score`` in 0..1 per row of ``docs``.

    Null and wordless texts get the lowest score there is. Repeated rows are scored each, other
    columns are ignored, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.probability(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
