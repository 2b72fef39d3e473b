"""Spelling variants: k-d trees over letter counts find words one edit apart.

One inserted or deleted letter changes a word's letter counts by one, a replaced letter by two.
Words of each length lie in a k-d tree over their letter counts. A word searches the tree of its
own length within two and that of the next length within one; boxes farther away are pruned, and
what is found is kept if the letters' order agrees. The trees' upper levels deal words out to
tasks, their lower levels are built inside a task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.llm.common import UPPER, broadcast_below, stored

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
#: Place of each Latin-1 code among the letters.
PLACE = np.zeros(256, np.uint8)
PLACE[np.frombuffer(LETTERS.encode("latin-1"), np.uint8)] = np.arange(len(LETTERS))
#: Bytes that one comparison of letter order takes at most.
CHUNK = 1 << 24


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, typo_every: int = 31) -> DataFrame:
    """``word``, ``n``: the words of all texts with their number of occurrences.

    A run of letters, A-Z in lower case, loses one letter where the crc32 of ``doc_id:run`` is
    divisible by ``typo_every``; results of at least ``least_length`` letters that occur
    ``least_count`` times are words. A null id reads as empty. Tasks count before the
    shuffle, in bounded tables.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")  # shorter runs cannot get long enough
    small = str.maketrans(UPPER, UPPER.lower())

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                for word, n in Counter(runs.findall(text.translate(small))).items():
                    mark = zlib.crc32(f"{name}:{word}".encode())
                    if mark % typo_every == 0:
                        at = mark % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    counts[word] += n
                if len(counts) > 200_000:
                    yield counted(counts)
                    counts.clear()
        yield counted(counts)

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    found = docs.where("text IS NOT NULL").select(name, "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_codes(words: list[str]) -> np.ndarray:
    """Latin-1 codes of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(codes), len(LETTERS)), np.int16 if codes.shape[1] < 1 << 15 else np.int32)
    rows = np.arange(len(codes))
    for at in range(codes.shape[1]):
        counts[rows, PLACE[codes[:, at]]] += 1
    return counts


def build_tree(points: np.ndarray, size: int):
    """Nested ``(letter, limit, lower, upper)`` down to leaves of ``size`` points; a leaf holds row numbers.

    Each split takes the letter and the limit that part the points most evenly. Equal points
    stay together, in a leaf of any size.
    """

    def split(rows: np.ndarray):
        if len(rows) <= size:
            return rows
        part = points[rows]
        limits = np.vstack([np.full((3, part.shape[1]), [[0], [1], [2]]), np.floor(part.mean(0))]).astype(int)
        shares = np.array([(part <= limit).mean(0) for limit in limits])
        level, letter = np.unravel_index(np.abs(shares - 0.5).argmin(), shares.shape)
        if shares[level, letter] in (0.0, 1.0):
            return rows
        limit = int(limits[level, letter])
        low = part[:, letter] <= limit
        return int(letter), limit, split(rows[low]), split(rows[~low])

    return split(np.arange(len(points)))


def numbered(tree, first: int = 0):
    """``tree`` with leaves replaced by consecutive numbers, and how many there are."""
    if not isinstance(tree, tuple):
        return first, first + 1
    letter, limit, lower, upper = tree
    lower, first = numbered(lower, first)
    upper, first = numbered(upper, first)
    return (letter, limit, lower, upper), first


def reached(tree, queries: np.ndarray, radius: int) -> Iterator[tuple[object, np.ndarray]]:
    """Each leaf with the rows of ``queries`` whose L1 distance to its box is at most ``radius``."""
    high = np.iinfo(np.int32).max
    stack = [(tree, np.arange(len(queries)), np.zeros(len(queries), np.int64), {})]
    while stack:
        node, rows, far, box = stack.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            yield node, rows
            continue
        letter, limit, lower, upper = node
        least, most = box.get(letter, (0, high))
        at = queries[rows, letter].astype(np.int64)
        far = far - np.maximum(least - at, 0) - np.maximum(at - most, 0)
        for child, ends in ((lower, (least, limit)), (upper, (limit + 1, most))):
            now = far + np.maximum(ends[0] - at, 0) + np.maximum(at - ends[1], 0)
            near = now <= radius
            stack.append((child, rows[near], now[near], {**box, letter: ends}))


def _alike(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words grouped by equal letters: one of each group, words by group, starts and sizes of groups."""
    keys = np.ascontiguousarray(np.sort(codes, axis=1)).view(f"S{codes.shape[1]}").ravel()
    _, first, group, sizes = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return first, np.argsort(group, kind="stable"), np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of codes differ by exactly one letter: replaced, or inserted in ``long``."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    width = short.shape[1]
    front = np.logical_and.accumulate(short == long[:, :width], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= width


def one_edit_pairs(queries: np.ndarray, points: np.ndarray, leaf: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``queries`` and of ``points`` (codes of equal length, or points one longer) one edit apart.

    Words of equal letters are searched as one. Among those that meet in a leaf, letters in
    common are counted as a matrix product over (letter, occurrence).
    """
    q_first, q_rows, q_start, q_size = _alike(queries)
    p_first, p_rows, p_start, p_size = _alike(points)
    q_counts, p_counts = letter_counts(queries[q_first]), letter_counts(points[p_first])
    width = queries.shape[1]
    same = width == points.shape[1]
    shared = width - 1 if same else width
    most = np.minimum(q_counts.max(0), p_counts.max(0))
    steps = [(letter, k) for letter in np.flatnonzero(most) for k in range(1, most[letter] + 1)]
    at, least = np.array([s[0] for s in steps], int), np.array([s[1] for s in steps], int)
    for rows, near in reached(build_tree(p_counts, leaf), q_counts, 2 if same else 1):
        right = (p_counts[rows][:, at] >= least).astype(np.float32).T
        for begin in range(0, len(near), 4096):
            some = near[begin : begin + 4096]
            left = (q_counts[some][:, at] >= least).astype(np.float32)
            a, b = np.nonzero(left @ right == shared)
            a, b = some[a], rows[b]
            # Every word of a group with every word of the other, in bounded parts.
            ways = q_size[a] * p_size[b]
            ends = np.cumsum(ways)
            done = 0
            while done < len(a):
                room = (ends[done - 1] if done else 0) + max(1, CHUNK // (2 * width + 1))
                upto = max(done + 1, int(np.searchsorted(ends, room, "right")))
                part = slice(done, upto)
                pair = np.repeat(np.arange(upto - done), ways[part])
                place = np.arange(len(pair)) - np.repeat(ends[part] - ways[part] - (ends[done] - ways[done]), ways[part])
                x = q_rows[q_start[a[part]][pair] + place // p_size[b[part]][pair]]
                y = p_rows[p_start[b[part]][pair] + place % p_size[b[part]][pair]]
                good = _one_edit(queries[x], points[y])
                yield x[good], y[good]
                done = upto


def _best(n: np.ndarray, words: list[str]) -> np.ndarray:
    """Rank of each word: largest ``n`` first, then code-point order."""
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return rank


def _tally(mine: np.ndarray, theirs: np.ndarray, many: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Near words of each of ``many`` words, and the least rank among them."""
    least = np.full(many, len(rank), np.int64)
    np.minimum.at(least, mine, rank[theirs])
    return np.bincount(mine, minlength=many), least


def _search(table: pa.Table) -> pa.Table:
    """Near words within one part of a cell: for each word ``n_near``, and the best one's ``n`` and text."""
    kinds = table.column("kind").to_numpy()
    words = np.array(table.column("word").to_pylist(), object)
    times = table.column("n").to_numpy()
    found = []

    def report(names, n, other_names, other_n, mine, theirs):
        rank = _best(other_n, other_names)
        count, least = _tally(mine, theirs, len(names), rank)
        by_rank = np.argsort(rank)
        for i in np.flatnonzero(count):
            best = by_rank[least[i]]
            found.append((names[i], int(count[i]), -int(other_n[best]), other_names[best]))

    points, point_n = words[kinds == 0].tolist(), times[kinds == 0]
    for kind in (1, 2):
        names, n = words[kinds == kind].tolist(), times[kinds == kind]
        if not names or not points:
            continue
        pairs = list(one_edit_pairs(letter_codes(names), letter_codes(points)))
        x = np.concatenate([p[0] for p in pairs] or [np.empty(0, np.int64)])
        y = np.concatenate([p[1] for p in pairs] or [np.empty(0, np.int64)])
        report(names, n, points, point_n, x, y)
        if kind == 2:
            report(points, point_n, names, n, y, x)
    columns = zip(*found) if found else [()] * 4
    kinds_out = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.Table.from_arrays(
        [pa.array(v, k) for v, k in zip(columns, kinds_out)], ["word", "n_near", "least_n", "best"]
    )


def near_words(
    words: DataFrame, cell_words: int = 20_000, part_queries: int = 100_000, sample_rows: int = 50_000
) -> DataFrame:
    """``word``, ``n_near``, ``form_n``, ``best``: number of near words, and the one of largest ``n``.

    ``words``: distinct ``word``, ``n``, stored. Words without near words are left out. Trees
    of about ``cell_words`` words a leaf are fitted on the ``sample_rows`` words of least hash;
    the sample decides only how evenly words are dealt out. A leaf that comes out larger, or that is
    searched by more words, is cut into parts, every part of words being searched by every
    part of queries, so no task holds more than ``2 * cell_words + part_queries`` words at once.
    """
    sizes = dict(words.groupBy(F.length("word")).count().collect())
    sample: dict[int, list[str]] = {}
    for row in words.orderBy(F.xxhash64("word"), "word").limit(sample_rows).select("word").collect():
        sample.setdefault(len(row["word"]), []).append(row["word"])
    trees = {}
    for length, many in sizes.items():
        chosen = sample.get(length, [])
        counts = letter_counts(letter_codes(chosen)) if chosen else np.empty((0, len(LETTERS)))
        trees[length] = numbered(build_tree(counts, max(1, len(chosen) * cell_words // many)))[0]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = np.array(batch.column("word").to_pylist(), object)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                counts = letter_counts(letter_codes(texts[mine].tolist()))
                for kind, other, radius in ((0, length, 0), (1, length, 2), (2, length + 1, 1)):
                    if int(other) not in trees:
                        continue
                    for leaf, rows in reached(trees[int(other)], counts, radius):
                        taken = batch.take(pa.array(mine[rows]))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(rows), other, np.int32)),
                                pa.array(np.full(len(rows), leaf, np.int32)),
                                pa.array(np.full(len(rows), kind, np.int32)),
                                taken.column("word"),
                                taken.column("n"),
                            ],
                            ["length", "leaf", "kind", "word", "n"],
                        )

    dealt = stored(
        words.select("word", "n").mapInArrow(deal, "length int, leaf int, kind int, word string, n long"), "cells"
    )
    parts = stored(
        dealt.groupBy("length", "leaf")
        .agg(F.count_if(F.col("kind") == 0).alias("points"), F.count_if(F.col("kind") > 0).alias("queries"))
        .selectExpr(
            "length",
            "leaf",
            f"CAST(ceil(points / {2 * cell_words}) AS INT) AS p_parts",
            f"CAST(ceil(queries / {part_queries}) AS INT) AS q_parts",
        )
        .where("p_parts > 0 AND (p_parts > 1 OR q_parts > 1)"),
        "parts",
    )
    units = dealt.join(broadcast_below(parts, 1_000_000), ["length", "leaf"], "left").selectExpr(
        "length",
        "leaf",
        "kind",
        "word",
        "n",
        "CAST(pmod(xxhash64(word), coalesce(IF(kind = 0, p_parts, q_parts), 1)) AS INT) AS mine",
        "explode(sequence(0, coalesce(IF(kind = 0, q_parts, p_parts), 1) - 1)) AS other",
    )
    units = units.selectExpr(
        "length", "leaf", "kind", "word", "n", "IF(kind = 0, mine, other) AS p", "IF(kind = 0, other, mine) AS q"
    )
    found = units.groupBy("length", "leaf", "p", "q").applyInArrow(
        _search, "word string, n_near long, least_n long, best string"
    )
    best = F.min(F.struct("least_n", "best"))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("b"))
        .selectExpr("word", "n_near", "-b.least_n AS form_n", "b.best AS best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of all words with a ``form``: forms of forms, by doubling steps.

    Each form is at least ``dominance`` times as frequent as its word, so ways are short and
    the rounds few.
    """
    ways = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = stored(
            ways.join(onward, "root", "left").selectExpr("word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved"),
            "roots",
        )
        if not ways.where("moved").limit(1).count():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def spelling_variants(docs: DataFrame, dominance: int = 10, **options) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of every word of ``vocabulary(docs)``.

    Two words are near if exactly one letter is inserted, deleted or replaced between them.
    ``form``: the near word of largest ``n`` (ties: least in code-point order), if that is at
    least ``dominance`` times the word's own; ``root``: the last of forms of forms, else the
    word. Null and empty texts hold no words, repeated rows count each time, other columns of
    ``docs`` are ignored, and an empty table gives no rows. ``dominance`` is 2 or more.
    """
    words = stored(vocabulary(docs, **options), "vocabulary")
    near = near_words(words)
    known = words.join(near, "word", "left").selectExpr(
        "word",
        "n",
        "coalesce(n_near, 0L) AS n_near",
        f"IF(form_n >= {dominance} * n, best, NULL) AS form",
        f"IF(form_n >= {dominance} * n, form_n, NULL) AS form_n",
    )
    known = stored(known, "forms")
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").selectExpr(
        "word", "n", "n_near", "form", "form_n", "coalesce(root, word) AS root"
    )
