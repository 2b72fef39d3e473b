"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from greenwave.llm import spelling

DOCS = "doc_id long, text string, word string, n long, form string, length int, kind int"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    """Documents with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, "w", 1, "f", 2, 3) for i, t in rows], DOCS)


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, every=31, dominance=10):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            mark = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if mark % every == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, out = {}, {}
    for w, n in words.items():
        others = sorted((-words[v], v) for v in words if near(w, v))
        best = others[0] if others else (0, None)
        good = others and -best[0] >= dominance * n
        forms[w] = best[1] if good else None
        out[w] = (n, len(others), forms[w], -best[0] if good else None)
    for w in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (*out[w], root)
    return out


def got(df):
    rows = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


def mutated(word, rng):
    at, letter = rng.randrange(len(word)), rng.choice("abeéÀ÷z")
    return rng.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :], word[:at] + letter + word[at:]])


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = ["".join(rng.choices("abeé", k=rng.randint(7, 10))) for _ in range(60)]
    base += ["aaaaaaaa", "aaaaaaaaa", "a" * 700, "a" * 701, "Straßenbahn", "REISEBÜRO", "reisebÜro"]
    chain = ["kjihgfedcba" + "z" * k for k in range(4)]  # each form ten times as frequent as the one before
    words = base * 3 + [mutated(w, rng) for w in base * 12] + base[:10] * 40
    rng.shuffle(words)
    rows = [(k, " ".join(words[k :: 40]) + "\n1" + words[k] + "2.") for k in range(40)]
    rows += [(100 + k, f"{w} " * 2 * 11**k) for k, w in enumerate(chain)]
    rows += [(None, "nullwort nullwort nullworts nullworts"), (7, None), (8, ""), (9, "- 12"), (3, rows[3][1]), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("limits", [{}, {"cell_words": 20, "part_queries": 60, "sample_rows": 150}])
def test_variants_equal_brute_force(spark, corpus, limits, monkeypatch):
    search = spelling.near_words
    monkeypatch.setattr(spelling, "near_words", lambda words: search(words, **limits))
    want = brute(corpus, every=5)
    found = got(spelling.spelling_variants(frame(spark, corpus).repartition(5), typo_every=5))
    assert found == want
    assert max(v[1] for v in want.values()) > 3
    assert want["kjihgfedcba"][4] not in (want["kjihgfedcba"][2], "kjihgfedcba")


def test_other_bounds(spark):
    rows = [(1, "tree trees three trie trie tree tree tree tree tree"), (2, "Tree TRIE trees")]
    found = got(spelling.spelling_variants(frame(spark, rows), least_length=4, dominance=2, typo_every=10**12))
    assert found == {
        "tree": (7, 2, None, None, "tree"),
        "trie": (3, 1, "tree", 7, "tree"),
        "trees": (2, 1, "tree", 7, "tree"),
    }


def test_empty_and_wordless(spark):
    assert spelling.spelling_variants(frame(spark, [])).collect() == []
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, "ab cd"), (None, "")])).collect() == []


def test_boxes_hold_each_point_once_and_all_within_reach():
    rng = np.random.default_rng(3)
    points = rng.integers(0, 4, (500, 6)).astype(np.int16)
    queries = rng.integers(0, 4, (200, 6)).astype(np.int16)
    tree = spelling.build_tree(points, 8)
    leaves = [rows for rows, _ in spelling.reached(tree, queries[:0], 0)] or []
    homes = [(i, tuple(rows)) for rows, mine in spelling.reached(tree, points, 0) for i in mine]
    assert len(homes) == len(points) and all(i in rows for i, rows in homes) and leaves == []
    met = {(q, p) for rows, mine in spelling.reached(tree, queries, 2) for q in mine for p in rows}
    far = np.abs(queries[:, None, :] - points[None]).sum(2)
    assert {(q, p) for q, p in zip(*np.nonzero(far <= 2))} <= met
    assert len(met) < 0.5 * far.size
