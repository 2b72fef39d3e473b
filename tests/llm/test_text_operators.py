"""Near duplicates, decontamination, mixing, classifiers and token files against brute force."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from greenwave.llm import components, mixing, ngram_join, quality, token_files, toxicity, winnowing
from greenwave.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, key string"


def frame(spark, rows):
    """Documents with further columns whose names operators use inside."""
    return spark.createDataFrame(
        [(i, t, "en", s, None, 1, "k") for i, t, s in rows], DOCS
    )


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= 75 * (len(sets[a]) + len(sets[b]) - same):
            parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[find(k)].append(i)
    return sorted(
        (i, len(sets[k]), min((x for x in least[find(k)] if x is not None), default=None))
        if sets[k] else (i, 0, i)
        for k, (i, _) in enumerate(rows)
        if i is not None
    )


@pytest.fixture(scope="module")
def corpus():
    """Groups of near copies of many sizes, shared passages, and awkward rows."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice((6, 40, 90, 160)))
        for _ in range(rng.choice((1, 2, 5, 60 if group == 3 else 9))):
            copy = list(base)
            for _ in range(rng.randrange(6)):
                at = rng.randrange(len(copy))
                if rng.random() < 0.3:
                    del copy[at]
                else:
                    copy[at] = rng.choice(vocabulary)
            text = " ".join(copy)
            rows.append(passage + "\n" + text if rng.random() < 0.3 else text)
    rows += [passage, passage.upper(), None, "", " \t\n", "one two", "One  TWO", "é É", "É É", "x " * 3000]
    return list(enumerate(rows)) + [(3, rows[3]), (None, "one two"), (None, None)]


def test_near_duplicates(spark, corpus):
    docs = frame(spark, [(i, t, "s") for i, t in corpus])
    got = ngram_join.near_duplicate_classes(docs).collect()
    assert len(got) == len(corpus)
    found = sorted(tuple(r) for r in got if r["doc_id"] is not None)
    assert found == brute_classes(corpus)
    kept = {r["doc_id"] for r in ngram_join.representatives(docs).collect()}
    assert kept == {i for i, _, c in found if i == c} | {None}


def test_near_duplicates_of_nothing(spark):
    docs = frame(spark, [])
    assert ngram_join.near_duplicate_classes(docs).count() == 0


def test_a_copy_without_id_links_two_documents(spark):
    base = " ".join(f"w{k}" for k in range(200))
    more = [" ".join(f"{a}{k}" for k in range(40)) for a in "ac"]
    docs = frame(spark, [(1, f"{base} {more[0]}", "s"), (None, base, "s"), (2, f"{more[1]} {base}", "s")])
    for options in ({}, {"broadcast_rows": 0}):
        got = ngram_join.near_duplicate_classes(docs, **options).collect()
        assert [r["component_id"] for r in got] == [1, 1, 1]
    assert [r["doc_id"] for r in ngram_join.representatives(docs).collect()] == [1]
    apart = ngram_join.near_duplicate_classes(docs.where("doc_id IS NOT NULL")).collect()
    assert sorted(r["component_id"] for r in apart) == [1, 2]


def test_filters_judge_rows_not_ids(spark):
    """Null and repeated ids with different texts: only the rejected rows go."""
    long = [f"{a} " + " ".join(f"{a}{k}" for k in range(60)) for a in "pqrs"]
    rows = [(1, long[0]), (1, long[1]), (2, long[1] + " z"), (2, long[2]), (3, long[3]), (3, long[3]), (None, long[0])]
    rows += [(0, long[1]), (None, "uu vv"), (None, "uu vv"), (None, "ww"), (None, None)]
    kept = ngram_join.representatives(frame(spark, [(*r, "s") for r in rows]))
    assert kept.columns == frame(spark, []).columns
    want = [(0, long[1]), (1, long[0]), (2, long[2]), (3, long[3]), (None, "uu vv"), (None, "ww"), (None, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)
    docs = frame(spark, [(i, t, "s") for i in (1, None) for t in ("b " * 20, "clean " + " ".join(long[0]), "")])
    benchmark = spark.createDataFrame([(1, "b " * 10)], "item_id long, text string")
    clean = winnowing.clean_documents(docs, benchmark).collect()
    assert len(clean) == 4 and all(not r["text"].startswith("b ") for r in clean)
    model = quality.OrdinalModel((0.0, 1.0), quality.features("b " * 20), np.array([0.5]))
    good = quality.good_documents(docs, model).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in good) == [("1", "b " * 20), ("None", "b " * 20)]


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (None, 1), (1, 2)]
    pairs += [(100 + k, 101 + k) for k in range(40)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 20: 20, 21: 20, 5: 5} | {100 + k: 100 for k in range(41)}


def brute_hits(text, items):
    split = lambda t: re.findall(winnowing.WORD, re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    w = split(text)
    hit, names = set(), set()
    for name, item in items:
        x = split(item)
        n = min(10, len(x))
        for k in range(len(x) - n + 1) if n else ():
            for at in range(len(w) - n + 1):
                if w[at : at + n] == x[k : k + n]:
                    hit.update(range(at, at + n))
                    names.add(str(name))
    return len(w), len(hit), sorted(names)


def test_contamination(spark):
    rng = random.Random(2)
    letters = [f"t{k}" for k in range(12)]
    items = [(k, " ".join(rng.choices(letters, k=rng.choice((2, 7, 10, 14, 30))))) for k in range(12)]
    items += [(50, "one"), (51, ""), (52, None), (None, "t1 t2 t3"), (0, items[0][1]), (53, "É-é 5x")]
    texts = []
    for k in range(40):
        text = rng.choices(letters, k=rng.choice((0, 5, 9, 10, 60)))
        item = (rng.choice(items)[1] or "").split()
        cut = rng.randrange(4)
        texts.append(" ".join(text[:20] + item[cut : len(item) - rng.randrange(3)] + text[20:]).upper())
    texts += [None, "", "One, two", "É é 5X", "! ! !", " ".join(["t1"] * 3000), texts[3]]
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)] + [(3, texts[3], "s"), (None, texts[4], "s")])
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    got = winnowing.find_contamination(docs, benchmark).collect()
    known = [(i, t) for i, t in items if i is not None]
    want = {k: brute_hits(t, known) for k, t in enumerate(texts)}
    assert len(got) == len(texts) + 2
    for r in got:
        expected = want[4 if r["doc_id"] is None else r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["items"]) == expected
        assert r["contaminated"] == (expected[1] > 0)
    # The same with shuffled instead of broadcast joins.
    again = winnowing.find_contamination(docs, benchmark, broadcast_rows=0).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    clean = winnowing.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {k for k, v in want.items() if not v[1]}


def test_contamination_of_nothing(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, [(1, "a b", "s")])
    assert [tuple(r) for r in winnowing.find_contamination(docs, empty).collect()] == [(1, 2, 0, [], False)]
    assert winnowing.find_contamination(frame(spark, []), empty).count() == 0


def test_source_targets():
    targets = mixing.source_targets({"b": 100, "a": 10, None: 50, "c": 1000})
    # a: weight 3, b: 1, c: 2, null: 3; the budget is 1740.
    assert targets["a"] == 20 and targets[None] == 100 and targets["b"] == 200
    assert targets["c"] == pytest.approx(1740 - 320)
    assert mixing.source_targets({}) == {}
    assert mixing.source_targets({"a": 0}) == {"a": 0.0}


def test_mix(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(60), rng.choice(("a", "b", "c", None))) for k in range(600)]
    rows += [(7, None, "a"), (None, "x y z", "d"), (None, "x y z", "d"), (1, rows[1][1], rows[1][2])]
    docs = frame(spark, rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    totals = Counter()
    for _, t, s in rows:
        totals[s] += len(words_of(t))
    targets = mixing.source_targets(dict(totals))
    taken, size = Counter(), Counter()
    for r in got:
        key = r["target"], r["source_size"]
        taken[key] += r["taken"]
        size[key] += r["size"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s, n in totals.items():
        assert abs(taken[targets[s], n] - targets[s]) <= 2
        assert size[targets[s], n] == n
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns
    times = Counter(r["doc_id"] for r in copies.collect() if r["text"])
    assert max(times[k] for k in range(2, 600)) <= 2
    assert mixing.mix(frame(spark, [])).count() == 0


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(900, 20)).astype(np.float32)
    latent = rows @ np.linspace(-2, 2, 20) + rng.logistic(size=900)
    grades = np.digitize(latent, (-3.0, 0.0, 4.0)).astype(float)
    model = quality.fit_ordinal(rows[:600], grades[:600])
    assert np.all(np.diff(model.thresholds) > 0) and model.grades == (0, 1, 2, 3)
    tails = model.tails(rows[600:])
    assert np.all(np.diff(tails, axis=1) <= 1e-9)
    assert np.corrcoef(tails.sum(axis=1), grades[600:])[0, 1] > 0.8
    alone = quality.fit_ordinal(rows[:5], np.ones(5))
    assert alone.grades == (1.0,) and alone.tails(rows[:2]).shape == (2, 0)


def test_quality_scores(spark):
    good = ["The cat sat on the mat and looked at the rain outside today." + "x" * (k % 3) for k in range(40)]
    bad = ["BUY!! NOW!! $$$ %%% ### CHEAP!! " * (1 + k % 4) for k in range(40)]
    docs = frame(spark, list((k, t, "s") for k, t in enumerate(good + bad)) + [(98, None, "s"), (99, "", "s"), (3, good[3], "s")])
    ratings = spark.createDataFrame(
        [(k, int(k < 40)) for k in range(0, 80, 2)] + [(None, 1), (98, 1), (1, None)], "doc_id long, quality int"
    )
    model = quality.train(docs, ratings, "quality")
    got = {r["doc_id"]: r["expected_grade"] for r in quality.score(docs, model).collect()}
    assert min(got[k] for k in range(40)) > 0.5 > max(got[k] for k in range(40, 80))
    kept = quality.good_documents(docs, model)
    assert kept.columns == docs.columns and not any(40 <= r["doc_id"] < 80 for r in kept.collect())
    none = quality.train(docs, ratings.where("false"), "quality")
    assert {r["expected_grade"] for r in quality.score(docs, none).collect()} == {0.0}


def test_toxicity_kernel_is_what_the_table_sums():
    words = ["idiot", "id-iot", "reading", "scum"]
    vectors = [toxicity.word_vector(w) for w in words]
    table = np.zeros(1 << 18, np.float32)
    for c, x in vectors[0].items():
        table[c] = x
    direct = [sum(v.get(c, 0) * x for c, x in vectors[0].items()) for v in vectors]
    assert np.allclose([toxicity.word_scores(w, table)[0] for w in words], direct, atol=1e-5)
    assert direct[0] > direct[1] > direct[2]
    assert toxicity.word_scores("i d i o t", table)[0] == pytest.approx(direct[0], abs=1e-5)
    assert len(toxicity.word_scores(None, table)) == len(toxicity.word_scores(" \n", table)) == 0


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fold = "pmod(crc32(CAST(doc_id AS STRING)), 3) <> 1"
    model = toxicity.train(docs, labels, per_class=400, fold=fold)
    held = docs.join(labels, "doc_id").where(f"NOT ({fold})").select("doc_id", "text", "toxic", "lang")
    rows = toxicity.score(held, model).join(held.select("doc_id", "toxic"), "doc_id").collect()
    hit = [r["score"] >= 0.7 for r in rows if r["toxic"] == 1]
    false = [r["score"] >= 0.7 for r in rows if r["toxic"] == 0]
    assert sum(hit) >= 0.8 * len(hit) and sum(false) <= 0.04 * len(false)
    edge = toxicity.score(frame(spark, [(1, None, "s"), (2, "", "s"), (2, "!!", "s")]), model).collect()
    assert all(0 <= r["score"] < 0.1 for r in edge)
    assert toxicity.train(docs, labels.where("toxic = 0")).probability("x") < 0.5


def test_coder_round_trip():
    rng = np.random.default_rng(3)
    for n, lanes, kinds in ((1, 1, 2), (70_000, 16, 300), (1000, 7, 2), (5000, 1024, 5000)):
        codes = np.minimum(rng.geometric(0.02, n) - 1, kinds - 1)
        tokens, share = token_files.scale({k: 1 + int((codes == k).sum()) for k in range(kinds)})
        assert share.sum() == 1 << token_files.SCALE_BITS and share.min() >= 1
        states, words, marks = token_files.encode(codes, share, lanes)
        assert np.array_equal(token_files.decode(states, words, n, share), codes)
        for step, place, saved in marks:
            tail = token_files.decode(saved, words, n, share, step, place)
            assert np.array_equal(tail, codes[step * lanes :])
    tokens, share = token_files.scale({5: 9})
    assert len(tokens) == 3 - (5 in (0, 1)) and share.sum() == 1 << token_files.SCALE_BITS


AWKWARD = [
    "", " ", "  two  spaces ", "a\n b", "a \nb", "tab\t x", "it's  don't 's", "É ñ 中文 字 🙂 🙂x", "x" * 3000, " lead",
    "trail ", "\n\n", "a  b   c", "<|endoftext|> x <|endoftext|>", "1 22 333", " nb sp  x", "  em", None,
]


def test_pieces_are_encoded_as_by_the_library(spark):
    small, large = token_files.PieceMemory(tokenizer_file(), 40), token_files.PieceMemory(tokenizer_file())
    texts = AWKWARD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        want = large.tool.encode(text or "", add_special_tokens=False).ids
        assert large.encode(text).tolist() == want == small.encode(text).tolist()
    assert len(small.chunks) <= 40 and len(small.pieces) <= 40


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(tokenizer_file())
    rows = [(k, t, "s") for k, t in enumerate(AWKWARD * 3)][::-1] + [(0, "again", "s"), (None, "no id", "s")]
    path = str(tmp_path / "tokens")
    token_files.write_token_files(frame(spark, rows), path, tokenizer_file())
    got = {(r["doc_id"], bytes(r["ids"])): r for r in token_files.read_token_files(spark, path).collect()}
    want = sorted(
        ((i, np.array(tool.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()) for i, t, _ in rows),
        key=lambda r: (r[0] is not None, r[0] or 0),
    )
    assert sorted(got, key=str) == sorted({w for w in want}, key=str)
    starts = sorted((r["start"], r["n_tokens"]) for r in got.values())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    order = [i for _, i in sorted((r["start"], r["doc_id"]) for r in got.values() if r["doc_id"] is not None)]
    assert order == sorted(order)
    row = spark.read.parquet(f"{path}/blocks").first().asDict()
    row["words"] = bytes([row["words"][0] ^ 1]) + bytes(row["words"][1:])
    share = np.array([r["frequency"] for r in spark.read.parquet(f"{path}/frequencies").orderBy("token").collect()])
    with pytest.raises(ValueError, match="damaged"):
        token_files.block_codes(row, share)


def test_token_files_of_nothing(spark):
    assert token_files.encode_and_read(frame(spark, []), tokenizer_file()).count() == 0


def test_classifiers_train_on_bounded_rows(spark, monkeypatch):
    """Labelled ids on very many rows send few to the driver, and both classes."""
    docs = [(1 + k % 2, ("good words here " if k % 2 else "bad scum idiot ") + str(k % 90), "s") for k in range(4000)]
    table = frame(spark, docs)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, marks, **_: seen.append((len(texts), set(marks))))
    toxicity.train(table, labels, per_class=15)
    monkeypatch.setattr(quality, "fit_ordinal", lambda rows, grades: seen.append((len(rows), set(grades.tolist()))))
    quality.train(table, labels, "quality", max_rows=30)
    assert [n for n, _ in seen] == [30, 30] and seen[0][1] == {0, 1}


def test_wordless_texts_score_lowest(spark):
    texts = ["You total scum and idiot", "lovely reading by the river", "a calm day", "they sent idiots"] * 5
    model = toxicity.fit(texts, [1, 0, 0, 1] * 5)
    rows = [(k, t, "s") for k, t in enumerate(["river", "a calm day", "scum", None, "", " \n", "!! ** --"])]
    found = {r["doc_id"]: r["score"] for r in toxicity.score(frame(spark, rows), model).collect()}
    blank = [found[k] for k in (3, 4, 5, 6)]
    assert len(set(blank)) == 1 and all(blank[0] <= found[k] for k in (0, 1, 2))
    assert toxicity.score(frame(spark, []), model).collect() == []


def test_mixed_documents_with_one_text_under_several_sources_and_clashing_names(spark):
    names = "doc_id long, text string, source string, copies int, mark long, mixed_id long, row string, copy int, _mark int"
    rows = [(1, "same words here " * 5, s, 7, 8, 9, "r", 1, 2) for s in ("a", "b", "c")]
    rows += [(k, f"other {k} " * 9, "abc"[k % 3], 1, 2, 3, "x", 4, 5) for k in range(2, 20)]
    rows += [(None, None, None, None, None, None, None, None, None), (30, "", "a", 1, 2, 3, "y", 0, 0)]
    docs = spark.createDataFrame(rows, names)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter(map(tuple, mixed.collect()))
    assert set(times) <= set(rows) and max(times.values()) <= 2
    plan = {(r["doc_id"], r["source"]): r for r in mixing._planned(docs).collect()}
    for row in rows:
        r = plan[(row[0], row[2])]
        assert times[row] == (1 if r["size"] == 0 else round(r["taken"] / r["size"]))
    assert mixing.mixed_documents(docs.where("false")).collect() == []


def test_mix_takes_what_its_histograms_would_by_sorting(spark):
    """``taken`` row by row against sorting each source by hash."""
    rng = random.Random(9)
    rows = [(k, "w " * rng.randrange(1, 60), "abcd"[min(3, rng.randrange(9))]) for k in range(300)]
    got = {r["doc_id"]: r for r in mixing._planned(frame(spark, rows)).collect()}
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    for source, target in mixing.source_targets(dict(sizes)).items():
        assert all(got[i]["target"] == target and got[i]["source_size"] == sizes[s] for i, _, s in rows if s == source)
        whole, left = divmod(target, sizes[source])
        left = target - whole * sizes[source]
        for r in sorted((got[i] for i, _, s in rows if s == source), key=lambda r: r["mark"]):
            extra = min(r["size"], max(0, int(left)))
            assert r["taken"] == min(2 * r["size"], int(whole) * r["size"] + extra)
            left -= r["size"]
