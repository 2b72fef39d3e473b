"""Work that is done once, and what does not stay or travel; results as before."""

import random
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from greenwave.llm import common, ngram_join, quality, token_files
from greenwave.llm.queries import tokenizer_file
from tests.llm.test_text_operators import AWKWARD, frame


def test_training_vectors_travel_without_zeros(spark, monkeypatch):
    """The driver gets a vector's nonzero numbers only, and fits on the same rows in the same order."""
    texts = ["", "ab", "plain words by the river", "ÄÖ 12!! \n x" * 40]
    for text in texts:
        row = quality.features(text)
        raw = quality.packed(row)
        assert quality.unpacked(raw).tobytes() == row.astype(np.float16).tobytes()
        assert len(raw) == 4 * np.count_nonzero(row.astype(np.float16))
    seen = []
    monkeypatch.setattr(quality, "fit_ordinal", lambda rows, grades: seen.append((rows, grades)))
    docs = frame(spark, [(k % 3, t, "s") for k, t in enumerate(texts)])
    quality.train(docs, spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int"), "quality")
    want = sorted(((k % 3, quality.features(t).astype(np.float16).tobytes()) for k, t in enumerate(texts)))
    assert [r.astype(np.float16).tobytes() for r in seen[0][0]] == [x for _, x in want]
    assert seen[0][1].tolist() == [1, 1, 0, 1]


def test_texts_are_hashed_once_for_keys_and_first_order(spark, monkeypatch):
    """Beside the survivors, whose whole sets are read, each text is cut into shingles once."""
    calls, plain = [], ngram_join._sets
    monkeypatch.setattr(ngram_join, "_sets", lambda *a: calls.append(a) or plain(*a))
    base = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(base), "s"), (2, " ".join([*base, "end"]), "s"), (3, "other words here", "s"), (4, None, "s")]
    got = ngram_join.near_duplicate_classes(frame(spark, rows)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got} == {(1, 56, 1), (2, 57, 1), (3, 1, 3), (4, 0, 4)}
    assert len(calls) == 2


def test_stored_leaves_no_shuffle_files(spark):
    def shuffles():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for k in range(found.size()) if (n := found.apply(k).getName()).startswith("shuffle_")}

    before, set_before = shuffles(), spark.conf.get(common.CLEANUP)
    df = common.stored(spark.range(1000).repartition(5, "id").groupBy(F.expr("id % 7 AS a")).count(), "shuffled")
    assert {(r["a"], r["count"]) for r in df.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
    assert spark.conf.get(common.CLEANUP) == set_before
    for _ in range(40):  # the files go in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.25)
    assert not left


def test_many_texts_are_encoded_as_by_the_library(monkeypatch):
    """Cut in slices, whatever the white space, and a chunk of a slice is read once."""
    odd = ["a\n", "b a\n", "ÿ ÿ a", "c\rd \re", "\n b", "a\x85 b", "a  b c", "x　 y  z", "a\x1c b", "q\x0b r "]
    tool = token_files.PieceMemory(tokenizer_file(), 40)
    for size in (1, 50, 1 << 20):
        monkeypatch.setattr(token_files, "SLICE_BYTES", size)
        for texts in (AWKWARD + odd, (AWKWARD + odd)[::-1] * 2, [""], [None], [" "], [], ["中文 字 z 中 é" * 3, "字 z"]):
            got = list(tool.encode_all(pa.array(texts, pa.string())))
            want = [tool.tool.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert [g.tolist() for g in got] == want
    assert len(tool.pieces) <= 40
    cut = []
    monkeypatch.setattr(token_files.PieceMemory, "_tidy", lambda self, c, f=tool._tidy: cut.append(c.to_pylist()) or f(c))
    assert len(list(tool.encode_all(pa.array(["one two three two", "a two three"] * 50)))) == 100
    assert [sorted(c) for c in cut] == [["three", "two"]]


def test_chunks_are_cut_by_columns_and_a_piece_is_encoded_once(monkeypatch):
    """The pattern sees first chunks and those with apostrophes or adjacent white space, the library each piece once."""
    pick = random.Random(3)
    letters = [*"abÉñß09²'.,\"\n\t\r\x0b\x1c\x85\xa0ÿɏ", "'s", "'re", "ll"]
    chunks = ["".join(pick.choices(letters, k=pick.randint(1, 7))) for _ in range(4000)]
    chunks = [c for c in chunks if not c[-1].isspace()]
    want = [token_files.PIECE.findall(f" {c}") for c in chunks]
    pieces, n = token_files._cut(pa.array(chunks).slice(1))
    assert (pieces.to_pylist(), n.tolist()) == (sum(want[1:], []), list(map(len, want[1:])))

    cut, asked = [], []
    pattern = SimpleNamespace(findall=lambda text, find=token_files.PIECE.findall: cut.append(text) or find(text))
    monkeypatch.setattr(token_files, "PIECE", pattern)
    tool = token_files.PieceMemory(tokenizer_file())
    read = tool._encoded
    tool._encoded = lambda pieces: asked.extend(pieces.to_pylist()) or read(pieces)
    text = "It plain, words\nétés it's 12a a\n\nb plain, " + "z" * 100
    for _ in range(3):
        got = [ids.tolist() for ids in tool.encode_all(pa.array([text, f"{text} words"]))]
        assert got == [tool.tool.encode(t, add_special_tokens=False).ids for t in (text, f"{text} words")]
    assert set(cut) == {"It", " it's a\n\nb"}
    long = " " + "z" * 100  # not remembered
    assert {p: asked.count(p) for p in asked} == {p: 3 if p == long else 1 for p in asked} and " words" in asked
