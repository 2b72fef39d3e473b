"""Registered queries against SQL, and the pipeline against a brute-force version, on the smallest data."""

from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
import numpy as np
import pytest
import zlib
from check_oracle import difference, duck

from greenwave.llm import mixing, quality
from greenwave.llm.queries import ORACLE, QUERIES, tokenizer_file
from tests.llm.test_text_operators import brute_classes, brute_hits

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert difference(spark, duck(SF), name, SF) is None


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


def test_pipeline(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(table, labels, "quality")
    left = [i for i, r in docs.items() if model.tails(quality.features(r["text"])[None, :])[0, 0] >= 0.5]
    assert 0.7 * len(docs) < len(left) < len(docs)
    left = [i for i, _, c in brute_classes([(i, docs[i]["text"]) for i in left]) if i == c]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [i for i in left if brute_hits(docs[i]["text"], items)[1] == 0]
    got = corpus_pipeline.run(spark, SF).orderBy("start", "doc_id").collect()
    times = Counter(r["doc_id"] for r in got)
    assert set(times) <= set(left) and max(times.values()) <= 2
    # The mix takes from each source its target, up to the row at which the budget ends.
    words, taken = Counter(), Counter()
    longest = Counter()
    for i in left:
        n, s = len(docs[i]["text"].encode().split()), docs[i]["source"]
        words[s] += n
        taken[s] += n * times[i]
        longest[s] = max(longest[s], n)
    for s, target in mixing.source_targets(dict(words)).items():
        assert abs(taken[s] - target) <= longest[s]
    from tokenizers import Tokenizer

    tool, at = Tokenizer.from_file(tokenizer_file()), 0
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
    for r in got:
        ids = tool.encode(docs[r["doc_id"]]["text"], add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc)
        at += len(ids)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int, mark long, key long, row string"


def write_tables(spark, folder, docs, labels, items):
    tables = {
        "documents": spark.createDataFrame([(i, t, "en", s, 1, 2, 3, 4, "r") for i, t, s in docs], DOCS),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(items, "item_id long, text string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pipeline_on_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, write_tables(spark, tmp_path, [], [], [])).collect() == []


def test_pipeline_on_awkward_rows(spark, tmp_path, monkeypatch):
    """Null and repeated ids, empty texts and columns whose names the stages use."""
    def good(k):
        return " ".join(f"word{(k * 37 + j) % 997}" for j in range(80))

    passage = " ".join(f"secret{j}" for j in range(12))
    docs = [(k, good(k * 5), "ab"[k % 2]) for k in range(30)]
    docs += [(3, good(15), "b"), (100, good(0) + " tail", "a"), (None, good(900), None), (None, None, None), (101, "", "a")]
    docs += [(7, good(700), "c"), (102, good(333) + " " + passage, "a"), (103, None, "b")]
    all_good = quality.OrdinalModel((0.0, 1.0), np.zeros(2 * quality.HALF), np.array([-10.0]))
    monkeypatch.setattr(quality, "train", lambda *_: all_good)
    folder = write_tables(spark, tmp_path, docs, [(k, 1, 0) for k in range(5)], [(1, passage), (2, None)])
    got = corpus_pipeline.run(spark, folder).orderBy("start").collect()
    times = Counter(r["doc_id"] for r in got)
    assert 102 not in times  # holds the passage
    assert 100 not in times  # near copy of 0
    assert {None, 101, 103} <= set(times)  # what has no words costs nothing and stays
    assert times[7] <= 4 and max(n for i, n in times.items() if i not in (3, 7, None)) <= 2
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] >= 1
        at += r["n_tokens"]
