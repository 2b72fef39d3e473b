"""The prefix trie against a trie of nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from greenwave.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, depth long, k1 long, top string"


def frame(spark, rows):
    """Turns with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 1, 2, "t") for r in rows], TURNS)


def brute(rows, heads=9, family=5):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1] or 0, x[2], x[3]))] for c, v in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        sign = 1 if c >= 0 else -1
        base = sign * (abs(c) - abs(c) % family)
        rebuilt[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members, ends = defaultdict(set), defaultdict(list)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals, out = {}, []
    for node in sorted(members, key=len, reverse=True):
        below = [totals[x] for x in children[node]]
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(b[0] for b in below) or 1, own_saved + sum(b[1] for b in below))
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), *totals[node], digest))
    return sorted(out, key=repr)


def got(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert df.columns == names
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = []
    for c in [*range(60), *range(-12, 0), 10**15, 10**15 + 1, 983]:
        for turn in range(rng.randint(1, 12)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "é", "bb", "long " * 40])))
    for c in range(100, 140):  # copies, with their bases
        rows += [(c, turn, "user", f"same {turn}") for turn in range(11)]
    for c in (200, 205, 210, 215):  # long ones in common, over several blocks
        rows += [(c, turn, "user", f"deep {turn % 7}") for turn in range(60 + (c == 215))]
    rows += [(300, None, "user", "first"), (300, -5, None, None), (300, 2, "user", None), (300, 2, "user", "x"), (300, 2, "b", "z")]
    rows += [(300, 2, "user", "x"), (None, 1, "user", "nobody"), (None, 1, None, None), (301, None, None, None)]
    rows += [(c, 0, "user", "one turn") for c in range(401, 430, 2)]  # many are left without turns
    rng.shuffle(rows)
    return rows


SMALL = {"shard_convs": 6, "queue_limit": 3}


@pytest.mark.parametrize("limits", [{}, SMALL, {"shard_convs": 1, "top_nodes": 60}])
def test_trie_equals_brute_force(spark, corpus, limits, monkeypatch):
    if limits:
        monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    assert got(prefix_trie.prefix_trie(frame(spark, corpus).repartition(4), **limits)) == brute(corpus)


def test_some_conversations_have_no_turns(corpus):
    """The corpus holds members that end at the root."""
    root = next(x for x in brute(corpus) if x[1] == 0)
    assert root[-1] != hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(5, 1, "a", "b")], [(7, 1, "a", "b")], [(5, 0, "a", "b"), (6, 0, "a", "b")]])
def test_few_rows(spark, rows):
    assert got(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_digest_of_many_ids_at_one_node(spark):
    ids = list(range(-50, 3000))
    ends = spark.range(-50, 3000).selectExpr("1L AS k1", "2L AS k2", "id AS conv_id").repartition(5)
    found = prefix_trie.end_digests(ends, chunk=100).collect()
    assert [tuple(r) for r in found] == [(1, 2, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]


def test_queue_sums_by_key_in_order_with_and_without_spills():
    rng = random.Random(1)
    for limit in (10**6, 7):
        queue, sums = prefix_trie.SpillingQueue(limit), defaultdict(lambda: [0, 0])
        for _ in range(500):
            message = (-rng.randint(0, 3), rng.randint(0, 5), rng.randint(0, 2), rng.randint(1, 9), rng.randint(0, 9))
            queue.put(message)
            sums[message[:3]][0] += message[3]
            sums[message[:3]][1] += message[4]
        assert (queue.spills > 0) == (limit == 7)
        for key in sorted(sums):
            assert list(queue.take(key)) == sums[key]
        assert not queue.heap and not queue.runs
