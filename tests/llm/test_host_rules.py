"""Host rules against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest

from greenwave.llm import host_rules

DOCS = "doc_id long, text string, source string, host string, n_words long, failing string, kept boolean"


def frame(spark, rows):
    """Documents with further columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, s, "h", 1, "x", False) for i, t, s in rows], DOCS)


def brute_measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if times[w] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(covered), len(lines)


def brute_verdicts(rows, limit=0.5):
    """Name of the first failed rule by host, priors by the method of moments."""
    rules = [
        lambda n, c, s, d, r, l: n < 50,
        lambda n, c, s, d, r, l: 100 * r > 50 * n,
        lambda n, c, s, d, r, l: 10 * s > n,
        lambda n, c, s, d, r, l: 100 * d > 30 * l,
        lambda n, c, s, d, r, l: n > 0 and (c < 3 * n or c > 10 * n),
    ]
    hosts = defaultdict(list)
    for _, text, source in rows:
        m = brute_measures(text)
        hosts[source].append([rule(*m) for rule in rules])
    total = sum(map(len, hosts.values()))
    failed = {}
    for k, name in list(enumerate(host_rules.RULES)):
        counts = {h: (len(v), sum(x[k] for x in v)) for h, v in hosts.items()}
        p = sum(c for _, c in counts.values()) / total
        seen = sum(n * (c / n - p) ** 2 for n, c in counts.values())
        others = len(hosts) - 1
        room = p * (1 - p) * (total - sum(n * n for n, _ in counts.values()) / total - others)
        r = min(1, max(1e-6, (seen - p * (1 - p) * others) / room)) if room > 0 else 1e-6
        s = 1 / r - 1
        for h, (n, c) in counts.items():
            if (c + s * p) / (n + s) > limit:
                failed.setdefault(h, name)
    return failed


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeéß", k=rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(k, prose(rng.randint(55, 90)), f"good{k % 7}") for k in range(140)]
    rows += [(200 + k, prose(60) if k % 4 == 0 else prose(9), "mostly-short") for k in range(40)]
    rows += [(300, prose(8), "half-short"), (301, prose(80), "half-short")]  # one failure does not condemn the other
    rows += [(400 + k, f"{prose(3)}\n" * 30 if k % 5 else prose(60), "repeats") for k in range(30)]
    rows += [(500 + k, prose(60) + " # * | <>" * 4, None) for k in range(25)]
    rows += [(600, None, "good1"), (601, "", None), (602, " \n\t\r\n\x0b", "good2"), (None, prose(70), "good3")]
    rows += [(603, "x y z \n" * 20, "good4"), (604, prose(20000), "good5"), (0, rows[0][1], "good0")]
    rows += [(605, "same line\n" * 3 + "  \n \n" + "\r\nsame line\r\n", "good6")]
    rng.shuffle(rows)
    return rows


def test_measures(corpus):
    for _, text, _ in corpus:
        assert host_rules.measures(text) == brute_measures(text)


def test_judged_as_by_plain_counting(spark, corpus):
    failed = brute_verdicts(corpus)
    assert set(failed) == {"mostly-short", "repeats", None}
    want = Counter()
    for i, text, source in corpus:
        m = brute_measures(text)
        base = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want[(i, source, *m, base, failed.get(source), not base and source not in failed)] += 1
    for bound in (1_000_000, 0):
        found = host_rules.judge(frame(spark, corpus).repartition(3), host_rows=bound)
        columns = ["doc_id", "host", *host_rules.MEASURES, "base_failed", "host_failed", "kept"]
        assert found.columns == columns
        assert Counter(map(tuple, found.collect())) == want


def test_shrinkage_by_size(spark):
    """Of two hosts with the same rate, the one of fewer documents lies nearer the corpus."""
    bad, good = "word " * 9, " ".join(f"w{k}" for k in range(60))
    rows = [(k, bad if k // 20 < k % 10 else good, f"h{k % 20}") for k in range(400)]
    rows += [(1000 + k, bad, "small") for k in range(2)] + [(2000 + k, bad, "large") for k in range(200)]
    failures = host_rules.host_failures(host_rules.measure(frame(spark, rows), "source"))
    rate = {r["host"]: r["short_rate"] for r in host_rules.host_verdicts(failures).collect()}
    assert rate["h0"] < rate["small"] < rate["large"] <= 1
    assert rate["h0"] > 0


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "h"), (2, "c d", "h")]])
def test_few_rows(spark, rows):
    found = host_rules.judge(frame(spark, rows)).collect()
    assert [r["kept"] for r in found] == [False] * len(rows)
