"""URL filters, extraction, nearest neighbours and pseudonyms against brute force and examples."""

import random
import re
from itertools import product

import numpy as np
import pytest

from greenwave.llm import extraction, hamming, pseudonyms, redirects
from greenwave.llm.queries import URL_RULES


def test_url_filter(spark):
    rows = [
        (1, "http://WWW.A.example.net/en/1?x=1", "", "www.a.example.net", "/en/1", "example.net/en/", "allow"),
        (2, "https://q.net/x#f", None, "q.net", "/x", "net/", "block"),
        (3, "x://example.com/de/9", '<link rel="canonical" href="http://other.com/z">', "example.com", "/de/9", "example.com/de/", "block"),
        (4, "http://other.com/z", None, "other.com", "/z", None, "block"),
        (5, None, None, "", "", None, "allow"),
        (6, "no scheme", None, "", "", None, "allow"),
        (7, "http://a.net", None, "a.net", "", None, "allow"),
        (8, "http://example.com/de/x", "<LINK HREF=/alt rel=canonical>", "example.com", "/de/x", "example.com/de/", "block"),
        (9, "http://example.com/alt", "", "example.com", "/alt", None, "block"),
        # An allowed page takes no block from the blocked one that it leads to, and passes none on.
        (10, "http://b.org/fr/a", '<meta http-equiv="refresh" content="0; url=http://zz.net/q">', "b.org", "/fr/a", "org/fr/", "allow"),
        (11, "http://b.org/fr/c", '<link rel=canonical href="http://free.com/">', "b.org", "/fr/c", "org/fr/", "allow"),
        (12, "http://free.com/", "", "free.com", "/", None, "allow"),
        (13, "a://u.com\n?a://b/c", "", "u.com\n", "", None, "allow"),
        (14, "http://notexample.com/de/", "", "notexample.com", "/de/", None, "allow"),
        (15, "http://hop.com/1", "", "hop.com", "/1", None, "block"),
        (None, "http://hop.com/1", None, "hop.com", "/1", None, "block"),
        (15, "http://hop.com/1", "", "hop.com", "/1", None, "block"),
        (16, "", "", "", "", None, "allow"),
        (17, "http://" + "x." * 40 + "net/" + "y" * 5000, "", "x." * 40 + "net", "/" + "y" * 5000, "net/", "block"),
    ]
    pages = spark.createDataFrame([(*r[:3], "b") for r in rows], "page_id long, url string, html string, rule string")
    edges = spark.createDataFrame(
        [("http://hop.com/1", "http://hop.com/2"), ("http://hop.com/2", "http://q.net/x"), (None, "http://q.net/x")],
        "a string, b string",
    )
    got = redirects.judge(pages, redirects.rule_frame(spark, URL_RULES), edges).collect()
    want = sorted(((r[0], *r[3:]) for r in rows), key=str)
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got), key=str) == want
    none = redirects.judge(pages.where("false"), redirects.rule_frame(spark, URL_RULES))
    assert none.count() == 0


def brute_cut(gain, edges):
    best = None
    for labels in product((True, False), repeat=len(gain)):
        cost = sum(g for g, x in zip(gain, labels, strict=True) if g > 0 and not x)
        cost += sum(-g for g, x in zip(gain, labels, strict=True) if g < 0 and x)
        cost += sum(w for a, b, w in edges if labels[a] != labels[b])
        key = (round(cost, 6), -sum(labels))
        best = key if best is None or key < best else best
    return best


def test_minimum_cut():
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randrange(1, 9)
        gain = [rng.randrange(-40, 41) / 10 for _ in range(n)]
        edges = [(*rng.sample(range(n), 2), rng.randrange(1, 30) / 10) for _ in range(rng.randrange(2 * n))] if n > 1 else []
        labels = extraction.minimum_cut(gain, edges)
        cost = sum(g for g, x in zip(gain, labels, strict=True) if g > 0 and not x)
        cost += sum(-g for g, x in zip(gain, labels, strict=True) if g < 0 and x)
        cost += sum(w for a, b, w in edges if labels[a] != labels[b])
        assert (round(cost, 6), -sum(labels)) == brute_cut(gain, edges)
    long = extraction.minimum_cut([1.0, -0.2] * 3000, [(k, k + 1, 0.5) for k in range(5999)])
    assert all(long)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<div class="cookie-notice">We use cookies. Accept all of them please.</div><div id="content"><article><h1>Title</h1>
<script>var a = "</p><p>no</p>";</script><p>One &amp; two&nbsp;x.<div class="ad-box">Buy now!</div><p>Er.<p>A <a href=x>link</a>
here<br>there.</p><aside>Related</aside><ul><li>one<li>two</ul></article><section class="comments"><h2>Comments</h2>
<p>Great article, I loved it a lot and so on.</p></section></div><form><label>Mail</label><input></form><footer>&copy; x</footer>"""


def test_extraction(spark):
    want = ["Title", "One & two x.", "Er.", "A link here there.", "one", "two"]
    assert extraction.main_blocks(PAGE) == want
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<nav><a href=a>b</a>"), (5, "u", "<article><p>" + "long text. " * 50_000)]
    rows += [rows[0], (None, "u", "just words < and > signs & more of them here."), (6, "u", "<div" * 100)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = extraction.extract(pages).collect()
    assert [r["page_id"] for r in got] == [r[0] for r in rows]
    texts = [r["text"] for r in got]
    assert texts[0] == texts[5] == "\n\n".join(want) and texts[1:4] == ["", "", ""]
    assert texts[4] == " ".join(["long text."] * 50_000) and texts[6] == "just words < and > signs & more of them here."
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extraction.extract(pages.where("false")).count() == 0


def test_inline_boilerplate_is_cut_out():
    page = "<article><p>One.</p>{}<p>Two.</p></article>"
    for inline in (
        "<button>Share</button>", "<label>Mail</label>", "<select>Pick<option>a</select>", "<span class=ad>Buy</span>",
        "<a class='share' href=x>Post</a>", "<span hidden>Secret</span>", "<span style='display: none'>x</span>",
    ):
        assert extraction.main_blocks(page.format(inline)) == ["One.", "Two."]
        assert extraction.main_blocks(f"<article><p>One <b>bold</b> {inline} and two.</p></article>") == ["One bold", "and two."]
    assert extraction.main_blocks("<article><p>One <span class=ad>Buy <b>now<p>Two.</article>") == ["One", "Two."]


def test_pages_of_the_test_data(spark):
    """The article's blocks, cut out by patterns that hold for these pages only."""
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL).group(1)
        blocks = [re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(extraction.unescape(b).split()) for b in blocks]
        assert extraction.main_text(row["html"]) == "\n\n".join(b for b in blocks if b)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    for bits in (5, 16, 40, 64):
        codes = hamming.Codes(np.zeros(bits), np.eye(bits))
        rows = rng.normal(size=(400, bits))
        parts = codes.of(rows)
        index = [np.unique(p, return_inverse=True) for p in parts]
        distance = ((rows[:1] > 0) != (rows > 0)).sum(axis=1)
        for radius in (0, 1, bits // 3, bits):
            found = hamming.within([int(p[0]) for p in parts], index, parts, radius)
            assert found.tolist() == np.flatnonzero(distance <= radius).tolist()


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    points = np.round(rng.normal(size=(600, 12)), 1)
    rows = [(k, [float(x) for x in p], 0) for k, p in enumerate(points)]
    rows += [(700, rows[5][1], 0), (701, rows[5][1], 0), (5, rows[6][1], 0)]  # ties and a repeated id
    odd = [(800, None, 0), (801, [0.0] * 12, 0), (900, [float("nan")] * 12, 0), (802, [None] * 12, 0), (None, rows[1][1], 0)]
    odd += [(803, [float("inf")] + [1.0] * 11, 0), (1000, [1.0], 0), (804, [], 0)]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in hamming.nearest_neighbours(vectors, "vec_id % 100 = 0").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [0, 100, 200, 300, 400, 500, 700]
    ids, at = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hit = 0
    for q, found in got.items():
        far = np.sqrt(((at - at[np.flatnonzero(ids == q)[0]]) ** 2).sum(axis=1))
        order = [k for k in np.lexsort((ids, far)) if ids[k] != q][:10]
        hit += len({ids[k] for k in order} & {v for _, v, _ in found})
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert sorted(found) == sorted(found, key=lambda x: (x[2], x[1]))
        for _, v, s in found:
            assert any(s == pytest.approx(far[k], abs=1e-12) for k in np.flatnonzero(ids == v))
    assert hit >= 0.9 * 10 * len(got)
    few = hamming.nearest_neighbours(vectors.where("vec_id < 4"), "vec_id = 0").orderBy("rank").collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3]
    assert hamming.nearest_neighbours(vectors.where("false"), "true").count() == 0


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def test_pseudonyms(spark):
    texts = [
        "call +1 (988) 555-2485 or 4041894974608795, X@y.example.com; 17.252.227.210. born 1999-02-28 ssn 123-45-6789",
        None,
        "",
        "no 4041894974608796 version 2.0. 3.0 1.2.3.4.5 300.1.1.1 2023-02-30 000-12-3456 1850-01-01 x@y a1234",
        "31.12.1999 12/31/1999 +4915112345678 4041-8949-7460-8795 x@Y.example.com",
        "4041894974608795",
        "z " * 20_000 + "17.252.227.210",
    ]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts + texts[:1])], "doc_id long, text string, n_found int")
    out = pseudonyms.pseudonymise(docs, "k'ey|1")
    rows = [r for r in out.collect()]
    new = [r["text"] for r in rows]
    assert [r["n_found"] for r in rows] == [6, 0, 0, 0, 5, 1, 1, 6]
    assert new[1] is None and new[2] == "" and new[3] == texts[3] and new[0] == new[7]
    pattern = re.compile(r"call \+1 (\(\d{3}\) \d{3}-\d{4}) or (\d{16}), (p[0-9a-f]{16}@pseudonym.invalid); (\d+\.\d+\.\d+\.\d+)\. born (\d{4}-\d\d-\d\d) ssn (\d{3}-\d\d-\d{4})")
    phone, card, mail, address, day, social = pattern.fullmatch(new[0]).groups()
    assert luhn(card) and card != "4041894974608795" and new[5] == card
    assert max(map(int, address.split("."))) <= 255 and new[6].endswith(" " + address)
    assert new[4].split()[3].replace("-", "") == card and new[4].endswith(mail) and new[4].split()[2].startswith("+49")
    assert np.datetime64(day) and social[:3] not in ("000", "666") and social[4:6] != "00"
    back = pseudonyms.pseudonymise(out.select("doc_id", "text"), "k'ey|1", reverse=True).collect()
    assert [re.sub(r"\S+@\S+", "", r["text"] or "") for r in back] == [re.sub(r"\S+@\S+", "", t or "") for t in texts + texts[:1]]
    other = pseudonyms.pseudonymise(docs, "another").first()["text"]
    assert other != new[0]


def test_values_beside_other_numbers(spark):
    """A card beside short numbers, dates before a time, telephone numbers in pairs of digits."""
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    texts = {
        card: r"(\d{16})",
        f"{card} 123": r"(\d{16}) 123",
        f"{spaced} 12/25": r"(\d{4} \d{4} \d{4} \d{4}) 12/25",
        f"12 {spaced}": r"12 (\d{4} \d{4} \d{4} \d{4})",
        f"12 34 {spaced} 12/25 x": r"12 34 (\d{4} \d{4} \d{4} \d{4}) 12/25 x",
        f"7-{spaced.replace(' ', '-')}-123": r"7-(\d{4}-\d{4}-\d{4}-\d{4})-123",
        f"{spaced} {card} \ue000 {card}": r"(\d{4} \d{4} \d{4} \d{4}) \1 \ue000 \1",
        f"1 2 3 4 5 6 7 8 9 10 11 12 13 14 {spaced} 12th": None,
    }
    days = {
        "2020-01-01": r"(\d{4}-\d\d-\d\d)",
        "at 2020-01-01T12:00:00Z": r"at (\d{4}-\d\d-\d\d)T12:00:00Z",
        "12 2020-01-01 2020-01-01 5": r"12 (\d{4}-\d\d-\d\d) \1 5",
    }
    pairs = {
        "06 12 34 56 78": r"0(\d \d\d \d\d \d\d \d\d)",
        "75001 06 12 34 56 78": r"75001 0(\d \d\d \d\d \d\d \d\d)",
        "+33 6 12 34 56 78, +33612345678": r"\+33 (\d \d\d \d\d \d\d \d\d), \+33(\d{9})",
        "+33 (0)6 12 34 56 78": r"\+33 \(0\)(\d \d\d \d\d \d\d \d\d)",
        "0033 6 12 34 56 78": r"0033 (\d \d\d \d\d \d\d \d\d)",
        "06.12.34.56.78 06-12-34-56-78": r"0(\d.\d\d.\d\d.\d\d.\d\d) 0(\d-\d\d-\d\d-\d\d-\d\d)",
    }
    cases = [(t, p, kind) for kind, group in enumerate((texts, days, pairs)) for t, p in group.items()]
    docs = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    out = pseudonyms.pseudonymise(docs, "key")
    new = {r["doc_id"]: r for r in out.collect()}
    seen = [set(), set(), set()]
    for k, (t, p, kind) in enumerate(cases):
        if p is None:
            assert spaced not in new[k]["text"]
            continue
        found = re.fullmatch(p, new[k]["text"])
        if "\\1" in p and kind == 0:
            found = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}) (\d{16}) \ue000 (\d{16})", new[k]["text"])
        assert found, (t, new[k]["text"])
        seen[kind] |= {re.sub(r"\D", "", x) for x in found.groups()}
    assert [len(s) for s in seen] == [1, 1, 1] and luhn(*seen[0])
    assert not seen[0] & {card} and not seen[1] & {"20200101"} and not seen[2] & {"612345678"}
    assert new[6]["n_found"] == 3 and new[10]["n_found"] == 2 and new[13]["n_found"] == 2
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(out.select("doc_id", "text"), "key", reverse=True).collect()}
    assert all(back[k] == t for k, (t, p, _) in enumerate(cases) if p)


def test_permutation_is_one_to_one(spark):
    frame = spark.range(319 * 229).selectExpr("id", f"{pseudonyms.permuted('id div 229', 'id % 229', '319', '229', 'date', 'k')} AS p")
    row = frame.selectExpr("p.l * 229 + p.r AS v").selectExpr("count(DISTINCT v) AS n", "min(v) AS low", "max(v) AS high").first()
    assert tuple(row) == (319 * 229, 0, 319 * 229 - 1)


@pytest.mark.parametrize("html, target", [
    ('<link rel="canonical" href="../de/z">', "http://h.com/de/z"),
    ("<link rel=canonical href=y>", "http://h.com/a/y"),
    ("<link rel=canonical href='?id=3&amp;x=1#f'>", "http://h.com/a/b?id=3&x=1"),
    ('<link rel="alternate Canonical" href="//o.org/./p/../q/.">', "http://o.org/q/"),
    ('<!-- <link rel=canonical href="/no"> --><link href="/yes" rel=canonical>', "http://h.com/yes"),
    ('<script>"<link rel=canonical href=/no>"</script>', None),
    ('<link title="a > b" rel="canonical" href="/t">', "http://h.com/t"),
    ('<link rel="canonicals" href="/no"><link rel=canonical>', None),
    ('<meta http-equiv="refresh" content="0;URL=\'/r&#47;s\'">', "http://h.com/r/s"),
    ('<meta http-equiv="refresh" content="30; url=/later">', None),
    ('<meta http-equiv=refresh content="0; url=/r"><link rel=canonical href=/c>', "http://h.com/c"),
    ('<base href="https://b.net/x/y"><link rel=canonical href="z">', "https://b.net/x/z"),
    ('<link rel=canonical href="mailto:a@b.c">', None),
    ("<link rel=canonical href=/p/%2e%2e", "http://h.com/p/%2e%2e"),
    ("<!-- open <link rel=canonical href=/no>", None),
    ("", None),
    (None, None),
])
def test_canonical_targets(html, target):
    assert redirects.canonical_target(html, "http://h.com/a/b?q=1") == target


def test_addresses_resolve_as_the_standard_says():
    """The examples of RFC 3986, section 5.4, without fragments."""
    base = "http://a/b/c/d;p?q"
    examples = {
        "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g",
        "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", ";x": "http://a/b/c/;x", "": "http://a/b/c/d;p?q",
        ".": "http://a/b/c/", "..": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../g": "http://a/g",
        "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g",
        "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g;x=1/../y": "http://a/b/c/y",
    }
    assert {x: redirects.resolved(base, x) for x in examples} == examples


def test_open_tags_and_quotes_take_time_in_proportion():
    import time

    def seconds(text):
        start = time.process_time()
        redirects.canonical_target(text, "http://h.com/")
        return time.process_time() - start

    for part in ('<link "', "<link a='", "<!--", "<link rel=canonical ", "<script>"):
        assert seconds(part * 40_000) < 2


def test_aliases_by_relative_links(spark):
    rows = [
        (1, "http://x.com/a/1", '<link rel=canonical href="../de/z">', "http://x.com/de/z"),
        (2, "http://y.com/a/1", "<link rel=canonical href=y>", "http://y.com/a/y"),
        (3, "http://y.com/a/y", '<meta http-equiv="refresh" content="0; url=http://q.net/">', ""),
    ]
    rules = redirects.rule_frame(spark, [("block", "net", "/"), ("block", "x.com", "/de/")])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, target string")
    got = {r["page_id"]: r["verdict"] for r in redirects.judge(pages, rules).collect()}
    assert got == {1: "block", 2: "block", 3: "block"}


@pytest.mark.parametrize("text", [
    "10.000.000 Euro", "100 000 000 euros", "at 48.8566140 north", "1990 2000 2010", "ISBN 978-3-16-148410-0",
    "ISBN-10: 3-16-148410-0",
])
def test_numbers_that_are_no_telephone_numbers(spark, text):
    found = pseudonyms.pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), "k").first()
    assert (found["text"], found["n_found"]) == (text, 0)


def test_telephone_numbers_are_still_found(spark):
    texts = ["555-123-4567", "(555) 123-4567", "+49 30 123456", "06 12 34 56 78", "+33 6 12 34 56 78", "+1 212 555 0199"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in pseudonyms.pseudonymise(rows, "k").collect()}
    assert all(found[k]["n_found"] == 1 and found[k]["text"] != t for k, t in enumerate(texts))
