"""URL filters with redirect equivalence.

Rules name a host and a path prefix. Redirects and canonical links make addresses
equivalent: connected components of their edges share block decisions, so that an alias of
a blocked address is blocked. A rule that fits the address itself always comes first, and
an address that an allow rule fits neither takes nor passes on a block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from greenwave.llm.common import UPPER, broadcast_below, stored
from greenwave.llm.components import connected_components


def host_of(url: str) -> str:
    """SQL: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = f"regexp_extract({url}, '^(?s)(?:(?!://).)*://([^/?#]*)', 1)"
    return f"coalesce(translate({found}, '{UPPER}', '{UPPER.lower()}'), '')"


def path_of(url: str) -> str:
    """SQL: what follows the host up to ``?``, ``#`` or the end; else empty."""
    return f"coalesce(regexp_extract({url}, '^(?s)(?:(?!://).)*://[^/?#]*([^?#]*)', 1), '')"


#: Markup whose content holds no links of the page.
SILENT = re.compile(r"(?i)<!--|<(script|style|textarea|title|xmp)(?=[\s/>])")
TAG = re.compile(r"(?i)<(link|meta|base)(?=[\s/>])")
NAME = re.compile(r"[\s/]*([^\s=>/][^\s=>/]*)?\s*(=\s*)?")
PLAIN = re.compile(r"[^\s>]*")
#: Scheme, authority, path, query of an address (RFC 3986, appendix B).
PARTS = re.compile(r"(?s)(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?")


def _audible(html: str) -> str:
    """``html`` without comments, scripts and other text that only looks like tags; what is open ends it."""
    out, at = [], 0
    while found := SILENT.search(html, at):
        out.append(html[at : found.start()])
        if found[1]:
            end = re.compile(rf"(?i)</{found[1]}(?=[\s/>])").search(html, found.end())
            at = end.end() if end else len(html)
        else:
            end = html.find("-->", found.end())
            at = end + 3 if end >= 0 else len(html)
    return "".join([*out, html[at:]])


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of the tag whose name ends at ``at`` (of equal ones the first), and where it ends."""
    found: dict[str, str] = {}
    while at < len(html) and html[at] != ">":
        name = NAME.match(html, at)
        start, at, value = at, name.end(), ""
        if name[2]:
            if html[at : at + 1] in ('"', "'") and (end := html.find(html[at], at + 1)) >= 0:
                value, at = html[at + 1 : end], end + 1
            else:
                plain = PLAIN.match(html, at)
                value, at = plain[0], plain.end()
        if name[1]:
            found.setdefault(name[1].lower(), unescape(value).strip())
        at = max(at, start + 1)
    return found, at


def resolved(base: str, target: str) -> str:
    """The absolute address that ``target`` names on a page at ``base`` (RFC 3986, section 5.2)."""
    scheme, host, path, query = PARTS.match(target).groups()
    b_scheme, b_host, b_path, b_query = PARTS.match(base).groups()
    if scheme is None:
        scheme = b_scheme
        if host is None:
            host = b_host
            if not path:
                path, query = b_path, b_query if query is None else query
            elif not path.startswith("/"):
                path = (b_path.rpartition("/")[0] or "") + "/" + path
    if host is None:
        return f"{scheme}:{path}"
    kept: list[str] = []
    parts = path.split("/")
    for part in parts:
        if part == "..":
            kept = kept[:-1] if len(kept) > 1 else kept
        elif part != ".":
            kept.append(part)
    if parts[-1] in (".", ".."):
        kept.append("")
    return f"{scheme}://{host}{'/'.join(kept)}" + ("" if query is None else f"?{query}")


def canonical_target(html: str | None, url: str | None) -> str | None:
    """The absolute address of the first canonical link, else of the first immediate refresh, or null.

    ``rel`` is a list of words. Character references are decoded, and relative addresses are
    resolved against the page's own or its ``<base>``. Comments and scripts hold no links.
    """
    if not html or not url or "://" not in url or not TAG.search(html):
        return None
    html = _audible(html)
    base = refresh = canonical = None
    at = 0
    while canonical is None and (tag := TAG.search(html, at)):
        found, at = _attributes(html, tag.end())
        kind = tag[1].lower()
        if kind == "base":
            base = base or found.get("href")
        elif kind == "link" and "canonical" in found.get("rel", "").lower().split():
            canonical = found.get("href") or None
        elif kind == "meta" and refresh is None and found.get("http-equiv", "").lower() == "refresh":
            wait = re.match(r"(?is)0*(?:\.0*)?\s*[;,]\s*url\s*=\s*[\"']?([^\"']+)", found.get("content", ""))
            refresh = wait and wait[1].strip()
    target = canonical or refresh
    if not target:
        return None
    target = resolved(resolved(url, base) if base else url, target)
    return target if "://" in target else None


def page_targets(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``target`` of every row of ``pages`` (``canonical_target``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("html").to_pylist(), batch.column("url").to_pylist())
            targets = [canonical_target(html, url) for html, url in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(targets, pa.string())],
                ["page_id", "url", "target"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, target string")


def rule_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(verdict, host, path)`` rows as a frame with their text ``rule``."""
    return spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string").withColumn(
        "rule", F.concat("rule_host", "rule_path")
    )


def fit_rules(urls: DataFrame, rules: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``urls`` (``url_key``, ``host``, ``path``) with the ``rule`` and ``fixed`` verdict that fit best, or null.

    A rule fits its host and subdomains where the path starts with the rule's. The longest
    rule (host and path together) wins, then the longest host, then allow. Hosts are looked up by each of their
    suffixes, as many as they have labels, so rules join by equality. Rules are broadcast
    up to ``broadcast_rows``.
    """
    labels = "split(host, '[.]')"
    tails = f"""transform(sequence(1, size({labels})), i ->
        array_join(slice({labels}, i, size({labels}) - i + 1), '.'))"""
    spread = urls.select("url_key", "path", F.explode_outer(F.expr(tails)).alias("rule_host"))
    hits = spread.join(broadcast_below(rules, broadcast_rows), "rule_host").where(
        "startswith(path, rule_path)"
    )
    best = hits.groupBy("url_key").agg(
        F.max(
            F.struct(
                F.expr("char_length(rule)").alias("size"),
                F.expr("char_length(rule_host)").alias("host_size"),
                (F.col("verdict") == "allow").alias("allows"),
                "rule",
                "verdict",
            )
        ).alias("best")
    )
    return urls.join(best, "url_key", "left").select(
        *urls.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("fixed")
    )


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url``, ``host``, ``path``, ``rule``, ``verdict``, ``alias_of``.

    ``edges`` (``a``, ``b``: addresses) are redirects; canonical links and immediate
    refreshes of ``html``, where ``pages`` has it, are added. Addresses are equal if scheme
    and ``www.`` aside their host, path and query are (fragments do not count). ``rule`` is
    the rule that fits the address, else null; then the verdict is ``block`` if the rule of
    an equivalent address blocks (``alias_of`` names the least such rule), else ``allow``.
    Null addresses are allowed. Pages that repeat are rows of their own, other columns are ignored,
    and an empty table gives no rows.

    Rules are fitted to distinct addresses, so one address on very many rows is one lookup.
    """
    if "html" in pages.columns:
        rows = page_targets(pages)
    else:
        rows = pages.select("page_id", "url", F.lit(None).cast("string").alias("target"))
    key = lambda u: (
        f"concat(regexp_replace({host_of(u)}, '^www[.]', ''), "
        f"coalesce(regexp_extract({u}, '^(?s)(?:(?!://).)*://[^/?#]*([^#]*)', 1), {u}))"
    )
    rows = stored(rows.selectExpr("page_id", "url", "target", f"{key('url')} AS node", f"{key('target')} AS other"), "pages")
    links = rows.where("other IS NOT NULL AND other <> node").selectExpr("node AS a", "other AS b")
    ends = rows.where("target IS NOT NULL").select(F.col("target").alias("url"), F.col("other").alias("node"))
    if edges is not None:
        named = edges.where("a IS NOT NULL AND b IS NOT NULL").selectExpr(
            "a AS from_url", "b AS to_url", f"{key('a')} AS a", f"{key('b')} AS b"
        )
        links = links.unionByName(named.select("a", "b"))
        ends = ends.unionByName(named.selectExpr("from_url AS url", "a AS node")).unionByName(
            named.selectExpr("to_url AS url", "b AS node")
        )
    known = rows.where("url IS NOT NULL").select("url", "node").unionByName(ends).distinct()
    urls = known.selectExpr("url AS url_key", "node", f"{host_of('url')} AS host", f"{path_of('url')} AS path")
    fitted = stored(fit_rules(urls, rules), "fitted")
    # Allowed addresses neither take nor pass on blocks, so their edges are dropped.
    allowed = fitted.where("fixed = 'allow'").select("node").distinct()
    links = links.join(allowed.withColumnRenamed("node", "a"), "a", "left_anti")
    links = links.join(allowed.withColumnRenamed("node", "b"), "b", "left_anti")
    # Addresses that differ only in scheme or ``www.`` have one node, hence are joined anyway.
    groups = connected_components(links)
    blocked = fitted.where("fixed = 'block'").join(groups, "node", "left").select(
        F.coalesce("component", "node").alias("component"), "rule"
    )
    blocked = blocked.groupBy("component").agg(F.min("rule").alias("alias_of"))
    decided = (
        fitted.join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .join(blocked, "component", "left")
        .selectExpr(
            "url_key",
            "host",
            "path",
            "rule",
            "coalesce(fixed, IF(alias_of IS NULL, 'allow', 'block')) AS verdict",
            "IF(rule IS NULL, alias_of, NULL) AS alias_of",
        )
    )
    return rows.join(decided, rows["url"] == decided["url_key"], "left").select(
        "page_id",
        "url",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
        "alias_of",
    )
