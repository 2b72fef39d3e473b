"""Host-level quality rules: rates of rule failures by host, shrunk by a beta prior, joined back.

Each document is measured and held against rules. Failures are summed by host. A host of few
documents says little about itself, so its rate of each rule is drawn towards the corpus by a
beta prior whose mean and strength are estimated from all hosts. A host whose shrunk rate
exceeds the limit loses all its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from greenwave.llm.common import broadcast_below, stored

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\r\x0b\x0c"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: What a document of each name fails, as SQL over the measures.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "same_lines": "100 * n_dup_lines > 30 * n_lines",
    "odd_words": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)",
}
#: Rules that a document fails by itself, whatever its host.
BASE = ("short", "repeats")


def measures(text: str | None) -> tuple[int, ...]:
    """``MEASURES`` of a whole text; all zero for null and for texts without words."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    spaces = len(raw) - sum(map(len, words))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    repeated = 0
    times = Counter(zip(words, words[1:], words[2:]))
    if len(times) < n - 2:
        covered = bytearray(n)
        for at, window in enumerate(zip(words, words[1:], words[2:])):
            if times[window] > 1:
                covered[at : at + 3] = b"\1\1\1"
        repeated = sum(covered)
    return (
        n,
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
    )


def measure(docs: DataFrame, host: str | Column) -> DataFrame:
    """``doc_id``, ``host`` and ``MEASURES`` of every row, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(text) for text in batch.column("text").to_pylist()]
            found = zip(*rows) if rows else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *(pa.array(v, pa.int64()) for v in found)],
                ["doc_id", "host", *MEASURES],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    host = F.col(host) if isinstance(host, str) else host
    return docs.select("doc_id", host.cast("string").alias("host"), "text").mapInArrow(
        run, f"doc_id {kind}, host string, " + ", ".join(f"{m} long" for m in MEASURES)
    )


def host_failures(measured: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """``host``, ``n_docs`` and, by rule name, how many of the host's documents fail it.

    Sums have a map-side part, so a host with a third of all documents leaves each input
    partition as one row. Documents without a host form one host, null.
    """
    counts = [F.sum(F.expr(f"CAST({sql} AS BIGINT)")).alias(name) for name, sql in rules.items()]
    return measured.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *counts)


def beta_priors(failures: DataFrame, rules: Mapping[str, str] = RULES) -> dict[str, tuple[float, float]]:
    """Mean and strength (alpha + beta) of each rule's beta prior, by the method of moments.

    With p the corpus rate and n, k a host's documents and failures, sum n (k/n - p)^2 is
    expected to be p (1 - p) ((hosts - 1) + r (N - sum n^2 / N - (hosts - 1))), where r is the
    correlation of two documents of a host; the strength is 1/r - 1, and r stays within
    [1e-6, 1]. The driver receives one row of sums.
    """
    sums = [F.sum(name).alias(name) for name in rules]
    spread = [F.sum(F.col(name) * F.col(name) / F.col("n_docs")).alias(f"{name}^2") for name in rules]
    got = failures.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("squares"),
        *sums,
        *spread,
    ).first()
    priors = {}
    for name in rules if got["docs"] else ():
        docs, others = got["docs"], got["hosts"] - 1
        p = got[name] / docs
        room = p * (1 - p) * (docs - got["squares"] / docs - others)
        seen = got[f"{name}^2"] - got[name] * p - p * (1 - p) * others
        r = min(1.0, max(1e-6, seen / room)) if room > 0 else 1e-6
        priors[name] = (p, 1 / r - 1)
    return priors


def host_verdicts(failures: DataFrame, rules: Mapping[str, str] = RULES, limit: float = 0.5) -> DataFrame:
    """``host``, ``n_docs``, ``<rule>_rate`` (shrunk) of each rule, ``failed_rule`` (first over ``limit``)."""
    priors = beta_priors(failures, rules)
    rates = {
        name: (F.col(name) + p * strength) / (F.col("n_docs") + strength)
        for name, (p, strength) in priors.items()
    }
    over = [F.when(rate > limit, F.lit(name)) for name, rate in rates.items()]
    return failures.select(
        "host",
        "n_docs",
        *[(rates[name] if name in rates else F.lit(None).cast("double")).alias(f"{name}_rate") for name in rules],
        F.coalesce(*over, F.lit(None).cast("string")).alias("failed_rule"),
    )


def judge(
    docs: DataFrame,
    host: str | Column = "source",
    rules: Mapping[str, str] = RULES,
    base: tuple[str, ...] = BASE,
    limit: float = 0.5,
    host_rows: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``host``, ``MEASURES``, ``base_failed``, ``host_failed``, ``kept``.

    ``base_failed``: the document itself fails one of the ``base`` rules. ``host_failed``
    names the first rule whose shrunk rate at the document's host exceeds ``limit``, else
    null. ``kept`` if neither. Null and empty texts have no words and fail ``short``; null
    hosts are one host; repeated rows count and return as often as they come; other columns
    of ``docs`` are ignored; an empty table gives an empty result.

    Only failing hosts are joined back: broadcast up to ``host_rows`` of them, by shuffle
    beyond that, where every host has one row and Spark can split its documents.
    """
    measured = stored(measure(docs, host), "measures")
    verdicts = host_verdicts(host_failures(measured, rules), rules, limit)
    failing = stored(
        verdicts.where("failed_rule IS NOT NULL").select(
            F.col("host").alias("failing"), F.col("failed_rule").alias("host_failed")
        ),
        "hosts",
    )
    own = " OR ".join(f"({rules[name]})" for name in base) or "false"
    return (
        measured.join(broadcast_below(failing, host_rows), F.col("host").eqNullSafe(F.col("failing")), "left")
        .withColumn("base_failed", F.expr(own))
        .withColumn("kept", F.expr("NOT base_failed AND host_failed IS NULL"))
        .select("doc_id", "host", *MEASURES, "base_failed", "host_failed", "kept")
    )
