"""Benchmark decontamination by winnowed k-gram fingerprints, in native expressions only.

Of every run of ``w`` consecutive k-gram hashes of a text the least is kept, on both
sides. A span of ``window = k + w - 1`` words that a document and an item share holds one
whole run, so the same k-gram is kept in both, at the same place of the span. The join on
kept hashes therefore finds the alignment (document position less item position) of every
shared window; along each alignment words are compared one by one, which gives the exact
occurrences. An item shorter than the window is a window of its own, of its own length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from greenwave.llm.common import broadcast_below, lower_ascii, stored

#: One word of a text with A-Z in lower case, and the same with A-Z allowed.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of a fingerprint that hold the position; the rest hold the hash.
PLACE_BITS = 31
PLACE_MASK = (1 << PLACE_BITS) - 1


def words(text: str):
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _kept(window: int, grams: int) -> tuple[str, str]:
    """Expressions: ``grams``-word hashes of ``codes`` with places, and the kept ones of ``hashed``."""
    k = min(grams, window)
    run = window - k + 1
    mixed = ", ".join(f"codes[i + {at}]" for at in range(1, k))
    hashed = f"""IF(size(codes) >= {window},
        transform(slice(codes, 1, size(codes) - {k - 1}), (c, i) ->
            (xxhash64(c{', ' + mixed if mixed else ''}) & {~PLACE_MASK}) | i),
        array())"""
    others = ", ".join(f"hashed[i + {at}]" for at in range(1, run))
    kept = f"""IF(size(hashed) > 0,
        array_distinct(transform(slice(hashed, 1, size(hashed) - {run - 1}), (h, i) ->
            {f'least(h, {others})' if others else 'h'})),
        array())"""
    return hashed, kept


def _fingerprints(texts: DataFrame, window: int, grams: int, *names: str) -> DataFrame:
    """``names``, ``code`` and ``place`` of the kept k-grams of ``codes``."""
    hashed, kept = _kept(window, grams)
    rows = texts.withColumn("hashed", F.expr(hashed)).withColumn("kept", F.expr(kept))
    # Not explode(): the filter it infers would be pushed down, with the arrays' expressions.
    return rows.select(*names, F.explode_outer("kept").alias("print")).selectExpr(
        *names,
        f"CAST({window} AS INT) AS window",
        f"shiftright(print, {PLACE_BITS}) AS code",
        f"CAST(print & {PLACE_MASK} AS INT) AS place",
    )


def _coded(texts: DataFrame) -> DataFrame:
    return texts.withColumn("codes", F.expr("transform(words, w -> xxhash64(w))"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    grams: int = 5,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``items``, ``contaminated``.

    ``n_hit`` counts document words inside any occurrence of a window of an item;
    ``items`` is the array of item ids (as text, sorted) with occurring windows. Null texts
    have no words. Items without words or id are ignored; items of equal id count once.
    Rows of equal ``doc_id`` and text get equal results; rows of equal id and different
    texts get their own. Other columns are ignored.

    Tables derived from the benchmark are broadcast up to ``broadcast_rows`` rows (counted)
    and joined by shuffle beyond; AQE then splits a hot fingerprint.
    """
    return _judged(docs, benchmark, window, grams, broadcast_rows).drop("mark")


def _judged(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, grams: int = 5, broadcast_rows: int = 1_000_000
) -> DataFrame:
    """``find_contamination`` with ``mark``, the hash of the text."""
    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    items = (
        benchmark.select(F.col("item_id").cast("string"), words("text").alias("item_words"))
        .where("item_id IS NOT NULL AND size(item_words) > 0")
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "item_words"))
        .withColumn("window", F.expr(f"least(size(item_words), {window})"))
    )
    items = stored(items, "items")
    lengths = sorted(r[0] for r in items.select("window").distinct().collect())
    prints = [
        _fingerprints(
            _coded(
                items.where(F.col("window") == n).selectExpr(
                    "item", "item_words AS words", "size(item_words) AS m"
                )
            ),
            n,
            grams,
            "item",
            "m",
        )
        for n in lengths
    ]
    found = _occurrences(texts, items, prints, lengths, grams, broadcast_rows)
    everything = docs.select(
        "doc_id",
        F.xxhash64("text").alias("mark"),
        F.coalesce(F.regexp_count("text", F.lit(WORD_ANY_CASE)), F.lit(0)).alias("n_words"),
    )
    on = everything["doc_id"].eqNullSafe(found["hit_id"]) & (everything["mark"] == found["hit_mark"])
    return everything.join(found, on, "left").select(
        "doc_id",
        "mark",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("CAST(array() AS ARRAY<STRING>)")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def _occurrences(texts, items, prints, lengths, grams, broadcast_rows) -> DataFrame:
    """``hit_id``, ``hit_mark``, ``n_hit``, ``items`` of documents with at least one hit."""
    marked = texts.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    coded = _coded(marked.select("doc_id", "mark", words("text").alias("words")))
    sides = []
    for n, known in zip(lengths, prints, strict=True):
        wanted = broadcast_below(stored(known, "prints"), broadcast_rows)
        mine = _fingerprints(coded, n, grams, "doc_id", "mark")
        sides.append(
            mine.join(wanted.withColumnRenamed("place", "item_place"), ["window", "code"]).selectExpr(
                "doc_id", "mark", "item", "m", "window", "place - item_place AS shift"
            )
        )
    if not sides:
        return marked.where("false").selectExpr(
            "doc_id AS hit_id", "mark AS hit_mark", "0 AS n_hit", "split('', ',') AS items"
        )
    aligned = sides[0]
    for more in sides[1:]:
        aligned = aligned.unionByName(more)
    # Alignments of one document number at most its words times the items that share them.
    aligned = aligned.distinct().groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("item", "m", "window", "shift")).alias("aligned")
    )
    aligned = stored(aligned, "aligned").select(
        F.col("doc_id").alias("hit_id"), F.col("mark").alias("hit_mark"), "aligned"
    )
    small = aligned.select("hit_id", "hit_mark", F.size("aligned").alias("n"))
    total = small.agg(F.sum("n")).first()[0] or 0
    hits = F.broadcast(aligned) if total <= broadcast_rows else aligned
    on = marked["doc_id"].eqNullSafe(hits["hit_id"]) & (marked["mark"] == hits["hit_mark"])
    # Only the words beside the item go on, not the whole text for each alignment.
    spans = (
        marked.join(hits, on)
        .select("hit_id", "hit_mark", "aligned", words("text").alias("words"))
        .selectExpr(
            "hit_id",
            "hit_mark",
            """explode_outer(transform(aligned, a -> named_struct(
                 'item', a.item, 'window', a.window, 'shift', a.shift,
                 'beside', slice(words, greatest(a.shift, 0) + 1, least(
                     a.m + least(a.shift, 0), size(words) - greatest(a.shift, 0)))))) AS at""",
        )
    )
    wording = broadcast_below(items.select("item", "item_id", "item_words"), broadcast_rows // 50)
    compared = (
        spans.selectExpr("hit_id", "hit_mark", "at.item", "at.window", "at.shift", "at.beside")
        .join(wording, "item")
        .selectExpr(
            "hit_id",
            "hit_mark",
            "item_id",
            "window",
            "shift",
            """transform(item_words, (w, q) ->
                 coalesce(w = get(beside, q + least(shift, 0)), false)) AS same""",
        )
        .selectExpr(
            "hit_id",
            "hit_mark",
            "item_id",
            "window",
            """transform(filter(sequence(0, size(same) - window),
                 s -> forall(slice(same, s + 1, window), x -> x)), s -> s + shift) AS starts""",
        )
        .where("size(starts) > 0")
    )
    compared = stored(compared, "spans")
    names = compared.groupBy("hit_id", "hit_mark").agg(
        F.array_sort(F.collect_set("item_id")).alias("items")
    )
    places = (
        compared.select("hit_id", "hit_mark", "window", F.explode_outer("starts").alias("start"))
        .distinct()
        .groupBy("hit_id", "hit_mark")
        .agg(F.collect_list(F.expr("sequence(start, start + window - 1)")).alias("runs"))
        .selectExpr(
            "hit_id AS id", "hit_mark AS m", "size(array_distinct(flatten(runs))) AS n_hit"
        )
    )
    on = names["hit_id"].eqNullSafe(places["id"]) & (names["hit_mark"] == places["m"])
    return names.join(places, on).select("hit_id", "hit_mark", "n_hit", "items")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs``, with all their columns, that hold no window of a benchmark item.

    Each row is judged by its own text, whatever other rows have its ``doc_id``.
    """
    found = _judged(docs, benchmark, **options).where("contaminated")
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark")).distinct()
    on = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_mark"])
    return docs.join(bad, on, "left_anti")
