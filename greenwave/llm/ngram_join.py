"""Near duplicates: an exact n-gram Jaccard join filtered under several global token orders.

Texts are sets of word shingles. Two sets of similarity ``percent`` or more must share
tokens in their prefixes under *every* global order of the tokens, so the filters of
several orders are intersected before anything is verified:

1. ascending token hash. The prefix is lengthened by ``l`` tokens, of which ``l`` must be
   shared. This needs no statistics, and only a third of the tokens are shuffled. Sets with
   too few shared prefix tokens leave here.
2. rarest token first, over the sets that remain. Tokens of one set only take up the slack
   of the prefix, so nearly all sets without a near copy leave here.
3. ascending and descending hash over the tokens of 2, tested on pairs.

Large groups of near copies would give a pair for each two members. Classes and components
need no such pairs: in each bucket (sets that share a prefix token) one *pivot* is verified
against all others. A pair of different components that the pivot leaves open must share
a token outside the pivot, or be so short that the overlaps with the pivot may suffice;
these are looked up in the next round, by (pivot, outside token). See ``_next_members``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenwave.llm.common import broadcast_below, discard, stored
from greenwave.llm.components import connected_components

#: Constants of the polynomial that mixes word hashes into a shingle hash (odd 64-bit values).
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
SIGN = np.uint64(1 << 63)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``width``-grams of ``text``.

    Words are runs without ASCII white space, with A-Z in lower case. A text of fewer words
    is one shingle; without words the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    codes = np.fromiter(map(digest, words), np.uint64, len(words))
    span = min(width, len(codes))
    mixed = np.full(len(codes) - span + 1, np.uint64(span), np.uint64)
    for at in range(span):
        mixed = mixed * MIX_A ^ codes[at : at + len(mixed)] * MIX_B
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array((flat ^ SIGN).view(np.int64)))


def prefix_extra(n, share: int):
    """``l``: how many shared tokens the first order asks for in a prefix longer by ``l``."""
    return (n + share - 1) // share


def _sets(docs: DataFrame, width: int, keep: Callable[[int], int]) -> DataFrame:
    """``doc_id``, ``mark`` (hash of the text), ``n``, ``key`` (hash of the whole set) and the first ``keep(n)`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
            keys = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in found], np.uint64)
            columns = [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array(np.array([len(s) for s in found], np.int64)),
                pa.array(keys.view(np.int64)),
                _lists([s[: keep(len(s))] for s in found]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "n", "key", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, mark long, n long, key long, tokens array<long>"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, schema)


def _need(n: str, percent: int) -> str:
    """Least overlap a set of ``n`` tokens has with any partner: ceil(percent * n / 100)."""
    return f"((({percent} * {n}) + 99) div 100)"


def _overlap_need(n: str, m: str, percent: int) -> str:
    """Least overlap of a linked pair: 100 o >= percent (n + m - o), rounded up."""
    return f"(({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent})"


def prefix_length(n: int, percent: int, share: int) -> int:
    """Tokens of a set of ``n`` that the first order looks at."""
    return n - (percent * n + 99) // 100 + prefix_extra(n, share) if n else 0


def _survivors(prefixes: DataFrame, classes: DataFrame, percent: int, share: int) -> DataFrame:
    """Classes that may have a partner by the first order (token hash); ``tokens`` are the prefixes."""
    postings = prefixes.select("key", F.explode("tokens").alias("token"))
    # Copies of one set count once: a token is shared if two different sets hold it.
    shared = (
        postings.groupBy("token")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .where("low <> high")
        .select("token")
    )
    hits = postings.join(shared, "token").groupBy("key").agg(F.count(F.lit(1)).alias("hits"))
    least = f"((({_need('n', percent)}) + {share - 1}) div {share})"
    # Each copy of a class counted its tokens, hence the factor.
    return stored(
        hits.join(classes, "key").where(f"hits >= copies * {least}").select("key", "first.id", "first.mark"),
        "survivors",
    )


def _rare_first(docs: DataFrame, survivors: DataFrame, width: int, percent: int, bound: int) -> DataFrame:
    """``key``, ``n``, shared tokens by rarity, prefixes by further orders, how common they are."""
    ids = broadcast_below(survivors.select("id", "mark"), bound)
    on = docs["doc_id"].eqNullSafe(ids["id"]) & (F.xxhash64(docs["text"]) == ids["mark"])
    texts = docs.select("doc_id", "text").join(ids, on, "left_semi")
    sets = _sets(texts, width, lambda n: n).join(survivors.select("key"), "key", "left_semi")
    postings = sets.select("key", "n", F.explode("tokens").alias("token")).distinct()
    postings = stored(postings, "postings")
    counted = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rows = postings.join(counted, "token").groupBy("key").agg(
        F.first("n").alias("n"),
        F.collect_list(F.struct("df", "token")).alias("found"),
    )
    need = _need("n", percent)
    rows = rows.where(f"size(found) >= {need}").withColumn("found", F.array_sort("found"))
    sets = stored(
        rows.selectExpr(
            "key",
            "n",
            "found.token AS tokens",
            "array_sort(found.token) AS sorted",
            f"CAST(size(found) - {need} + 1 AS INT) AS slack",
            "aggregate(found.df, 0D, (a, d) -> a + ln(d)) / n AS common",
        ).selectExpr(
            "key",
            "n",
            "tokens",
            "slice(tokens, 1, slack) AS prefix",
            "slice(sorted, 1, slack) AS low",
            "slice(sorted, -slack, slack) AS high",
            "common",
        ),
        "sets",
    )
    discard(postings)
    return sets


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, candidates: bool = False) -> DataFrame:
    """Pairs (``key``, ``pivot``) with ``linked``, ``o`` (overlap) and tokens outside the pivot.

    Pairs without a common prefix token under both further orders cannot be linked; with
    ``candidates`` they leave before overlaps are counted. (A first pivot's overlaps are needed of all.)
    """
    left = sets.select("key", "n", "tokens", "low", "high")
    right = sets.selectExpr("key AS pivot", "n AS m", "tokens AS others", "low AS low_2", "high AS high_2")
    found = pairs.join(left, "key").join(right, "pivot").withColumn(
        "candidate",
        F.expr(f"""{percent} * greatest(n, m) <= 100 * least(n, m)
            AND arrays_overlap(low, low_2) AND arrays_overlap(high, high_2)"""),
    )
    found = (found.where("candidate") if candidates else found).selectExpr(
        "key",
        "pivot",
        "n",
        "m",
        "candidate",
        "array_except(tokens, others) AS outside",
        "size(tokens) AS kept",
    )
    return found.selectExpr(
        "key",
        "pivot",
        "n",
        "m",
        "kept - size(outside) AS o",
        f"candidate AND kept - size(outside) >= {_overlap_need('n', 'm', percent)} AS linked",
        "outside",
    )


def _first_pairs(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Each bucket's members beside its pivot, the one whose tokens are commonest."""
    pivots = members.join(sets.select("key", "common"), "key").groupBy("bucket")
    pivots = pivots.agg(F.max(F.struct("common", "key"))["key"].alias("pivot"))
    paired = members.join(pivots, "bucket").where("key <> pivot")
    return paired.select("key", "pivot").distinct()


def _later_pairs(members: DataFrame, sets: DataFrame, many: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Open members beside those of other components in their buckets that they can be linked with,
    ``many`` of each bucket.

    The pairs, and the bucket members that were such pivots. Those whose tokens are commonest go
    first. Two members of a group have at most the lesser of their overlaps with the first pivot
    (``o``; 0 where all tokens count) and the lesser of their other shared tokens (``held``) in common.
    """
    order = Window.partitionBy("bucket").orderBy(F.desc("common"), "key")
    ranked = members.where("open").join(sets.select("key", "common"), "key")
    turns = ranked.withColumn("turn", F.row_number().over(order)).where(f"turn <= {many}")
    pivots = turns.selectExpr("bucket", "key AS pivot", "key_c AS pivot_c", "n AS m", "o AS o_2", "held AS held_2")
    on = F.expr(
        f"""key <> pivot AND key_c <> pivot_c AND {percent} * greatest(n, m) <= 100 * least(n, m)
        AND least(o, o_2) + least(held, held_2) >= {_overlap_need('n', 'm', percent)}"""
    )
    paired = members.join(pivots, (members["bucket"] == pivots["bucket"]) & on)
    paired = paired.selectExpr("least(key, pivot) AS key", "greatest(key, pivot) AS pivot").distinct()
    return paired, turns.select("bucket", "key")


def _labelled(rows: DataFrame, labels: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        named = labels.select(F.col("node").alias(column), F.col("component").alias(f"{column}_c"))
        rows = rows.join(named, column, "left").withColumn(
            f"{column}_c", F.coalesce(f"{column}_c", column)
        )
    return rows


def _next_members(checked: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Buckets that can still hold a link between different components, with their members.

    Let x and a be linked members of a pivot's bucket, in different components; at least one is
    *open*, that is, not in the pivot's. x has o(x) tokens in common with the pivot.

    * Out of need(x) common tokens need(x) - o(x) lie outside the pivot, and the same for a. Tokens
      count that two components of the group hold outside the pivot. Who has fewer of them than that
      has no partner; of the others prefixes of these tokens meet.
    * Only if o(x) >= need(x) and o(a) >= need(a) may all lie inside the pivot. Were both as long as
      the pivot, the open one would be linked to it; so those that are open or shorter meet in
      prefixes of all the tokens that two components of these hold.

    Both prefixes are in order of a token's frequency within the group, rarest first.
    """
    known = stored(_labelled(checked, labels, "key", "pivot"), "known").withColumn(
        "open", F.expr("key_c <> pivot_c")
    )
    groups = known.where("open").select("pivot").distinct()
    need = _need("n", percent)
    busy = known.join(groups, "pivot").withColumn("short", F.expr(f"greatest({need} - o, 1)"))
    about = ["pivot", "key", "open", "key_c", "n", "o"]
    outside = busy.where("size(outside) >= short").select(
        *about, "short", F.lit(False).alias("inside"), F.explode("outside").alias("token")
    )
    within = busy.where(f"o >= {need} AND (open OR n < m)").withColumn("o", F.lit(0).cast("int"))
    within = within.select(*about, F.expr(need).alias("short"))
    within = within.join(sets.select("key", "tokens"), "key").select(
        *about, "short", F.lit(True).alias("inside"), F.explode("tokens").alias("token")
    )
    held = stored(outside.unionByName(within), "tokens")
    group = ["pivot", "inside", "token"]
    live = held.groupBy(*group).agg(
        F.count(F.lit(1)).alias("df"), F.min("key_c").alias("low"), F.max("key_c").alias("high")
    )
    live = live.where("low <> high").select(*group, "df")
    lists = held.join(live, group).groupBy("pivot", "inside", "key").agg(
        F.first("open").alias("open"),
        F.first("key_c").alias("key_c"),
        F.first("short").alias("short"),
        F.first("n").alias("n"),
        F.first("o").alias("o"),
        F.collect_list(F.struct("df", "token")).alias("found"),
    )
    lists = lists.where("size(found) >= short").withColumn(
        "prefix", F.expr("slice(array_sort(found), 1, CAST(greatest(size(found) - short + 1, 0) AS INT)).token")
    )
    about = ["key", "key_c", "open", "n", "o"]
    members = lists.select(
        "pivot", "inside", *about, F.size("found").alias("held"), F.explode("prefix").alias("token")
    )
    members = _mixed(members.select(F.xxhash64("pivot", "inside", "token").alias("bucket"), *about, "held"))
    discard(known)
    discard(held)
    return members


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets with several components, stored."""
    members = stored(members, "members")
    live = members.groupBy("bucket").agg(F.min("key_c").alias("low"), F.max("key_c").alias("high"))
    found = stored(members.join(live.where("low <> high").select("bucket"), "bucket"), "open")
    discard(members)
    return found


def near_duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of
    ``width``-word shingles; ``component_id`` is the least ``doc_id`` reachable. Texts that
    are null or have no words have an empty set and link with nothing. Other columns of
    ``docs`` are ignored. Rows that repeat are rows of their own; a null ``doc_id`` is never
    a component's id unless all its members have none. An empty frame gives an empty frame.

    ``share``: the first order asks for one shared token in ``share`` (see ``prefix_extra``).
    ``broadcast_rows``: ids of sets that remain after the first order
    are broadcast up to this count and shuffled beyond.
    Sets are compared by 64-bit hashes of shingles and of whole sets.
    """
    rows, joined = _components(docs, **options)
    least = joined.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = joined.join(least, "component").select("key", "component_id")
    found = rows.withColumn("key", F.expr("IF(n > 0, key, NULL)")).join(named, "key", "left")
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _components(
    docs: DataFrame,
    width: int = 5,
    percent: int = 75,
    share: int = 16,
    broadcast_rows: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their sets' keys; keys with the ``component``, ``copies``, ``least_id`` and ``first`` row.

    ``first`` is the row of least id, of equal ids that of least ``mark``; null ids are last.
    """
    # Texts are read and hashed once for their keys and for the first order.
    prefixes = stored(_sets(docs, width, lambda n: prefix_length(n, percent, share)), "prefixes")
    rows = stored(prefixes.drop("tokens"), "rows")
    classes = rows.where("n > 0").groupBy("key").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
        F.min(F.expr("named_struct('none', doc_id IS NULL, 'id', doc_id, 'mark', mark)")).alias("first"),
    )
    classes = stored(classes, "classes")
    survivors = _survivors(prefixes, classes, percent, share)
    discard(prefixes)
    sets = _rare_first(docs, survivors, width, percent, broadcast_rows)
    discard(survivors)
    members = sets.select(F.explode("prefix").alias("bucket"), "key")
    checked = stored(_verify(_first_pairs(members, sets), sets, percent), "checked")
    links = stored(checked.where("linked").selectExpr("key AS a", "pivot AS b"), "links")
    labels = stored(connected_components(links), "labels")
    members, many = _next_members(checked, labels, sets, percent), 16
    seen = stored(checked.selectExpr("least(key, pivot) AS key", "greatest(key, pivot) AS pivot"), "seen")
    discard(checked)
    while not members.isEmpty():
        pairs, turns = _later_pairs(members, sets, many, percent)
        pairs = stored(pairs.join(seen, ["key", "pivot"], "left_anti"), "pairs")
        new = stored(_verify(pairs, sets, percent, True).where("linked").selectExpr("key AS a", "pivot AS b"), "links")
        if not new.isEmpty():
            links = links.unionByName(new)
            labels = stored(connected_components(links), "labels")
        seen, many = seen.unionByName(pairs), many * 16
        # A pivot is done with its bucket; who has joined the component of all others is, too.
        left = members.join(turns, ["bucket", "key"], "left_anti").drop("key_c")
        left = _labelled(left, labels, "key").select(*members.columns)
        before, members = members, _mixed(left)
        discard(before)
    joined = classes.join(labels, classes["key"] == labels["node"], "left").select(
        "key", "least_id", "copies", "first", F.coalesce("component", "key").alias("component")
    )
    return rows, joined


def representatives(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` less all but one row of each group of near duplicates.

    Of a group the row with the least id stays, with all its columns; null ids come last,
    of rows of one id that of least text hash stays, of equal rows any one. A row is known
    by its id and the hash of its text, so other texts of the same id are not touched.
    Documents without words stay.
    """
    rows, joined = _components(docs, **options)
    groups = joined.groupBy("component").agg(
        F.min("first").alias("first"), F.sum("copies").alias("members")
    ).where("members > 1")
    grouped = joined.select("key", "component").join(groups, "component").select("key", "first")
    found = rows.where("n > 0").join(grouped, "key").groupBy("doc_id", "mark").agg(
        F.count(F.lit(1)).alias("repeats"),
        F.max(F.expr("doc_id <=> first.id AND mark = first.mark")).alias("kept"),
    )
    found = stored(found, "members")

    def beside(those: DataFrame, how: str) -> DataFrame:
        those = those.select(F.col("doc_id").alias("that_id"), F.col("mark").alias("that_mark"))
        on = docs["doc_id"].eqNullSafe(those["that_id"]) & (F.xxhash64(docs["text"]) == those["that_mark"])
        return docs.join(those, on, how)

    stay = beside(found.where("NOT kept OR repeats > 1"), "left_anti")
    again = found.where("kept AND repeats > 1")
    if again.isEmpty():
        return stay
    return stay.unionByName(beside(again, "left_semi").dropDuplicates(["doc_id", "text"]))
