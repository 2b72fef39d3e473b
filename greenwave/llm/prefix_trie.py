"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Nodes are sorted by reverse level order; each adds
up what its children sent and sends its own total to its parent through a priority queue, which
spills sorted runs. This runs within shards, whole subtrees of bounded many conversations, and
then over the few nodes above all shards, which receive the totals of the shards' roots.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenwave.llm.common import broadcast_below, stored

#: Turns whose hashes one window adds up; longer conversations are cut into such blocks.
BLOCK = 4096
#: Bits of ``monotonically_increasing_id`` that count within a partition.
PLACE_BITS = 33


class SpillingQueue:
    """Priority queue of (key1, key2, key3, leaves, saved); beyond ``limit`` messages sorted runs go to disk.

    A run is a file without a name, which ends with the task. Messages of equal keys become one
    when they are spilled.
    """

    WIDTH, READ = 5, 8192

    def __init__(self, limit: int):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def put(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def take(self, key: tuple[int, int, int]) -> tuple[int, int]:
        """Sums of all messages of ``key``, which no message in the queue precedes."""
        leaves = saved = 0
        while self.heap and self.heap[0][:3] == key:
            message = heapq.heappop(self.heap)
            leaves, saved = leaves + message[3], saved + message[4]
        while self.runs and self.runs[0][0][:3] == key:
            message, number, rest = self.runs[0]
            leaves, saved = leaves + message[3], saved + message[4]
            following = next(rest, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, rest))
        return leaves, saved

    def _spill(self) -> None:
        rows = np.array(sorted(self.heap), np.int64)
        first = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])
        rows = np.hstack([rows[first, :3], np.add.reduceat(rows[:, 3:], first)])
        file = tempfile.TemporaryFile()
        rows.tofile(file)
        file.seek(0)
        self.heap = []
        rest = self._read(file)
        self.spills += 1
        heapq.heappush(self.runs, (next(rest), self.spills, rest))

    @classmethod
    def _read(cls, file) -> Iterator[tuple[int, ...]]:
        with file:
            while len(rows := np.fromfile(file, np.int64, cls.READ * cls.WIDTH)):
                yield from map(tuple, rows.reshape(-1, cls.WIDTH).tolist())


def _time_forward(nodes: DataFrame, limit: int) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved_tokens`` summed over subtrees, partition by partition.

    Partitions hold whole shards, sorted by reverse level order; ``top`` marks nodes whose parent
    is elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in ("depth", "k1", "k2", "p1", "p2", "top", "n_leaves", "saved_tokens")}
            leaves, saved = columns["n_leaves"], columns["saved_tokens"]
            for at, (depth, k1, k2, p1, p2, top, _, _) in enumerate(zip(*columns.values())):
                more = queue.take((-depth, k1, k2))
                leaves[at] += more[0]
                saved[at] += more[1]
                if not top:
                    queue.put((1 - depth, p1, p2, leaves[at], saved[at]))
            for name in ("n_leaves", "saved_tokens"):
                place = batch.schema.get_field_index(name)
                batch = batch.set_column(place, name, pa.array(columns[name], pa.int64()))
            yield batch

    return nodes.sortWithinPartitions(F.desc("depth"), "k1", "k2").mapInArrow(run, nodes.schema)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 0), ``len`` (turns of the conversation), ``g1``, ``g2``, ``bytes``; stored.

    Turns are in order of ``turn`` (null first), then role, then text. ``g1`` and ``g2`` are
    hashes of role and text, ``bytes`` the text's UTF-8 length. A range partitioning spreads one
    conversation's turns over tasks; each task numbers its part, and the counts of the parts
    before are added.
    """
    order = ("conv_id", "turn", "role", "text")
    turns = conversations.selectExpr(
        "CAST(conv_id AS BIGINT) AS conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text"
    ).where("conv_id IS NOT NULL")
    placed = stored(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("place"),
            F.xxhash64("role", "text").alias("g1"),
            F.xxhash64(F.lit("second"), "text", "role").alias("g2"),
            F.octet_length("text").cast("long").alias("bytes"),
        ),
        "turns",
    ).withColumn("part", F.shiftright("place", PLACE_BITS))
    parts = placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv_id")
    parts = parts.select(
        "conv_id",
        "part",
        "first",
        F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("len"),
    )
    return stored(
        placed.join(parts, ["conv_id", "part"]).selectExpr(
            "conv_id", "place - first + before AS pos", "len", "g1", "g2", "bytes"
        ),
        "numbered",
    )


def rebuilt_paths(numbered: DataFrame, heads: int = 9, family: int = 5) -> tuple[DataFrame, DataFrame]:
    """The turns of all rebuilt conversations, and the conversations.

    Conversation c begins with the first h turns of c - c % ``family`` (the sign of c % family is
    that of c), where h is crc32(c) % ``heads``, and goes on with its own turns after its first h.
    Turns: ``conv_id``, ``depth`` (from 1), ``ends`` (whether it is the last), ``g1``, ``g2``, ``bytes``,
    ``total``. Conversations: ``conv_id``, ``total`` (turns, 0 or more); stored.
    """
    convs = numbered.where("pos = 0").selectExpr(
        "conv_id",
        f"conv_id - conv_id % {family} AS base",
        f"crc32(CAST(conv_id AS STRING)) % {heads} AS h",
        "len",
    )
    base = convs.selectExpr("conv_id AS base", "len AS base_len")
    convs = convs.join(base, "base", "left").selectExpr(
        "conv_id", "base", "h", "least(h, coalesce(base_len, 0L)) AS head", "greatest(len - h, 0L) AS rest"
    )
    convs = stored(convs.withColumn("total", F.expr("head + rest")), "conversations")
    first = numbered.where(f"pos < {heads - 1}").selectExpr("conv_id AS base", "pos", "g1", "g2", "bytes")
    columns = ["conv_id", "depth", "depth = total AS ends", "g1", "g2", "bytes", "total"]
    copied = convs.join(first, "base").where("pos < head").withColumn("depth", F.expr("pos + 1"))
    own = numbered.join(convs, "conv_id").where("pos >= h").withColumn("depth", F.expr("pos - h + head + 1"))
    return copied.selectExpr(*columns).unionByName(own.selectExpr(*columns)), convs.select("conv_id", "total")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """Each turn's node (``k1``, ``k2``) and its parent's (``p1``, ``p2``), 128 bits: ``turns`` stored with these.

    A key is the exclusive or of a hash of every turn up to it, salted with the turn's depth. So
    blocks of a long conversation are added up apart and shifted by the blocks before.
    """
    salted = turns.selectExpr(
        "conv_id",
        "depth",
        "ends",
        "bytes",
        "total",
        f"(depth - 1) div {BLOCK} AS block",
        "xxhash64(depth, g1, g2) AS h1",
        "xxhash64(g2, depth, g1, 'second') AS h2",
    )
    sums = salted.where(f"total > {BLOCK}").groupBy("conv_id", "block")
    sums = sums.agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(
        sums.select("conv_id", "block", *[F.bit_xor(x).over(before).alias(x) for x in ("x1", "x2")]).where("block > 0"),
        "blocks",
    )
    upto = Window.partitionBy("conv_id", "block").orderBy("depth")
    keyed = salted.select(
        "*", F.bit_xor("h1").over(upto).alias("u1"), F.bit_xor("h2").over(upto).alias("u2")
    ).join(broadcast_below(shifts, 100_000), ["conv_id", "block"], "left")
    keyed = keyed.selectExpr(
        "conv_id", "depth", "ends", "bytes", "h1", "h2", "u1 ^ coalesce(x1, 0L) AS k1", "u2 ^ coalesce(x2, 0L) AS k2"
    )
    keyed = keyed.selectExpr("conv_id", "depth", "ends", "bytes", "k1", "k2", "k1 ^ h1 AS p1", "k2 ^ h2 AS p2")
    return stored(keyed, "paths")


def end_digests(ends: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """``k1``, ``k2``, ``ends_sha256``: the SHA-256 of each node's ids, ascending and comma-joined.

    ``ends``: ``k1``, ``k2``, ``conv_id``. A range partitioning spreads the ids of one node over
    tasks, which join them to texts of about ``chunk`` bytes; the digest then streams over a node's
    texts in order.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, str]] = []
        node, first, texts, size = None, 0, [], 0
        for batch in batches:
            k1, k2, ids = (batch.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
            cuts = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(ids)]):
                if begin == end:
                    continue
                if node != (k1[begin], k2[begin]) or size >= chunk:
                    if texts:
                        out.append((*map(int, node), first, ",".join(texts)))
                    node, first, texts, size = (k1[begin], k2[begin]), int(ids[begin]), [], 0
                texts.append(",".join(map(str, ids[begin:end].tolist())))
                size += len(texts[-1]) + 1
            if out:
                yield batch_of(out)
                out = []
        if texts:
            yield batch_of([(*map(int, node), first, ",".join(texts))])

    def batch_of(rows) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["k1", "k2", "first", "ids"]
        )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == node:
                    state.update(b",")
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (k1, k2), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield digests_of(done)
        if node:
            yield digests_of([(*node, state.hexdigest())])

    def digests_of(rows) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["k1", "k2", "ends_sha256"]
        )

    order = ("k1", "k2", "conv_id")
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    chunks = chunks.mapInArrow(join, "k1 long, k2 long, first long, ids string")
    chunks = chunks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
    return chunks.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    heads: int = 9,
    family: int = 5,
    shard_convs: int = 1000,
    top_nodes: int = 50_000,
    queue_limit: int = 500_000,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt_paths``).

    ``conv_id``, smallest member; ``depth``; ``parent_conv_id`` (root: null); ``n_convs``, members;
    ``n_children``; ``n_leaves``, childless nodes of the subtree; ``saved_tokens``, summed over the
    subtree (n_convs - 1) times the bytes of a node's last text; ``ends_sha256``, digest of the ids that
    end at the node.

    Null ids make no conversation; null role and text are empty; turns of equal number follow in
    order of role and text; repeated rows are turns of their own; other columns are ignored; an
    empty table gives no rows, not even the root.

    Nodes of more members than ``shard_convs`` (more, where ``top_nodes`` such nodes could not hold
    all memberships) lie above the shards: at most ``top_nodes`` and the root, so these are broadcast
    and summed in one task. Below them, a subtree of several members goes to one task whole; its
    queue holds ``queue_limit`` messages in memory. Nodes of one member need no processing: they
    have one leaf and save nothing.
    """
    turns, convs = rebuilt_paths(numbered_turns(conversations), heads, family)
    paths = prefix_keys(turns)
    root = convs.agg(
        F.lit(0).cast("long").alias("k1"),
        F.lit(0).cast("long").alias("k2"),
        F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"),
        F.lit(0).cast("long").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.lit(0).cast("long").alias("bytes"),
        F.bool_or(F.col("total") == 0).alias("ends"),
    ).where("n_convs > 0")
    nodes = paths.groupBy("k1", "k2").agg(
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("bytes").alias("bytes"),
        F.bool_or("ends").alias("ends"),
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    most = max(shard_convs, paths.count() // top_nodes)

    # Nodes of several members, with what their children of one member send.
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    shared = nodes.where("n_convs > 1").join(children, ["k1", "k2"], "left").selectExpr(
        "k1", "k2", "p1", "p2", "depth", "conv_id", "n_convs", "ends",
        "coalesce(n_children, 0L) AS n_children",
        "coalesce(single, 1L) AS n_leaves",  # no children: itself
        "(n_convs - 1) * bytes AS saved_tokens",
    )
    shared = stored(shared, "shared")
    above = shared.where(f"n_convs > {most}")
    over = F.broadcast(above.selectExpr("k1 AS p1", "k2 AS p2", "conv_id AS parent_conv_id"))

    # Shards: the subtrees below; every node finds its shard's root on the path of its smallest member.
    below = shared.where(f"n_convs <= {most}")
    roots = paths.join(over, ["p1", "p2"], "left_semi").select("conv_id", "k1", "k2")
    roots = roots.join(F.broadcast(above.select("k1", "k2")), ["k1", "k2"], "left_anti")
    roots = roots.selectExpr("conv_id", "k1 AS r1", "k2 AS r2")
    sharded = below.join(roots, "conv_id", "left").selectExpr(
        *shared.columns, "r1", "r2", "p1 IS NULL OR (k1 <=> r1 AND k2 <=> r2) AS top"
    )
    summed = stored(_time_forward(sharded.repartition("r1", "r2"), queue_limit), "shards").drop("r1", "r2")

    # The nodes above, with the totals of the shards' roots.
    sent = summed.where("top").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    sent = sent.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    waiting = above.join(sent, ["k1", "k2"], "left").select(
        *[c for c in shared.columns if c not in ("n_leaves", "saved_tokens")],
        F.expr("n_leaves + coalesce(more_leaves, 0L)").alias("n_leaves"),
        F.expr("saved_tokens + coalesce(more_saved, 0L)").alias("saved_tokens"),
        F.expr("p1 IS NULL").alias("top"),
    )
    summed = summed.unionByName(_time_forward(waiting.repartition(1), queue_limit)).drop("top")

    turnless = convs.where("total = 0").selectExpr("0L AS k1", "0L AS k2", "conv_id")
    digests = end_digests(paths.where("ends").select("k1", "k2", "conv_id").unionByName(turnless))
    summed = summed.join(digests, ["k1", "k2"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))
    )
    single = nodes.where("n_convs = 1").selectExpr(
        "k1", "k2", "p1", "p2", "depth", "conv_id", "n_convs", "ends",
        "IF(ends, 0L, 1L) AS n_children",
        "1L AS n_leaves",
        "0L AS saved_tokens",
        "sha2(IF(ends, CAST(conv_id AS STRING), ''), 256) AS ends_sha256",
    )
    found = summed.unionByName(single)

    # A parent is above the shards (broadcast), within them (by key), or has the same single member.
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    high = found.join(over, ["p1", "p2"])
    within = below.selectExpr("k1 AS p1", "k2 AS p2", "conv_id AS within_conv_id")
    low = found.join(over, ["p1", "p2"], "left_anti").join(within, ["p1", "p2"], "left")
    low = low.withColumn("parent_conv_id", F.expr("IF(depth = 0, NULL, coalesce(within_conv_id, conv_id))"))
    return high.select(*columns).unionByName(low.select(*columns))
