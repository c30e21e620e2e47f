"""The trie of conversation prefixes, peeled from the deepest turns up.

1. Turns get their place in the conversation, and every prefix an id: sums of hashes
   of (place, turn) along the conversation, 128 bits together. Sums are taken over
   slices of a range partitioning with carries, so that a long conversation lies in
   many tasks, and texts travel as digests.
2. Prefixes with the same id are one node; members are counted with map-side combine,
   so a first turn that a third of all conversations share is no hot key.
3. Truncation peeling. Turns on a path whose nodes have the same members form a run,
   known by the smallest member and their number. All runs on which nothing hangs are
   stripped at once, whole runs at a time, and their sums are regrouped into the runs
   they hung on, where the conversations that end there are met; and so on until the
   root is stripped. The first round takes the tails that belong to one conversation,
   mostly the bulk. There are as many rounds as member changes on the path that has
   most of them, whatever the length of the conversations, and each writes one table
   of what is left.
4. Ids of conversations that end in a node are joined in blocks of bounded size, in
   numeric order, and hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abacarium.llm.common import by_value, stored
from abacarium.operators.ordering import running_sums
from abacarium.session import discard, stored_at

_SUMS = ("s1", "s2", "s3", "s4")
#: Ids of ended conversations that one row holds.
BLOCK = 1 << 14
_NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``place`` (from 1, by turn, NULL first, ties by role and a digest of the text), ``digest``, ``n_bytes``.

    NULL roles and texts count as empty; rows without a conversation id are left out.
    """
    said, by = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), by.alias("role"),
        F.unhex(F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said).cast("binary"))).alias("digest"),
        F.octet_length(said).cast("long").alias("n_bytes"))
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    return running_sums(rows, ["conv_id"], order, {"place": F.lit(1)}).select("conv_id", F.col("place").cast("long").alias("place"), "digest", "n_bytes")


def borrow_heads(rows: DataFrame, spread: int = 5, longest: int = 8) -> DataFrame:
    """``turns`` in which a conversation starts with the first turns of another one.

    Of conversation ``c`` the first ``h`` turns give way to the first ``h`` turns of
    ``c - c % spread`` (all it has, if fewer; none, if it is not there), where ``h`` is
    the crc32 of ``c`` in decimal modulo ``longest + 1``.
    """
    def size(c: str) -> Column:
        return F.crc32(F.col(c).cast("string").cast("binary")) % (longest + 1)

    def lender(c: str) -> Column:
        return F.col(c) - F.pmod(F.col(c), F.lit(spread))

    ids = rows.select("conv_id").distinct().select("conv_id", lender("conv_id").alias("lender"), size("conv_id").alias("h"))
    heads = stored(rows.where((F.pmod(F.col("conv_id"), F.lit(spread)) == 0) & (F.col("place") <= longest)).withColumnRenamed("conv_id", "lender"), "heads")
    borrowed = ids.join(heads, "lender").where("place <= h").select("conv_id", "place", "digest", "n_bytes")
    lent = heads.groupBy("lender").agg(F.max("place").alias("lent"))
    rest = rows.withColumns({"h": size("conv_id"), "lender": lender("conv_id")}).where("place > h").join(lent, "lender", "left")
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.least("h", F.coalesce("lent", F.lit(0)))).alias("place"), "digest", "n_bytes")
    return borrowed.unionByName(rest)


def _node(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums]).cast("binary")))


def _paths(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per conversation and depth, the root's included: the node, the node above, the bytes of the last text."""
    terms = {s: F.xxhash64("place", "digest", F.lit(s)).bitwiseAND(F.lit((1 << 32) - 1)) for s in _SUMS}
    # 32 bits each: a sum of two thousand million turns still fits into a long.
    named = rows.withColumns({f"t_{s}": term for s, term in terms.items()})
    summed = running_sums(named, ["conv_id"], ["place"], {s: F.col(f"t_{s}") for s in _SUMS})
    below = summed.select(
        "conv_id", F.col("place").alias("depth"), "n_bytes", _node(F.col("place"), [F.col(s) for s in _SUMS]).alias("node"),
        _node(F.col("place") - 1, [F.col(s) - F.col(f"t_{s}") for s in _SUMS]).alias("above"))
    root = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("n_bytes"),
                      _node(F.lit(0), [F.lit(0)] * len(_SUMS)).alias("node"), F.lit(None).cast("binary").alias("above"))
    return below.unionByName(root)


def _peel(runs: DataFrame) -> DataFrame:
    """``owner``, ``n``, ``n_leaves``, ``below`` (saved bytes under the run) of every run.

    ``runs``: ``owner``, ``n``, the run it hangs on (``up_owner``, ``up_n``), ``saved`` by
    its own turns, ``hanging`` runs.
    """
    alive = runs.select("owner", "n", "up_owner", "up_n", "saved", "hanging", *[F.lit(0).cast("long").alias(c) for c in ("n_leaves", "below")])
    alive = stored(alive, "runs")
    done, path = [], None
    while True:
        bare = alive.where("hanging = 0").withColumn("n_leaves", F.greatest("n_leaves", F.lit(1)))
        done.append(bare.select("owner", "n", "n_leaves", "below"))
        moved = bare.where("up_owner IS NOT NULL").groupBy(F.col("up_owner").alias("owner"), F.col("up_n").alias("n")).agg(
            F.sum("n_leaves").alias("more"), F.sum(F.col("below") + F.col("saved")).alias("gained"), F.count(F.lit(1)).alias("gone"))
        rest = alive.where("hanging > 0").join(moved, ["owner", "n"], "left").select(
            "owner", "n", "up_owner", "up_n", "saved", (F.col("hanging") - F.coalesce("gone", F.lit(0))).alias("hanging"),
            (F.col("n_leaves") + F.coalesce("more", F.lit(0))).alias("n_leaves"), (F.col("below") + F.coalesce("gained", F.lit(0))).alias("below"))
        alive, path = stored_at(rest, "runs")
        if alive.isEmpty():
            discard(runs.sparkSession, path)
            return reduce(DataFrame.unionByName, done)


def _joined_ids(ended: DataFrame) -> DataFrame:
    """``node``, ``ends_sha256`` of the ids that end in a node, in numeric order."""

    def block(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(node: bytes, ids: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"node": [node], "start": pa.array(ids[:1], pa.int64()), "ids": [",".join(map(str, ids))]})

        last, held = None, []
        for batch in source:
            for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if held and (node != last or len(held) == BLOCK):
                    yield row(last, held)
                    held = []
                last = node
                held.append(conv)
        if held:
            yield row(last, held)

    def digest(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, hashlib.sha256()
        for batch in source:
            out = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if node == last:
                    state.update(b",")
                elif last is not None:
                    out.append((last, state.hexdigest()))
                    state = hashlib.sha256()
                last = node
                state.update(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array([n for n, _ in out], pa.binary()), "ends_sha256": pa.array([s for _, s in out], pa.string())})
        if last is not None:
            yield pa.RecordBatch.from_pydict({"node": [last], "ends_sha256": [state.hexdigest()]})

    laid = ended.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    blocks = laid.mapInArrow(block, "node binary, start bigint, ids string")
    return blocks.repartition("node").sortWithinPartitions("node", "start").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_nodes(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per distinct prefix of conversations.

    ``rows``: ``conv_id``, ``place`` (1, 2, ...), ``digest`` of the turn, ``n_bytes`` of its
    text. ``ids``: the distinct ``conv_id``, also of conversations without turns, which
    belong to the root alone. Per node: ``conv_id``, its smallest member; ``depth``;
    ``parent_conv_id``; ``n_convs``, ``n_children``, ``n_leaves``; ``saved_tokens``, the
    bytes of texts that members beyond the first share, over the subtree;
    ``ends_sha256`` of the members that end here. Without ids there is no node.
    """
    paths = stored(_paths(rows, ids), "paths")
    nodes = paths.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("owner"), F.first("depth").alias("depth"), F.first("n_bytes").alias("n_bytes"), F.first("above").alias("above"))
    nodes = stored(nodes, "nodes")
    children = nodes.where("above IS NOT NULL").groupBy(F.col("above").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("node").alias("above"), F.col("owner").alias("up_owner"), F.col("n").alias("up_n"))
    nodes = stored(nodes.join(children, "node", "left").join(parents, "above", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "linked")

    runs = nodes.groupBy("owner", "n").agg(F.min_by(F.struct("up_owner", "up_n"), "depth").alias("up"), F.sum("n_bytes").alias("bytes"))
    runs = runs.select("owner", "n", "up.up_owner", "up.up_n", ((F.col("n") - 1) * F.col("bytes")).alias("saved"))
    hanging = nodes.where("up_n <> n").groupBy(F.col("up_owner").alias("owner"), F.col("up_n").alias("n")).agg(F.count(F.lit(1)).alias("hanging"))
    peeled = _peel(runs.join(hanging, ["owner", "n"], "left").withColumn("hanging", F.coalesce("hanging", F.lit(0))))

    shared = running_sums(nodes.where("n > 1"), ["owner", "n"], [F.col("depth").desc()], {"after": F.col("n_bytes")})
    every = shared.unionByName(nodes.where("n = 1").withColumn("after", F.lit(0).cast("long")))
    length = paths.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ends = _joined_ids(paths.join(length, ["conv_id", "depth"], "left_semi").select("node", "conv_id"))
    return every.join(peeled, ["owner", "n"]).join(ends, "node", "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("up_owner").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves",
        (F.col("below") + (F.col("n") - 1) * F.col("after")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def borrowed_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_nodes`` of conversations after ``borrow_heads``; an empty table gives no rows, other columns are ignored."""
    rows = stored(turns(conversations), "turns")
    return prefix_nodes(stored(borrow_heads(rows), "rebuilt"), rows.select("conv_id").distinct())


by_value(__name__)
