"""The trie of conversation prefixes, with subtree totals by parallel tree contraction.

A node is a different sequence of first turns. Turns are numbered inside their
conversation; a prefix is known by the XOR of hashes of its (position, turn)
pairs, two of 64 bits, so all prefixes of a conversation come from one running
aggregate, and the parent's key from taking the last turn out again. A node's
own name is (smallest member, depth), which is exact.

Subtree totals come from contraction in rounds of joins. Each round *rakes*
(every leaf hands its total to its parent and leaves) and *compresses* (in
chains of nodes with one child left, some nodes, never two neighbours, are
spliced out; what they held travels on with the child's edge). The number of
rounds is logarithmic in the number of nodes for whatever shape. Then the
spliced nodes are re-expanded, last round first: a node's total is its child's
and what was noted when it left.

Scale: every join of a round has one row of each node on both sides, or sums by
parent with map-side aggregation first, so a first turn that a third of the
conversations share is one row. A conversation's turns are numbered in blocks of
TURN_BLOCK turn numbers, and the members that end at a node are joined in blocks
of END_BLOCK ids; the digest of a node reads its blocks as a stream.

Defined cases: rows without conv_id are ignored; null roles and texts are empty;
null turns come first; turns of one number are ordered by role and the md5 of
``<length of role>:<role><text>``; a repeated row is a turn like any other; other
columns are ignored; an empty table has no node, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowvigil.llm.store import stored

TURN_BLOCK = 1024
END_BLOCK = 512
#: Conversations are rebuilt in groups of this many ids, with fewer than SHARED turns in common.
GROUP = 100
SHARED = 6

_LONG_MIN = -(1 << 63)


def _shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % SHARED


def _base(conv_id: Column) -> Column:
    return conv_id - conv_id % GROUP


def _block(number: Column, size: int) -> Column:
    """Blocks of numbers, in their order; null comes before all."""
    return F.coalesce(F.floor(number / size).cast("bigint"), F.lit(_LONG_MIN))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn_hash, n_chars``: turns in order, from 1."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        _block(F.col("turn"), TURN_BLOCK).alias("block"),
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("turn_hash"),
        F.length(text).cast("bigint").alias("n_chars"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy(
        F.col("turn").asc_nulls_first(), "role", "turn_hash"
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        turns.groupBy("conv_id", "block")
        .agg(F.count("*").alias("n"))
        .select("conv_id", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    placed = turns.withColumn("within", F.row_number().over(inside)).join(before, ["conv_id", "block"])
    return placed.select(
        "conv_id", (F.col("before") + F.col("within")).cast("bigint").alias("pos"), "turn_hash", "n_chars"
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their hundred, and how long each is.

    The first ``h`` turns of conversation ``c - c % 100``, then the own ones after
    the first ``h``, for ``h = crc32(c) % 6``. Returns ``conv_id, pos, turn_hash,
    n_chars`` and ``conv_id, n_turns``.
    """
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    bases = sizes.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.col("n").alias("n_base")
    )
    plan = stored(
        sizes.withColumn("h", _shared_turns(F.col("conv_id")))
        .withColumn("base", _base(F.col("conv_id")))
        .join(bases, "base", "left")
        .select(
            "conv_id", "base", "n", "h", F.least("h", F.coalesce("n_base", F.lit(0))).cast("bigint").alias("taken")
        ),
        "rebuilding",
    )
    lead = turns.where((F.col("pos") < SHARED) & (F.col("conv_id") % GROUP == 0)).select(
        F.col("conv_id").alias("base"), "pos", "turn_hash", "n_chars"
    )
    taken = (
        plan.where("taken > 0")
        .join(lead, "base")
        .where("pos <= taken")
        .select("conv_id", "pos", "turn_hash", "n_chars")
    )
    own = (
        turns.where(F.col("pos") > _shared_turns(F.col("conv_id")))
        .join(plan.select("conv_id", "h", "taken"), "conv_id")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_hash", "n_chars")
    )
    length = (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).cast("bigint")
    return taken.unionByName(own), plan.select("conv_id", length.alias("n_turns"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, ka, kb, pa, pb, n_chars``: key and parent's key of each prefix."""
    hashed = turns.select(
        "conv_id",
        "pos",
        _block(F.col("pos"), TURN_BLOCK).alias("block"),
        F.xxhash64("pos", "turn_hash").alias("a"),
        F.xxhash64("turn_hash", "pos").alias("b"),
        "n_chars",
    )
    inside = (
        Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        hashed.groupBy("conv_id", "block")
        .agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
        .select(
            "conv_id",
            "block",
            *[F.coalesce(F.bit_xor(k).over(earlier), F.lit(0)).alias(f"before_{k}") for k in "ab"],
        )
    )
    running = hashed.withColumns({f"run_{k}": F.bit_xor(k).over(inside) for k in "ab"})
    joined = running.join(carried, ["conv_id", "block"])
    key = {k: F.col(f"run_{k}").bitwiseXOR(F.col(f"before_{k}")) for k in "ab"}
    return joined.select(
        "conv_id",
        F.col("pos").alias("depth"),
        *[key[k].alias(f"k{k}") for k in "ab"],
        *[key[k].bitwiseXOR(F.col(k)).alias(f"p{k}") for k in "ab"],
        "n_chars",
    )


_KEY = ("depth", "ka", "kb")


def _digests(ends: DataFrame) -> DataFrame:
    """``depth, ka, kb, ends_sha256`` of the ids that end at each node, ascending, comma-joined."""
    blocks = ends.groupBy(*_KEY, _block(F.col("conv_id"), END_BLOCK).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    dealt = blocks.repartition(*_KEY).sortWithinPartitions(*_KEY, "block")
    schema = T.StructType(
        [*[T.StructField(name, T.LongType()) for name in _KEY], T.StructField("ends_sha256", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for *of, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 4)), strict=True):
                if of != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = of, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield _batch(done, schema)
        if key is not None:
            yield _batch([(*key, digest.hexdigest())], schema)

    return dealt.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(column, pa.int64()) for column in columns[:3]] + [pa.array(columns[3], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def trie_nodes(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The nodes of conversations ``turns`` (numbered) of known ``sizes``, without subtree totals.

    ``conv_id, depth, parent_conv_id, n_convs, n_chars, n_children, ends_sha256``.
    """
    rows = stored(prefixes(turns), "prefixes")
    grouped = rows.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        *[F.first(name).alias(name) for name in ("pa", "pb", "n_chars")],
    )
    nothing = F.lit(0).cast("bigint")
    root = (
        sizes.groupBy(nothing.alias("depth"))
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        .select(
            "depth", nothing.alias("ka"), nothing.alias("kb"), "conv_id", "n_convs",
            *[nothing.alias(name) for name in ("pa", "pb", "n_chars")],
        )
    )
    nodes = stored(grouped.unionByName(root), "nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
        .agg(F.count("*").alias("n_children"))
    )
    last = rows.join(sizes, "conv_id").where("depth = n_turns").select("conv_id", *_KEY)
    turnless = sizes.where("n_turns = 0").select("conv_id", *[nothing.alias(name) for name in _KEY])
    digests = _digests(last.unionByName(turnless))
    # The child's side of the parent's name: read anew, so that a node with most children can be split.
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    named = nodes.join(parents, ["depth", "pa", "pb"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return named.join(children, list(_KEY), "left").join(digests, list(_KEY), "left").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs",
        "n_chars",
        F.coalesce("n_children", nothing).alias("n_children"),
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


def _raked(live: DataFrame, totals: list[str]) -> DataFrame:
    """Live nodes without their leaves: what the leaves held is the parents' now."""
    leaf = F.col("n_live") == 0
    handed = (
        live.where("parent is not null")
        .groupBy(F.col("parent").alias("of"))
        .agg(
            *[F.sum(F.when(leaf, F.col(name) + F.col(f"edge_{name}")).otherwise(0)).alias(f"add_{name}") for name in totals],
            F.count_if(~leaf).alias("left"),
            F.min(F.when(~leaf, F.col("id"))).alias("child"),
        )
    )
    staying = live.where("n_live > 0").drop("n_live")
    joined = staying.join(handed, F.col("id") == F.col("of"), "left")
    return joined.select(
        "id",
        "parent",
        *[(F.col(name) + F.coalesce(f"add_{name}", F.lit(0))).alias(name) for name in totals],
        *[f"edge_{name}" for name in totals],
        F.coalesce("left", F.lit(0)).alias("n_live"),
        "child",
    )


def _spliced(live: DataFrame, totals: list[str], turn: int) -> DataFrame:
    """Nodes to take out of chains, each with the child that outlives it.

    ``id, child, above, note_*, edge_*``: a node's total is its child's and the
    note; the child's edge goes to ``above`` then and carries ``edge_*``.
    """
    chain = (F.col("n_live") == 1) & F.col("parent").isNotNull()
    # A third of a chain leaves: those whose draw is below the draws of both neighbours.
    marked = live.withColumn("draw", F.when(chain, F.xxhash64("id", F.lit(turn))))
    below = marked.select(
        F.col("id").alias("child"),
        F.col("draw").alias("child_draw"),
        *[F.col(f"edge_{name}").alias(f"child_edge_{name}") for name in totals],
    )
    lower = F.col("child_draw").isNull() | (F.col("draw") < F.col("child_draw"))
    won = marked.where("draw is not null").join(below, "child").where(lower)
    beaten = won.select(F.col("child").alias("id"))
    return won.join(beaten, "id", "left_anti").select(
        "id",
        "child",
        F.col("parent").alias("above"),
        *[(F.col(name) + F.col(f"child_edge_{name}")).alias(f"note_{name}") for name in totals],
        *[(F.col(name) + F.col(f"child_edge_{name}") + F.col(f"edge_{name}")).alias(f"edge_{name}") for name in totals],
    )


def _without(live: DataFrame, spliced: DataFrame, totals: list[str]) -> DataFrame:
    left = live.join(spliced.select("id"), "id", "left_anti")
    new = spliced.select(
        F.col("child").alias("id"), "above", *[F.col(f"edge_{name}").alias(f"new_{name}") for name in totals]
    )
    return left.join(new, "id", "left").select(
        "id",
        F.coalesce("above", "parent").alias("parent"),
        *totals,
        *[F.coalesce(f"new_{name}", f"edge_{name}").alias(f"edge_{name}") for name in totals],
        "n_live",
    )


def subtree_totals(tree: DataFrame, totals: list[str]) -> DataFrame:
    """``id`` and the totals over each node's subtree, the node included.

    ``tree`` has ``id``, ``parent`` (null at a root), ``n_children`` and the columns to total.
    """
    live = stored(
        tree.select(
            "id", "parent", *totals, *[F.lit(0).cast("bigint").alias(f"edge_{name}") for name in totals],
            F.col("n_children").alias("n_live"),
        ),
        "tree",
    )
    finished, rounds = [], []
    while True:
        finished.append(live.where("n_live = 0").select("id", *totals))
        if live.where("n_live > 0").isEmpty():
            break
        raked = stored(_raked(live, totals), "raked")
        spliced = stored(_spliced(raked, totals, len(rounds)), "spliced")
        rounds.append(spliced)
        live = stored(_without(raked, spliced, totals), "live")
    known = finished[0]
    for part in finished[1:]:
        known = known.unionByName(part)
    for spliced in reversed(rounds):
        of_child = known.select(F.col("id").alias("child"), *[F.col(name).alias(f"of_{name}") for name in totals])
        expanded = stored(
            spliced.join(of_child, "child").select(
                "id", *[(F.col(f"note_{name}") + F.col(f"of_{name}")).alias(name) for name in totals]
            ),
            "expanded",
        )
        known = known.unionByName(expanded)
    return known


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the rebuilt conversations.

    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    turns, sizes = rebuilt_turns(stored(numbered_turns(conversations), "turns"))
    nodes = stored(trie_nodes(turns, sizes), "trie")
    tree = nodes.select(
        F.struct("conv_id", "depth").alias("id"),
        F.when(
            F.col("depth") > 0,
            F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")),
        ).alias("parent"),
        "n_children",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    summed = subtree_totals(tree, ["n_leaves", "saved_tokens"]).select(
        F.col("id.conv_id").alias("conv_id"), F.col("id.depth").alias("depth"), "n_leaves", "saved_tokens"
    )
    return nodes.join(summed, ["conv_id", "depth"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
