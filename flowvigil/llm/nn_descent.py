"""Approximate nearest neighbours by cosine: a graph from NN-descent, searched greedily.

1. Equal vectors are one node. Nodes are put in order by the signs of random
   projections, in several such orders; neighbours in an order are compared in
   blocks, which gives every node a first list of neighbours.
2. NN-descent: neighbours of neighbours are likely neighbours. Each round joins
   every node with its neighbours and with those that name it, compares those that
   have not met before, and keeps each node's best ``neighbours``. Rounds end when
   few lists still change.
3. A query starts at its own node and keeps the best ``beam`` nodes it has seen;
   all of them are expanded, round by round, until none is left that is not. The
   nodes in the end are ranked by the cosine of the original vectors in double
   precision, so whatever is returned carries its exact score.

The graph holds every row; nothing is fitted on a sample. A list of those that
name a node takes the best ``neighbours`` of them in a round; the others still have
the node in their own list, so each pair that meets there is compared all the same.

Scale: lists have a bounded length, so a group in a join has at most twice
``neighbours`` members; the best of a node are chosen in each task before they are
shuffled, which bounds what a hub receives. Vectors travel in half precision
while the graph is built and in single precision in the search. Each round is
stored; the driver sees a count.

Defined cases: rows without id take no part; neither do vectors that are null,
empty, zero or hold null or non-finite components, nor those whose length is not
the most common one (of equally common ones the greatest). Of several vectors of
one id the least counts. Equal vectors get equal scores, ties go to the smaller
id. Fewer candidates than asked for are all returned. Other columns are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowvigil.llm.store import stored

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Graph:
    """Sizes that recall depends on; README has figures."""

    neighbours: int = 32
    orders: int = 16
    block: int = 256
    first: int = 8
    #: Rounds end when this share of the lists' entries is new at most.
    settled: float = 0.08
    most_rounds: int = 12
    beam: int = 128
    seed: int = 11


#: Signs of projections in an order.
BITS = 32
#: Groups and blocks that a task compares at a time.
GROUPS = 256
_BEST = -2.0


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _columns(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def _unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """A row per packed vector."""
    if not len(column):
        return np.empty((0, 0), np.float32)
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, kind).reshape(len(column), -1).astype(np.float32)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches that cut no run of equal keys; a run is bounded by what calls this."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(values, values[-1]))
        if last or (kept and kept[0].column(key)[0].as_py() != values[0]):
            if last:
                kept.append(batch.slice(0, last))
            yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            kept = []
        kept.append(batch.slice(last))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def usable_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, vector`` (doubles): one vector for each id, all of one length."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    sound = rows.select(F.col(id_column).cast("bigint").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    ).where(F.exists("vector", lambda x: x != 0))
    chosen = stored(sound.groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    lengths = chosen.groupBy(F.size("vector").alias("length")).count()
    common = lengths.orderBy(F.col("count").desc(), F.col("length").desc()).first()
    return chosen.where(F.size("vector") == (common["length"] if common else 0))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Multiples by powers of two that neither overflow nor vanish when squared."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -exponent[:, None])


def _unit_vectors(nodes: DataFrame) -> DataFrame:
    """``node, unit`` (packed singles) and ``half`` (packed halves)."""
    schema = T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("unit", T.BinaryType()),
            T.StructField("half", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            vectors = _scaled(flat.reshape(batch.num_rows, -1))
            unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            packed = [
                pa.array([row.tobytes() for row in unit.astype(kind)], pa.binary()) for kind in (np.float32, np.float16)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *packed], names=schema.names)

    return nodes.mapInArrow(run, schema)


_EDGE = T.StructType(
    [T.StructField("u", T.LongType()), T.StructField("v", T.LongType()), T.StructField("near", T.FloatType())]
)


def _edges(u: np.ndarray, v: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(u), pa.array(v), pa.array(near.astype(np.float32))], names=_EDGE.names
    )


def _ordered_codes(points: DataFrame, settings: Graph) -> DataFrame:
    """``table, code, node, half``: each node in every order."""
    schema = T.StructType(
        [T.StructField(name, T.LongType()) for name in ("table", "code", "node")]
        + [T.StructField("half", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            vectors = _unpacked(batch.column("half"), np.float16)
            if not len(vectors):
                continue
            if planes is None:
                draw = np.random.default_rng(settings.seed)
                planes = draw.standard_normal((settings.orders, vectors.shape[1], BITS)).astype(np.float32)
            for table, plane in enumerate(planes):
                code = (vectors @ plane > 0) @ (np.int64(1) << np.arange(BITS, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(code), table)), pa.array(code), batch.column("node"), batch.column("half")],
                    names=schema.names,
                )

    return points.select("node", "half").mapInArrow(run, schema)


def _block_edges(node: np.ndarray, vectors: np.ndarray, first: int) -> pa.RecordBatch | None:
    """Each node's nearest inside a block."""
    if len(node) < 2:
        return None
    near = vectors @ vectors.T
    np.fill_diagonal(near, _BEST)
    k = min(first, len(node) - 1)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return _edges(np.repeat(node, k), node[best].ravel(), np.take_along_axis(near, best, axis=1).ravel())


def first_lists(points: DataFrame, settings: Graph) -> DataFrame:
    """``u, v, near``: neighbours by blocks of several random orders."""
    coded = _ordered_codes(points, settings)
    dealt = coded.repartitionByRange(_parts(points), "table", "code", "node").sortWithinPartitions(
        "table", "code", "node"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        rows = 0

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, rows
            whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            table, node = _columns(whole, "table", "node")
            vectors = _unpacked(whole.column("half"), np.float16)
            at = 0
            while at < rows:
                to = min(at + settings.block, int(np.searchsorted(table, table[at], "right")))
                if to == rows and not last:
                    break
                found = _block_edges(node[at:to], vectors[at:to], settings.first)
                if found is not None:
                    yield found
                at = to
            kept, rows = ([whole.slice(at)], rows - at) if at < rows else ([], 0)

        for batch in batches:
            if batch.num_rows:
                kept.append(batch)
                rows += batch.num_rows
                if rows > 8 * settings.block:
                    yield from blocks(False)
        if kept:
            yield from blocks(True)

    return dealt.mapInArrow(run, _EDGE)


def _best(edges: DataFrame, by: str, other: str, n: int) -> DataFrame:
    """The n nearest of each ``by``; the choice starts in each task, before the shuffle."""
    order = Window.partitionBy(by).orderBy(F.col("near").desc(), other)
    return edges.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n).drop("_place")


def _merged(edges: DataFrame, n: int) -> DataFrame:
    """``u, v, near, fresh``: the best of each list, an entry once; known entries are not fresh."""
    once = edges.groupBy("u", "v").agg(F.max("near").alias("near"), F.min("fresh").alias("fresh"))
    return _best(once, "u", "v", n)


_MEMBER = ("pivot", "node", "fresh", "worst", "half")


def _local_join(members: DataFrame) -> DataFrame:
    """Pairs of a pivot's members of which one is fresh, where they better a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "pivot"):
            pivot, node, fresh, worst = _columns(batch, *_MEMBER[:4])
            vectors = _unpacked(batch.column("half"), np.float16)
            starts = np.flatnonzero(np.concatenate([[True], pivot[1:] != pivot[:-1]]))
            ends = np.append(starts[1:], len(pivot))
            for at in range(0, len(starts), GROUPS):
                start, end = starts[at : at + GROUPS], ends[at : at + GROUPS]
                size = int((end - start).max())
                place = start[:, None] + np.arange(size)
                real = place < end[:, None]
                place = np.minimum(place, len(pivot) - 1)
                own = vectors[place]
                near = own @ own.transpose(0, 2, 1)
                new = fresh[place] & real
                good = near > worst[place][:, :, None]
                good &= new[:, :, None] | new[:, None, :]
                good &= real[:, :, None] & real[:, None, :]
                good[:, np.arange(size), np.arange(size)] = False
                group, i, j = np.nonzero(good)
                if len(group):
                    u, v = node[place[group, i]], node[place[group, j]]
                    order = np.lexsort((v, u))
                    u, v, found = u[order], v[order], near[group, i, j][order]
                    single = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
                    yield _edges(u[single], v[single], found[single])

    return members.mapInArrow(run, _EDGE)


def descend(lists: DataFrame, points: DataFrame, settings: Graph) -> DataFrame:
    """One round: neighbours of neighbours, both ways, into the lists."""
    k = settings.neighbours
    worst = lists.groupBy("u").agg(
        F.when(F.count("*") >= k, F.min("near")).otherwise(F.lit(_BEST)).cast("float").alias("worst")
    )
    known = stored(
        points.select("node", "half").join(worst, F.col("node") == F.col("u")).select("node", "worst", "half"), "known"
    )
    naming = _best(lists, "v", "u", k).select(F.col("v").alias("pivot"), F.col("u").alias("member"), "fresh")
    members = (
        lists.select(F.col("u").alias("pivot"), F.col("v").alias("member"), "fresh")
        .unionByName(naming)
        .groupBy("pivot", "member")
        .agg(F.max("fresh").alias("fresh"))
    )
    carried = members.join(known, F.col("member") == F.col("node")).select(*_MEMBER)
    dealt = carried.repartition("pivot").sortWithinPartitions("pivot", "node")
    found = _local_join(dealt).withColumn("fresh", F.lit(True))
    back = lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "near", F.lit(True).alias("fresh"))
    old = lists.withColumn("fresh", F.lit(False))
    return stored(_merged(old.unionByName(back).unionByName(found), k), "lists")


def neighbour_graph(points: DataFrame, settings: Graph | None = None) -> DataFrame:
    """``u, v, near, fresh``: the nearest found of each node (``points``: ``node, half``)."""
    settings = settings or Graph()
    found = first_lists(points, settings).withColumn("fresh", F.lit(True))
    lists = stored(_merged(found, settings.neighbours), "lists")
    for turn in range(settings.most_rounds):
        lists = descend(lists, points, settings)
        share = lists.agg(F.avg(F.col("fresh").cast("int")).alias("share")).first()["share"] or 0.0
        log.info("round %d of NN-descent: %.3f of the entries are new", turn + 1, share)
        if share <= settings.settled:
            return lists
    log.warning("NN-descent ends after %d rounds with lists that still change", settings.most_rounds)
    return lists


_BEAM = T.StructType(
    [
        T.StructField("query", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("near", T.FloatType()),
        T.StructField("fresh", T.BooleanType()),
    ]
)


def _next_beams(scored: DataFrame, beam: int) -> DataFrame:
    """Beams with the candidates in them; rows of kind 0 carry the query's own vector."""
    dealt = scored.repartition("query").sortWithinPartitions("query", "kind", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "query"):
            query, kind, node = _columns(batch, "query", "kind", "node")
            near = batch.column("near").fill_null(0.0).to_numpy(zero_copy_only=False).copy()
            starts = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]]))
            ends = np.append(starts[1:], len(query))
            unit = batch.column("unit")
            chosen = []
            for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
                first = int(np.searchsorted(kind[start:end], 2)) + start
                if first < end:
                    # Less the squared distance: the order of cosines, and finer among near copies.
                    apart = _unpacked(unit.slice(first, end - first), np.float32)
                    apart -= _unpacked(unit.slice(start, 1), np.float32)
                    near[first:end] = -np.einsum("ij,ij->i", apart, apart)
                rows = np.arange(start + 1, end)
                order = np.lexsort((node[rows], -near[rows]))[:beam]
                chosen.append(rows[order])
            rows = np.concatenate(chosen)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[rows]), pa.array(node[rows]), pa.array(near[rows]), pa.array(kind[rows] == 2)],
                names=_BEAM.names,
            )

    return dealt.select("query", "kind", "node", "near", "unit").mapInArrow(run, _BEAM)


def greedy_search(queries: DataFrame, lists: DataFrame, points: DataFrame, settings: Graph | None = None) -> DataFrame:
    """``query, node, near``: the best nodes seen from each query (``queries``: ``node``), itself included.

    ``near`` is less the squared distance of the unit vectors, in single precision.
    """
    settings = settings or Graph()
    k = settings.neighbours
    naming = _best(lists, "v", "u", k).select(F.col("v").alias("u"), F.col("u").alias("v"))
    near_nodes = stored(
        lists.select("u", "v").unionByName(naming).groupBy("u").agg(F.collect_set("v").alias("around")), "around"
    )
    units = points.select("node", "unit")
    starts = stored(queries.join(units, "node").select(F.col("node").alias("query"), "unit"), "queries")
    beams = stored(
        starts.select(
            "query", F.col("query").alias("node"), F.lit(0.0).cast("float").alias("near"), F.lit(True).alias("fresh")
        ),
        "beams",
    )
    seen = beams.select("query", "node")
    nothing = F.lit(None).cast("binary")
    own = starts.select(
        "query", F.lit(0).alias("kind"), F.lit(-1).cast("bigint").alias("node"), F.lit(None).cast("float").alias("near"), "unit"
    )
    while not beams.where("fresh").isEmpty():
        front = beams.where("fresh").select("query", F.col("node").alias("u"))
        reached = front.join(near_nodes, "u").select("query", F.explode("around").alias("node")).distinct()
        new = stored(reached.join(seen, ["query", "node"], "left_anti"), "reached")
        seen = seen.unionByName(new)
        candidates = new.join(units, "node").select(
            "query", F.lit(2).alias("kind"), "node", F.lit(None).cast("float").alias("near"), "unit"
        )
        held = beams.select("query", F.lit(1).alias("kind"), "node", "near", nothing.alias("unit"))
        beams = stored(_next_beams(own.unionByName(held).unionByName(candidates), settings.beam), "beams")
    return beams.select("query", "node", "near")


def _cosines(pairs: DataFrame) -> Column:
    """Cosine in double precision of the columns ``left`` and ``right``."""

    @F.arrow_udf("double")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.float64())
        a, b = (
            _scaled(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)) for x in (left, right)
        )
        dot, aa, bb = ((x * y).sum(axis=1) for x, y in ((a, b), (a, a), (b, b)))
        return pa.array(dot / (np.sqrt(aa) * np.sqrt(bb)))

    return run("left", "right")


def nearest_neighbours(
    rows: DataFrame,
    is_query: Column,
    n: int = 5,
    settings: Graph | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the n nearest found of each query among all other rows.

    ``is_query`` is a condition on ``vec_id``.
    """
    settings = settings or Graph()
    vectors = usable_vectors(rows, id_column, vector_column)
    nodes = stored(vectors.groupBy("vector").agg(F.min("vec_id").alias("node")), "nodes")
    points = stored(_unit_vectors(nodes), "points")
    # Of a family of equal vectors the least ids can be anyone's nearest, one more than asked for.
    order = Window.partitionBy("vector").orderBy("vec_id")
    least = vectors.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n + 1)
    members = stored(
        least.groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.element_at("ids", 1).alias("node"), "ids", "vector"),
        "members",
    )
    asked = stored(
        vectors.where(is_query).join(nodes, "vector").select(F.col("vec_id").alias("query_id"), "node"), "asked"
    )
    lists = neighbour_graph(points, settings)
    found = greedy_search(asked.select("node").distinct(), lists, points, settings)
    pairs = (
        found.join(members, "node")
        .select("query", "ids", F.col("vector").alias("right"))
        .join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("left")), "query")
    )
    scored = pairs.select("query", "ids", _cosines(pairs).alias("score")).select(
        "query", F.explode("ids").alias("vec_id"), "score"
    )
    # A beam of candidates with n + 1 ids each meets here, and the answers of a node are n + 1 rows.
    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    answers = (
        scored.withColumn("_place", F.row_number().over(ranked))
        .where(F.col("_place") <= n + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("_place", "vec_id", "score"))).alias("answers"))
    )
    answers = stored(answers, "answers")
    others = F.slice(F.filter("answers", lambda answer: answer["vec_id"] != F.col("query_id")), 1, n)
    return (
        asked.join(answers, F.col("node") == F.col("query"))
        .select("query_id", F.posexplode(others).alias("at", "answer"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("answer.vec_id"), F.col("answer.score"))
    )
