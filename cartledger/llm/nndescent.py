"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

The graph starts from random-projection trees, whose leaves are compared within; they are fitted
on a sample and split on over the whole table until none is overfull. Each round
then joins every node with its neighbours and those that have it as neighbour, compares
these among each other, and keeps each node's best: neighbours of neighbours are likely
neighbours. A search walks the graph from the query's own leaf, always on from the best
nodes seen, a hundred or so a hop for all queries at once, until the best it remembers are all
expanded. Both work on whole numbers of about 23 bits a component, as fine as single precision,
so that close copies are told apart; of what a walk remembers, all that can be among the
nearest, by the bound of that rounding, is measured again in double precision on the vectors
themselves. A query whose walk met too few is compared with all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window, functions as F

from cartledger.llm.common import quoted, stored
from cartledger.llm.vectors import distinct_vectors, matrix, usable

NEIGHBOURS = 20
#: Those that have a node as neighbour, of which so many take part in a round and a search.
REVERSE = 20
TREES, LEAF, FROM_TREE = 12, 512, NEIGHBOURS + 1
#: Vectors that the trees are fitted on, about, and of these in the smallest leaf.
SAMPLE, SAMPLE_LEAF = 16_384, 32
#: Rounds end when less than this share of the neighbours is new. The likeness tells nothing
#: of that among close copies, where it is nearly 1 from the start.
CHANGES = 0.1
#: Partners that a node may win from one neighbourhood.
WINS = 8
#: Best nodes that a search remembers, and expands in a hop.
WIDTH, EXPAND = 320, 320
#: Nodes whose vectors are looked up together.
BLOCK = 2_048
#: Queries that are compared with all vectors in one pass.
SCANNED = 1_024
SEED = 5


# Whole numbers, after a scale of eight bytes


def code_bits(d: int) -> int:
    """As many bits as sums of products of ``d`` numbers in double precision hold exactly."""
    return (53 - int(np.ceil(np.log2(max(d, 2))))) // 2


def encode(x: np.ndarray) -> list[bytes]:
    bits = code_bits(x.shape[1])
    scale = np.maximum(np.abs(x).max(1), 1e-300) / (2**bits - 1)
    codes = np.rint(x / scale[:, None]).astype("<i4")
    return [s.tobytes() + c.tobytes() for s, c in zip(scale.astype("<f8"), codes)]


def decode(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers and scales. Sums of products are exact, in any order."""
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)
    scale = np.ascontiguousarray(raw[:, :8]).view("<f8")[:, 0]
    return np.ascontiguousarray(raw[:, 8:]).view("<i4").astype(np.float64), scale


def _likeness(a, b) -> np.ndarray:
    """Inner products of two decoded sets; equal for (i, j) and (j, i)."""
    return (a[0] @ b[0].T) * (a[1][:, None] * b[1][None, :])


# Trees


@dataclass
class Tree:
    """Node i splits on x @ normal[i] > cut[i] to 2 i + 2, else to 2 i + 1; levels of all leaves."""

    levels: int
    normals: np.ndarray
    cuts: np.ndarray

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(self.levels):
            right = np.einsum("ij,ij->i", x, self.normals[at]) > self.cuts[at]
            at = 2 * at + 1 + right
        return at


def grow(sample: np.ndarray, levels: int, seed: int) -> Tree:
    """Splits at the median along the difference of two random members."""
    random = np.random.default_rng(seed)
    n, d = (1 << levels) - 1, sample.shape[1]
    tree = Tree(levels, np.zeros((n, d)), np.zeros(n))
    parts = {0: np.arange(len(sample))}
    for i in range(n):
        own = parts.pop(i, np.empty(0, int))
        if len(own) > 1:
            a, b = random.choice(own, 2, replace=False)
            tree.normals[i] = sample[a] - sample[b]
            along = sample[own] @ tree.normals[i]
            tree.cuts[i] = np.median(along)
            right = along > tree.cuts[i]
        else:
            right = np.zeros(len(own), bool)
        parts[2 * i + 1], parts[2 * i + 2] = own[~right], own[right]
    return tree


def _leaves(nodes: DataFrame, trees: list[Tree], further: int = 0) -> DataFrame:
    """(tree, leaf, node, along) of the nodes (node, vec) in each tree; ``along`` are their places
    along ``further`` random directions, the same for all nodes of a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * further)
            for t, tree in enumerate(trees):
                directions = np.random.default_rng([SEED, t]).standard_normal((x.shape[1], further))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), t, np.int32)), pa.array(tree.leaf(x)), batch.column(0),
                        pa.ListArray.from_arrays(ends, pa.array((x @ directions).ravel())),
                    ],
                    names=["tree", "leaf", "node", "along"],
                )

    return nodes.select("node", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(
        run, "tree int, leaf long, node long, along array<double>"
    )


def _parts(nodes: DataFrame, trees: list[Tree]) -> DataFrame:
    """(tree, leaf, node) of every node in each tree, no leaf over 2 * LEAF nodes.

    The trees are fitted on a bounded sample, so their leaves grow with the table. Overfull ones
    are split on at the median of their nodes along a random direction, level by level, all leaves
    of a level in one grouped pass. What no direction tells apart in double precision is dealt by
    hash at last.
    """
    by = ["tree", "leaf"]
    leaves = stored(_leaves(nodes, trees).drop("along"), "leaves")
    largest = leaves.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if largest <= 2 * LEAF:
        return leaves
    # Medians are approximate: a level more than halves would need.
    further = (-(-largest // (2 * LEAF)) - 1).bit_length() + 1
    leaves = stored(_leaves(nodes, trees, further), "leaves")
    for level in range(further):
        place = F.col("along")[level]
        cuts = leaves.groupBy(*by).agg(
            F.count("*").alias("size"), F.percentile_approx(place, 0.5, 200).alias("cut")
        ).where(F.col("size") > 2 * LEAF).drop("size")
        below = 2 * F.col("leaf") + 1 + (place > F.col("cut")).cast("long")
        leaves = stored(
            leaves.join(cuts, by, "left").select(
                "tree", F.coalesce(below, "leaf").alias("leaf"), "node", "along"
            ),
            "leaves",
        )
    sizes = leaves.groupBy(*by).agg(F.ceil(F.count("*") / (2 * LEAF)).alias("parts")).where("parts > 1")
    # A part's number is negative, so that it is no leaf's.
    part = -1 - F.pmod(F.xxhash64("node", "tree"), "parts") - F.col("leaf") * F.lit(1 << 20)
    return leaves.join(sizes, by, "left").select("tree", F.coalesce(part, "leaf").alias("leaf"), "node")


def _best(node: np.ndarray, likeness: np.ndarray, most: int):
    """(row, column, value) of each row's best columns but itself."""
    np.fill_diagonal(likeness, -np.inf)
    k = min(most, len(node) - 1)
    if k < 1:
        return None
    top = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(likeness, top, 1)
    return node.repeat(k), node[top.ravel()], value.ravel()


_EDGE = "node long, other long, like double"


def _edges(found) -> Iterator[pa.RecordBatch]:
    found = [f for f in found if f is not None and len(f[0])]
    if found:
        node, other, like = (np.concatenate(c) for c in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(other), pa.array(like.astype(np.float64))], names=["node", "other", "like"]
        )


def _first_edges(nodes: DataFrame, trees: list[Tree]) -> DataFrame:
    """Each node's best in its leaf of each tree."""
    groups = _parts(nodes, trees).join(nodes.select("node", "code"), "node").groupBy("tree", "leaf")

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        code = decode(table.column("code").to_pylist())
        rows = list(_edges([_best(node, _likeness(code, code), FROM_TREE)]))
        return pa.Table.from_batches(rows) if rows else pa.table(
            {"node": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "like": pa.array([], pa.float64())}
        )

    return groups.applyInArrow(run, _EDGE)


def _kept(edges: DataFrame) -> DataFrame:
    """Each node's best edges, each once. Equal pairs have equal likeness, so a dense rank
    counts different partners, and tasks drop what cannot win before they send it."""
    rank = F.dense_rank().over(Window.partitionBy("node").orderBy(F.desc("like"), "other"))
    return edges.withColumn("rank", rank).where(F.col("rank") <= NEIGHBOURS).select(
        "node", "other", "like"
    ).distinct()


def _around(edges: DataFrame, turn: int) -> DataFrame:
    """(at, member, like): a node's neighbours, and some of those that have it as neighbour."""
    back = edges.select(F.col("other").alias("at"), F.col("node").alias("member"), "like")
    # Which of very many is up to a hash, so a node that many have as neighbour sends few a task.
    some = F.row_number().over(
        Window.partitionBy("at").orderBy(F.xxhash64("member", F.lit(turn)))
    )
    back = back.withColumn("rank", some).where(F.col("rank") <= REVERSE).drop("rank")
    return edges.toDF("at", "member", "like").union(back)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in short parts: a row holds the numbers of a whole neighbourhood."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _round(edges: DataFrame, fresh: DataFrame | None, codes: DataFrame, turn: int) -> DataFrame:
    """The edges after one round of comparing the members of each neighbourhood.

    ``fresh`` (node, other) are the edges that the last round found. Only neighbourhoods that such
    an edge touches have pairs that were not compared before.
    """
    # A list that is not full takes any.
    full = F.when(F.count("*") >= NEIGHBOURS, F.min("like")).otherwise(F.lit(float("-inf")))
    worst = edges.groupBy("node").agg(full.alias("worst"))
    members = codes.join(worst, "node").select(F.col("node").alias("member"), "code", "worst")
    around = whole = _around(edges, turn)
    if fresh is not None:
        touched = fresh.select(F.explode(F.array("node", "other")).alias("at")).distinct()
        around = whole.join(touched, "at", "left_semi")
    met = around.join(members, "member").groupBy("at").agg(
        F.collect_list(F.struct("member", "code", "worst")).alias("met")  # NEIGHBOURS + REVERSE at most
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten()
            member, worst_ = flat.field(0).to_numpy(), flat.field(2).to_numpy()
            codes_ = flat.field(1).to_pylist()
            found = []
            for a, b in zip(bounds, bounds[1:]):
                own, first = np.unique(member[a:b], return_index=True)
                if len(own) < 2:
                    continue
                code = decode([codes_[a + i] for i in first])
                best = _best(own, _likeness(code, code), WINS)
                better = best[2] > worst_[a:b][first].repeat(len(best[0]) // len(own))
                found.append(tuple(c[better] for c in best))
            yield from _edges(found)

    new = met.mapInArrow(run, _EDGE)
    return _kept(whole.toDF("node", "other", "like").union(new))


@dataclass
class Index:
    """Vectors (node, code, vec), members (node, id), and the graph (node, other, like)."""

    nodes: DataFrame
    members: DataFrame
    edges: DataFrame


def build(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> Index:
    """An index of all usable rows; equal vectors are one node.

    Vectors that are null, empty, zero or not finite are left out. All others must be of
    one length.
    """
    given = rows.select(quoted(key).alias("id"), quoted(vector).alias("vec")).where(usable(quoted("vec")))
    marked = stored(distinct_vectors(given, "vec"), "marked")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                code = pa.array(encode(matrix(batch.column(1))), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), code], names=["node", "vec", "code"])

    distinct = marked.groupBy("node").agg(F.any_value("vec").alias("vec"))
    nodes = distinct.mapInArrow(coded, distinct.select("node", "vec").schema.add("code", "binary"))
    nodes = stored(nodes, "nodes")
    n = nodes.count()
    drawn = nodes if n <= SAMPLE else nodes.where(
        F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(1_000_000 * SAMPLE / n)
    )
    sample = drawn.orderBy("node").select(F.col("vec").cast("array<double>").alias("vec")).toArrow()
    x = matrix(sample.column("vec").combine_chunks()) if sample.num_rows else np.empty((0, 0))
    levels = 0
    while n >> levels > LEAF and len(x) >> levels > SAMPLE_LEAF:
        levels += 1
    trees = [grow(x, levels, SEED + t) for t in range(TREES if levels else 1)] if len(x) else []
    edges = stored(_kept(_first_edges(nodes, trees)), "edges") if trees else stored(
        nodes.select("node", F.col("node").alias("other"), F.lit(0.0).alias("like")), "edges"
    )
    codes = nodes.select("node", "code")
    turn, fresh = 0, None
    while n > 1:
        before, edges = edges, stored(_round(edges, fresh, codes, turn), "edges")
        fresh = stored(edges.join(before, ["node", "other"], "left_anti").select("node", "other"), "fresh")
        if fresh.count() < CHANGES * edges.count():
            break
        turn += 1
    return Index(nodes, marked.select("node", "id"), edges)


def _advance(states: DataFrame, found: DataFrame | None) -> DataFrame:
    """Search states (query, code, ids, likes, done, front) with what the last hop found."""
    if found is None:
        joined = states.withColumn("found", F.lit(None).cast("array<struct<ids:array<long>,likes:array<double>>>"))
    else:
        lists = found.groupBy("query").agg(F.collect_list(F.struct("ids", "likes")).alias("found"))
        joined = states.drop("front").join(lists, "query", "left")
    schema = "query long, code binary, ids array<long>, likes array<double>, done array<boolean>, front array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("ids", "likes", "done", "front")}
            for ids, likes, done, found_ in zip(*(batch.column(i) for i in (2, 3, 4, 5))):
                parts = [(ids.values.to_numpy(), likes.values.to_numpy(), done.values.to_numpy(zero_copy_only=False))]
                if found_.is_valid:
                    inner = found_.values
                    new = inner.field(0).flatten().to_numpy()
                    parts.append((new, inner.field(1).flatten().to_numpy(), np.zeros(len(new), bool)))
                i, l, d = (np.concatenate(c) for c in zip(*parts))
                # Known nodes stand first, so they keep their mark; likeness is the same in all copies.
                _, first = np.unique(i, return_index=True)
                order = first[np.lexsort((i[first], -l[first]))][:WIDTH]
                i, l, d = i[order], l[order], d[order]
                ahead = np.flatnonzero(~d)[:EXPAND]
                d[ahead] = True
                for k, v in zip(out, (i, l, d, i[ahead])):
                    out[k].append(v)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array(out["ids"], pa.list_(pa.int64())), pa.array(out["likes"], pa.list_(pa.float64())),
                    pa.array(out["done"], pa.list_(pa.bool_())), pa.array(out["front"], pa.list_(pa.int64())),
                ],
                names=["query", "code", *out],
            )

    return joined.select("query", "code", "ids", "likes", "done", "found").mapInArrow(run, schema)


def _dealt(wanted: DataFrame, blocks: int) -> DataFrame:
    """(query, block, code, members): of the nodes in the lists ``met`` those not among ``ids``,
    each once, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, block, sizes, members = [], [], [], []
            for i, (ids, met) in enumerate(zip(batch.column(2), batch.column(3))):
                new = np.setdiff1d(met.values.flatten().to_numpy(), ids.values.to_numpy())
                own = np.mod(new, blocks)
                members.append(new[np.argsort(own, kind="stable")])
                own, size = np.unique(own, return_counts=True)
                rows.append(np.full(len(own), i))
                block.append(own)
                sizes.append(size)
            if members:
                rows = pa.array(np.concatenate(rows))
                ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), pa.array(np.concatenate(block)), batch.column(1).take(rows),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(members))),
                    ],
                    names=["query", "block", "code", "members"],
                )

    return wanted.select("query", "code", "ids", "met").mapInArrow(
        run, "query long, block long, code binary, members array<long>"
    )


def _looked_up(wanted: DataFrame, codes: DataFrame, blocks: int) -> DataFrame:
    """(query, ids, likes) of the nodes that queries (query, code, ids, met) want.

    Nodes, whose numbers are hashes, are dealt into blocks, and a query asks each block once, with
    its vector and the nodes it wants there, so vectors travel once a block and not once a query
    and node.
    """
    asked = _dealt(wanted, blocks)
    block = F.pmod("node", F.lit(blocks).cast("long")).alias("block")

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        node = right.column("node").to_numpy()
        vectors, scale = decode(right.column("code").to_pylist()) if len(node) else (np.empty((0, 0)), np.empty(0))
        order = np.argsort(node)
        likes = []
        members = left.column("members").combine_chunks() if left.num_rows else None
        for i, code in enumerate(left.column("code").to_pylist()):
            at = order[np.searchsorted(node, members[i].values.to_numpy(), sorter=order)]
            own = decode([code])
            likes.append((vectors[at] @ own[0][0]) * (scale[at] * own[1][0]))
        return pa.table({
            "query": left.column("query"), "ids": left.column("members").cast(pa.list_(pa.int64())),
            "likes": pa.array(likes, pa.list_(pa.float64())),
        })

    return asked.groupBy("block").cogroup(codes.select("node", "code", block).groupBy("block")).applyInArrow(
        look, "query long, ids array<long>, likes array<double>"
    )


def _kept_states(states: DataFrame) -> tuple[DataFrame, bool]:
    """The states as a stored table, and whether any walk goes on; the write itself tells."""
    seen = Observation()
    kept = stored(states.observe(seen, F.count_if(F.size("front") > 0).alias("going")), "walk")
    return kept, seen.get["going"] > 0


def _walk(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query, other): what can be among the ``k`` nearest of those that a walk from each query node finds."""
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    codes = index.nodes.select("node", "code")
    n = codes.count()
    blocks = max(-(-n // BLOCK), min(tasks, -(-n // (BLOCK // 8))), 1)
    pair = F.struct("member", "like")  # equal in both directions
    graph = stored(
        _around(index.edges, 0).groupBy("at").agg(F.collect_set(pair).alias("near"))
        .select("at", F.col("near.member").alias("members"), F.col("near.like").alias("likes")),
        "graph",
    )
    # A query's own neighbours are known with their likeness; it stands first itself, without one.
    near = F.filter(F.arrays_zip("members", "likes"), lambda p: p["members"] != F.col("node"))
    near = F.coalesce(near, F.array().cast("array<struct<members:long,likes:double>>"))
    start = queries.join(codes, "node").join(graph, F.col("node") == F.col("at"), "left").withColumn("near", near).select(
        F.col("node").alias("query"), "code",
        F.concat(F.array("node"), "near.members").alias("ids"),
        F.concat(F.array(F.lit(float("inf"))), "near.likes").alias("likes"),
        F.concat(F.array(F.lit(True)), F.transform("near", lambda p: F.lit(False))).alias("done"),
    )
    states, going = _kept_states(_advance(start, None))
    while going:
        ahead = states.where(F.size("front") > 0)
        near = ahead.select("query", F.explode("front").alias("at")).join(graph.select("at", "members"), "at")
        met = near.groupBy("query").agg(F.collect_list("members").alias("met"))
        # ``EXPAND`` lists of ``NEIGHBOURS`` + ``REVERSE`` at most
        wanted = ahead.join(met, "query")
        states, going = _kept_states(_advance(states, _looked_up(wanted, codes, blocks)))
    # How far a likeness may be off, by half a unit in each component of both vectors.
    d, top = index.nodes.agg(
        F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double")))))
    ).first()
    slack = 2.0 * (d or 1) * (top or 0.0) ** 2 / (2 ** code_bits(d or 1) - 1)
    last = F.element_at("likes", F.least(F.lit(k + 1), F.size("likes")))
    pairs = F.arrays_zip(F.col("ids").alias("id"), F.col("likes").alias("like"))
    return states.select("query", F.explode(F.filter(pairs, lambda p: p["like"] >= last - slack)).alias("p")).select(
        "query", F.col("p.id").alias("other")
    )


def search(index: Index, queries: DataFrame, k: int, key: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for each indexed id in ``queries``.

    Nearness is the inner product in double precision; ties go to the smaller id, nulls
    last. A query is no candidate of its own, its copies are; with fewer candidates all
    are returned. Ids that the index left out find nothing.
    """
    asked = stored(
        queries.select(quoted(key).alias("query_id")).join(
            index.members, F.col("query_id") == F.col("id")
        ).select("query_id", "node").distinct(),
        "asked",
    )
    found = stored(_nearest(index, asked, _walk(index, asked.select("node").distinct(), k), k), "found")
    # A walk that ends inside a small group may have met fewer than there are.
    full = found.groupBy("query_id").count().where(F.col("count") >= k)
    short = stored(asked.join(full, "query_id", "left_anti"), "short")
    if not short.isEmpty():
        more = _nearest(index, short, _scanned(index, short.select("node").distinct(), k), k)
        found = found.join(short.select("query_id").distinct(), "query_id", "left_anti").union(more)
    return found


def _scanned(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """(query, other): the best nodes of all for each query node (node), block by block."""
    vectors = index.nodes.select("node", F.col("vec").cast("array<double>").alias("vec"))
    rows = queries.join(vectors, "node").toLocalIterator()
    parts = []
    while block := list(islice(rows, SCANNED)):
        ids, q = np.array([r["node"] for r in block]), np.array([r["vec"] for r in block], float)

        def best(batches: Iterator[pa.RecordBatch], ids=ids, q=q) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    scores = q @ matrix(batch.column(1)).T
                    n = min(k + 1, batch.num_rows)
                    top = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids.repeat(n)), pa.array(batch.column(0).to_numpy()[top.ravel()]),
                            pa.array(np.take_along_axis(scores, top, 1).ravel()),
                        ],
                        names=["query", "other", "like"],
                    )

        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("like"), "other"))
        seen = vectors.mapInArrow(best, "query long, other long, like double")
        parts.append(stored(seen.withColumn("place", place).where(F.col("place") <= k + 1).drop("place", "like"), "scanned"))
    return reduce(DataFrame.union, parts)


def _nearest(index: Index, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The rows of ``search`` for ``asked`` (query_id, node) among ``pairs`` (query, other)."""
    vectors = index.nodes.select("node", "vec")
    product = F.aggregate(
        F.zip_with("a", "b", lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda s, x: s + x,
    )
    scored = (
        pairs.join(vectors.select(F.col("node").alias("other"), F.col("vec").alias("b")), "other")
        .join(vectors.select(F.col("node").alias("query"), F.col("vec").alias("a")), "query")
        .select("query", "other", product.alias("score"))
    )
    # Of many copies only the first can be among the nearest; one more for the query itself.
    copy = F.row_number().over(Window.partitionBy("node").orderBy(F.col("id").asc_nulls_last()))
    first = index.members.withColumn("copy", copy).where(F.col("copy") <= k + 1).select(
        F.col("node").alias("other"), F.col("id").alias("vec_id")
    )
    near = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    )
    by_node = F.dense_rank().over(Window.partitionBy("query").orderBy(F.desc("score"), "other"))
    best = scored.withColumn("place", by_node).where(F.col("place") <= k + 1).drop("place")
    return (
        best.join(first, "other")
        .join(asked.withColumnRenamed("node", "query"), "query")
        .where(~F.col("vec_id").eqNullSafe(F.col("query_id")))
        .withColumn("rank", near)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def recall(index: Index, found: DataFrame, k: int, queries: int = 200) -> float:
    """Share of the true ``k`` nearest that ``found`` holds, over about so many of its queries.

    The sampled queries' vectors are compared with all vectors, each task with its own.
    """
    vectors = index.members.join(index.nodes.select("node", "vec"), "node")
    asked = found.select("query_id").distinct()
    n = asked.count()
    if not n:
        return 1.0
    asked = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(1_000_000)) <= int(1_000_000 * queries / n))
    sample = vectors.join(asked, F.col("id") == F.col("query_id")).select(
        "query_id", F.col("vec").cast("array<double>").alias("vec")
    ).dropDuplicates(["query_id"]).toPandas()  # a bounded sample
    if not len(sample):
        return 1.0
    ids, q = sample["query_id"].to_numpy(), np.array(sample["vec"].tolist(), float)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = q @ matrix(batch.column(1)).T
            own = batch.column(0).to_numpy(zero_copy_only=False)
            scores[ids[:, None] == own[None, :]] = -np.inf
            top = np.argsort(-scores, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids.repeat(top.shape[1])), pa.array(own[top.ravel()]),
                    pa.array(np.take_along_axis(scores, top, 1).ravel()),
                ],
                names=["query_id", "vec_id", "score"],
            )

    candidates = vectors.select("id", F.col("vec").cast("array<double>").alias("vec")).mapInArrow(
        best, "query_id long, vec_id long, score double"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    true = candidates.where("score > double('-inf')").withColumn("place", place).where(F.col("place") <= k)
    hits = true.join(found, ["query_id", "vec_id"], "left_semi").count()
    return hits / true.count()
