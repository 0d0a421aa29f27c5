"""Near copies among embeddings by cross-polytope hashing.

A fast rotation (three rounds of random signs and a Hadamard transform) carries a vector
to the nearest vertex of the cross-polytope: the axis of its largest coordinate, with the
sign. A table joins a few such hashes into a bucket; each vector also enters the buckets
that it nearly fell into, one hash changed to its second-best axis. Vectors that share a
bucket are compared, in blocks where a bucket is large, and a pair is counted only in the
first of the buckets it shares. Blocks return sums and spanning links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import FloatType

from cartledger.llm.common import quoted, stored
from cartledger.llm.graph import components
from cartledger.llm.vectors import distinct_vectors, doubles, matrix, packed, scaled, unpacked, usable

SIMILARITY = 0.98
#: At 0.98 in 64 dimensions a table of two hashes with three buckets a vector finds 93 % of
#: pairs, so four tables miss about 2 in 100,000.
TABLES = {1: 3, 2: 4, 3: 6, 4: 8}
ROUNDS = 3
#: Vectors of a bucket in one block, and expected in a bucket of chance neighbours.
BLOCK = 2048
CROWD = 32
SEED = 11


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row, of a power of two long, kept at its length."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, width // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([a + b, a - b], 2).reshape(n, width)
        half *= 2
    return rows / math.sqrt(width)


def bucket_keys(x: np.ndarray, tables: int, hashes: int) -> np.ndarray:
    """(rows, tables, 1 + hashes) bucket numbers; the first of a table is the vector's own."""
    n, d = x.shape
    width = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = x
    random = np.random.default_rng(SEED)
    out = np.empty((n, tables, 1 + hashes), np.int64)
    row = np.arange(n)
    for t in range(tables):
        best, second = [], []
        for _ in range(hashes):
            turned = padded
            for _ in range(ROUNDS):
                turned = hadamard(turned * random.choice((-1.0, 1.0), width))
            size = np.abs(turned)
            first = size.argmax(1)
            best.append(first * 2 + (turned[row, first] > 0))
            size[row, first] = -1
            next_ = size.argmax(1)
            second.append(next_ * 2 + (turned[row, next_] > 0))
        for s in range(1 + hashes):
            key = np.full(n, t, np.int64)
            for h in range(hashes):
                key = key * (2 * width) + (second[h] if s == h + 1 else best[h])
            out[:, t, s] = key
    return out


def _first_shared(keys_a: np.ndarray, keys_b: np.ndarray) -> np.ndarray:
    """The smallest number that two rows of numbers share, row by row."""
    none = np.iinfo(np.int64).max
    found = np.full(len(keys_a), none)
    for column in range(keys_a.shape[1]):
        a = keys_a[:, column]
        shared = (a[:, None] == keys_b).any(1)
        found = np.minimum(found, np.where(shared, a, none))
    return found


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that the links (a, b) connect it with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


class _Compare:
    """Compares the rows of groups that arrive one after the other."""

    def __init__(self, similarity: float):
        self.similarity = similarity

    def pairs(self, x: np.ndarray, side: np.ndarray, cross: bool):
        """Linked pairs of rows (a, b) of one group; across its two sides if ``cross``."""
        if cross:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        else:
            left = right = np.arange(len(x))
        found = []
        for start in range(0, len(left), 512):
            part = left[start : start + 512]
            a, b = np.nonzero(x[part] @ x[right].T >= self.similarity - 1e-9)
            a, b = part[a], right[b]
            keep = slice(None) if cross else a < b
            found.append((a[keep], b[keep]))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (left, right[:0])

    def group(self, bucket: int, node, copies, keys, x, length, side, cross):
        """(node, links, other): links of a node seen here first, and links that span."""
        unit = x / length[:, None]
        a, b = self.pairs(unit, side, cross)
        dot = np.einsum("ij,ij->i", x[a], x[b]) if len(a) else np.empty(0)
        linked = dot / (length[a] * length[b]) >= self.similarity
        a, b = a[linked], b[linked]
        if not len(a):
            return None
        here = np.empty(len(a), bool)
        for start in range(0, len(a), 1 << 18):
            cut = slice(start, start + (1 << 18))
            here[cut] = _first_shared(keys[a[cut]], keys[b[cut]]) == bucket
        links = np.bincount(a[here], copies[b[here]], len(x)) + np.bincount(
            b[here], copies[a[here]], len(x)
        )
        root = _local_roots(len(x), a, b)
        rows = (links > 0) | (root != np.arange(len(x)))
        return node[rows], links[rows].astype(np.int64), node[root[rows]]


def _compared(entries: DataFrame, similarity: float, kind: str) -> DataFrame:
    """(node, links, other) of entries dealt and sorted by group; vectors are of ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compare, carried = _Compare(similarity), None

        def emit(found):
            found = [f for f in found if f is not None]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*found)], names=["node", "links", "other"]
                )

        def groups(rows: pa.RecordBatch, last: bool):
            """Finished groups of the rows; the last one may go on in the next batch."""
            ids = np.stack([rows.column(i).to_numpy() for i in range(4)], 1)
            cut = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
            bounds = [0, *cut.tolist(), len(ids)]
            sizes = np.diff(bounds)
            done = range(len(sizes) if last else len(sizes) - 1)
            wanted = [g for g in done if sizes[g] > 1]
            if wanted:
                take = np.concatenate([np.arange(bounds[g], bounds[g + 1]) for g in wanted])
                kept = rows.take(pa.array(take))
                node, copies, side = (kept.column(i).to_numpy() for i in (4, 5, 6))
                keys = matrix_of_longs(kept.column(7))
                x = scaled(unpacked(kept.column(8), kind))
                length = np.sqrt(np.einsum("ij,ij->i", x, x))
                at = 0
                for g in wanted:
                    part = slice(at, at + sizes[g])
                    at += sizes[g]
                    bucket, low, high = (int(ids[bounds[g], i]) for i in (1, 2, 3))
                    yield compare.group(
                        bucket, node[part], copies[part], keys[part], x[part], length[part], side[part], low != high
                    )
            rest[0] = None if last else rows.slice(bounds[-2])

        rest = [None]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if carried is None else pa.concat_batches([carried, batch])
            yield from emit(groups(rows, False))
            carried = rest[0]
        if carried is not None:
            yield from emit(groups(carried, True))

    return entries.mapInArrow(run, "node long, links long, other long")


def matrix_of_longs(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<i8").reshape(len(column), -1)


def _entries(reps: DataFrame, dims: int, tables: int, hashes: int, kind: str | None) -> DataFrame:
    """A row for each bucket of each vector: (label, bucket, node[, copies, keys, vec]).

    Shorter vectors are filled up to ``dims``; the label tells lengths apart. Vectors go along
    as numbers of ``kind``, or not at all.
    """
    names = ["label", "bucket", "node", *(["copies", "keys", "vec"] if kind else [])]
    schema = "label long, bucket long, node long" + (
        ", copies long, keys binary, vec binary" if kind else ""
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column(3).offsets.to_numpy())
            for d in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == d)))
                x = matrix(part.column(3))
                keys = bucket_keys(scaled(x), tables, hashes)
                n, each = len(x), keys.shape[1] * keys.shape[2]
                flat = keys.reshape(n, each)
                row = pa.array(np.repeat(np.arange(n), each))
                columns = [part.column(0).take(row), pa.array(flat.ravel()), part.column(1).take(row)]
                if kind:
                    texts = pa.array([k.astype("<i8").tobytes() for k in flat], pa.binary())
                    full = np.zeros((n, dims))
                    full[:, :d] = x
                    columns += [part.column(2).take(row), texts.take(row), packed(full, kind).take(row)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return reps.select("label", "node", "copies", "vec").mapInArrow(run, schema)


def linked(reps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(node, links, other) of the different vectors (label long, node, copies, vec array).

    Vectors of one label must be of one length.

    ``links`` add up to the rows linked with a node by vectors other than its own;
    ``other`` is a node of the same component.
    """
    n = reps.count()
    dims = reps.agg(F.max(F.size("vec"))).first()[0] or 1
    axes = 2 * max(2, 1 << (dims - 1).bit_length())
    hashes = min(max(TABLES), max(1, math.ceil(math.log(max(2.0, n / CROWD), axes))))
    tables = TABLES[hashes]
    crowded = stored(
        _entries(reps, dims, tables, hashes, None).groupBy("label", "bucket").count()
        .where(F.col("count") > BLOCK)
        .select("label", "bucket", F.ceil(F.col("count") / BLOCK).alias("blocks")),
        "crowded",
    )
    # Floats travel as floats, half the bytes of every exchange; they are compared as doubles.
    kind = "<f4" if isinstance(reps.schema["vec"].dataType.elementType, FloatType) else "<f8"
    entries = _entries(reps, dims, tables, hashes, kind).join(crowded, ["label", "bucket"], "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod("node", blocks)
    # Each block meets itself and every other block of its bucket once.
    dealt = (
        entries.withColumn("own", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select(
            "label", "bucket", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"),
            "node", "copies", (F.col("own") > F.col("with")).cast("int").alias("side"), "keys", "vec",
        )
    )
    group = ["label", "bucket", "low", "high"]
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _compared(
        dealt.repartition(parts, *group).sortWithinPartitions(*group), similarity, kind
    )


def near_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; only rows of one label are compared.

    Vectors that are null, zero or hold null or infinite components, and rows without a
    label, link with nothing. Equal vectors are one node with a count. A null key takes
    part; ``component_id`` is the least key of the component that is not null.
    """
    given = rows.select(
        quoted(key).alias("id"), quoted(label).alias("label"), doubles(rows, vector).alias("vec")
    )
    ready = usable(F.col("vec")) & F.col("label").isNotNull()
    marked = distinct_vectors(given.withColumn("ready", ready), "vec", ("label",)).withColumn(
        "node", F.when(F.col("ready"), F.col("node"))
    )
    members = stored(marked.select("id", "node"), "members")
    reps = stored(
        marked.where("ready").groupBy("node").agg(
            F.xxhash64(F.any_value("label"), F.size(F.any_value("vec"))).alias("label"),
            F.count("*").alias("copies"),
            F.min("id").alias("least"),
            F.any_value("vec").alias("vec"),
        ),
        "vectors",
    )
    found = stored(linked(reps, similarity), "links")
    degree = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select("node", "other"))
    named = reps.select("node", "copies", "least").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    nodes = stored(
        named.join(least, "root").join(degree, "node", "left").select(
            "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        ),
        "nodes",
    )
    return members.join(nodes, "node", "left").select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", quoted(key).eqNullSafe(F.col("component_id")))
