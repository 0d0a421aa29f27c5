"""Hard negatives: rows of another label that are nearly as near to an anchor as its own.

Scores are exact inner products of whole numbers, taken for many candidates at once. The
components of a block of candidates are shifted to be positive and laid side by side as
fields of one wide integer, one for each dimension. An anchor then costs one multiplication
a dimension; fields are so wide that no sum runs over into the next, and the shifts are taken
off again when the fields are unpacked.

All anchors meet all rows, block by block, twice: first for the positives of each anchor,
then, as their scores are known, for the negatives in reach of each positive. A task returns
the few best of its block only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartledger.llm.common import quoted, stored

POSITIVES, NEGATIVES = 5, 3
#: A negative scores at least and at most this share of the positive's score, in hundredths.
LOWEST, HIGHEST = 50, 95
#: Whole numbers a unit of a component.
GRAIN = 256
#: Rows of a block of candidates, and of anchors.
CANDIDATES, ANCHORS = 2_048, 4_096
#: Candidates of a block at least, where there are more tasks than blocks.
SMALL = 256
_LONG = 1 << 63


def whole(vectors: list[list[float]], grain: int = GRAIN) -> np.ndarray:
    """floor(grain * x) of rows of equal lengths: longs, or Python integers where those are too short."""
    x = np.array(vectors, np.float64).reshape(len(vectors), -1)
    if not x.size or np.abs(x).max() < 2.0**52 / grain:
        return np.floor(grain * x).astype(np.int64)
    # From 2^52 on a double is a whole number.
    exact = [[int(v) * grain if abs(v) >= 2.0**52 else int(np.floor(grain * v)) for v in row] for row in x]
    return np.array(exact, object)


class Packed:
    """A block of candidates (rows, dimensions) of whole numbers, as one integer a dimension."""

    def __init__(self, rows: np.ndarray, least: int, largest: int):
        """``least`` and ``largest`` bound the components of the anchors to come."""
        self.n, self.d = rows.shape
        low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
        self.shift, self.anchor_shift = max(0, -low), max(0, -least)
        shifted = max(0, high + self.shift)
        most = self.d * shifted * max(0, largest + self.anchor_shift)
        # What is taken off again may be large where the fields are not, as for rows all alike.
        taken = 4 * self.d * max(1, -low, high) * max(1, -least, largest)
        # Fields are whole bytes; those of four are read as machine words.
        self.width = max(4, -(-max(most, shifted).bit_length() // 8))
        self.words = self.width == 4 and taken < _LONG
        self.fields = [self._laid(rows[:, j]) for j in range(self.d)]
        summed = rows.astype(np.int64 if self.words else object)
        self.totals = summed.sum(1) if rows.size else np.zeros(self.n, np.int64)

    def _laid(self, column: np.ndarray) -> int:
        if self.words:
            return int.from_bytes((column + self.shift).astype("<u4").tobytes(), "little")
        return int.from_bytes(b"".join((int(v) + self.shift).to_bytes(self.width, "little") for v in column), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner products of the candidates with an anchor; one too large for a long is the
        largest or smallest there is."""
        product = sum((a + self.anchor_shift) * fields for a, fields in zip(anchor, self.fields))
        data = product.to_bytes(self.width * self.n, "little")
        # sum (a + s)(x + t) = sum a x + t sum a + s sum x + d s t
        constant = self.shift * sum(anchor) + self.d * self.anchor_shift * self.shift
        if self.words:
            return np.frombuffer(data, "<u4").astype(np.int64) - constant - self.anchor_shift * self.totals
        unpacked = (int.from_bytes(data[i : i + self.width], "little") for i in range(0, len(data), self.width))
        exact = (f - constant - self.anchor_shift * int(t) for f, t in zip(unpacked, self.totals))
        return np.array([max(-_LONG, min(_LONG - 1, s)) for s in exact], np.int64)


def first(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest scores, ties by smaller id."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.lexsort((ids[at], ~scores[at]))[:most]]


def reach(positive: int, lowest: int = LOWEST, highest: int = HIGHEST) -> tuple[int, int]:
    """The least and the largest score of a negative beside a positive."""
    return -(-lowest * positive // 100), highest * positive // 100


def _by_length(side: pa.Table, grain: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(places, whole numbers) of the rows of each vector length."""
    vectors = side.column("vec").to_pylist()
    lengths = np.array([len(v) for v in vectors], np.int64)
    places = {int(d): np.flatnonzero(lengths == d) for d in np.unique(lengths)}
    return {d: (at, whole([vectors[i] for i in at], grain)) for d, at in places.items()}


def _scored(left: pa.Table, right: pa.Table, grain: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place of an anchor, candidates' scores, ids, labels) of two blocks."""
    ids = right.column("id").to_numpy()
    labels = np.array(right.column("label").to_pylist(), object)
    candidates = _by_length(right, grain)
    for d, (places, anchors) in _by_length(left, grain).items():
        if d in candidates:
            at, rows = candidates[d]
            low, high = (int(anchors.min()), int(anchors.max())) if anchors.size else (0, 0)
            block = Packed(rows, low, high)
            for i, anchor in zip(places, anchors.tolist()):
                yield i, block.scores(anchor), ids[at], labels[at]


# Spark


def _ready(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """(row, id, label, vec) of the rows that take part, numbered."""
    given = rows.select(
        quoted(key).cast("long").alias("id"), label.cast("string").alias("label"),
        quoted(vector).cast("array<double>").alias("vec"),
    ).where("id is not null and label is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    numbered = given.where(finite).select(F.monotonically_increasing_id().alias("row"), "id", "label", "vec")
    return stored(numbered, "ready")  # so the numbers stay


def _met(anchors: DataFrame, rows: DataFrame, run: Callable, names: tuple[str, ...]) -> DataFrame:
    """What ``run`` returns for every block of anchors with every block of rows, all longs.

    Rows are dealt by number, so equal ones spread and blocks are bounded. A row travels once
    for each block of the other side, as it must meet all of them.
    """
    n, m = rows.count(), anchors.count()
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = max(-(-n // CANDIDATES), min(tasks, -(-n // SMALL)), 1)
    high = max(-(-m // ANCHORS), 1)

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        each = F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))
        return df.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(blocks).cast("long"))).withColumn(other, F.explode(each))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(zip(*run(left, right))) or [()] * len(names)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, found)})

    left = dealt(anchors, "high", high, "wide", wide).groupBy("high", "wide")
    right = dealt(rows, "wide", wide, "high", high).groupBy("high", "wide")
    return left.cogroup(right).applyInArrow(block, ", ".join(f"{c} long" for c in names))


def _positives(anchors: DataFrame, rows: DataFrame, most: int, grain: int) -> DataFrame:
    """(row, place, positive, score): the first rows of an anchor's own label, places from 1."""

    def run(left: pa.Table, right: pa.Table) -> Iterator[tuple]:
        row, own, kind = (left.column(c).to_pylist() for c in ("row", "id", "label"))
        for i, scores, ids, labels in _scored(left, right, grain):
            same = np.flatnonzero((labels == kind[i]) & (ids != own[i]))
            for j in same[first(scores[same], ids[same], most)]:
                yield row[i], int(ids[j]), int(scores[j])

    found = _met(anchors, rows, run, ("row", "positive", "score"))
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "positive"))
    return found.withColumn("place", place).where(F.col("place") <= most)


def _negatives(pairs: DataFrame, rows: DataFrame, most: int, lowest: int, highest: int, grain: int) -> DataFrame:
    """(row, place, rank, negative, negative_score) of anchors (row, label, vec, pairs)."""

    def run(left: pa.Table, right: pa.Table) -> Iterator[tuple]:
        row, kind, met = (left.column(c).to_pylist() for c in ("row", "label", "pairs"))
        for i, scores, ids, labels in _scored(left, right, grain):
            other = np.flatnonzero(labels != kind[i])
            scores, ids = scores[other], ids[other]
            for pair in met[i]:
                low, high = reach(pair["score"], lowest, highest)
                if low <= high:
                    near = np.flatnonzero((scores >= max(low, -_LONG)) & (scores <= min(high, _LONG - 1)))
                    for j in near[first(scores[near], ids[near], most)]:
                        yield row[i], pair["place"], int(ids[j]), int(scores[j])

    found = _met(pairs, rows, run, ("row", "place", "negative", "negative_score"))
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def mine(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, lowest: int = LOWEST, highest: int = HIGHEST,
    grain: int = GRAIN,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on the key, given as a column of ``id``. A positive is one of an
    anchor's first ``positives`` rows of its label and another id; its negatives are the first
    rows of other labels whose score is ``lowest`` to ``highest`` hundredths of the positive's.
    Rows without id, label or vector, or with a component that is null or not finite, take no
    part. Repeated rows each count, as anchors and as candidates, and ties go to the smaller
    id. Vectors meet vectors of their length only; an empty one scores 0. Scores beyond a long
    count as the largest or smallest long. An empty table gives no rows.
    """
    ready = _ready(rows, key, vector, quoted(label) if isinstance(label, str) else label)
    asked = stored(ready.where(anchors), "anchors")
    own = stored(_positives(asked, ready, positives, grain), "positives")
    pairs = own.groupBy("row").agg(F.collect_list(F.struct("place", "score")).alias("pairs"))  # ``positives`` at most
    known = stored(asked.join(pairs, "row"), "known")
    found = _negatives(known, ready, negatives, lowest, highest, grain)
    return (
        found.join(own, ["row", "place"]).join(asked.select("row", "id"), "row")
        .select(
            F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
            F.col("negative").alias("negative_id"), F.col("score").alias("positive_score"), "negative_score",
        )
    )


SQL = r"""
WITH ready AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.id AS anchor_id, r.id, r.label = a.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM ready a JOIN ready r ON a.id % 50 = 0 AND (r.label <> a.label OR r.id <> a.id)),
positives AS (
  SELECT anchor_id, id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
