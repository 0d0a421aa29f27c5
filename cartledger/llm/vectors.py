"""Shared handling of embedding columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from cartledger.llm.common import quoted


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, of some length, all finite, not all zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(
        finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def doubles(rows: DataFrame, vector: str) -> Column:
    """A vector column for arithmetic in double precision: floats stay floats, half as wide and no
    less exact, anything else becomes doubles."""
    kind = rows.select(quoted(vector)).schema[0].dataType
    exact = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    return quoted(vector) if exact else quoted(vector).cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in double precision."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each row times a power of two, exactly, its largest component from 0.5 to 1: squares and
    sums of any row are then finite, and its direction is the same."""
    _, exponent = np.frexp(np.abs(rows).max(1, initial=0.0))
    return np.ldexp(rows, -exponent[:, None])


def packed(rows: np.ndarray, kind: str = "<f8") -> pa.Array:
    """Rows as binary values, little-endian numbers of ``kind``: doubles, or ``<f4`` for rows that are floats."""
    data = np.ascontiguousarray(rows, kind)
    width = data.shape[1] * data.itemsize if data.ndim == 2 else 0
    offsets = pa.array(np.arange(len(data) + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(
        pa.binary(), len(data), [None, offsets.buffers()[1], pa.py_buffer(data.tobytes())]
    )


def unpacked(column: pa.Array, kind: str = "<f8") -> np.ndarray:
    """The rows that ``packed`` wrote, in double precision."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).astype(np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def distinct_vectors(rows: DataFrame, vector: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Add ``node``: one number for each different vector (and values of ``by``), from its hash."""
    return rows.withColumn(
        "node", F.xxhash64(*[quoted(c) for c in by], quoted(vector), F.hash(quoted(vector)))
    )
