"""Many-to-one joins that stay balanced when one key holds a large share of the rows.

Two ways, chosen by size:

* ``lookup_join`` broadcasts the one-row-per-key side after measuring that it is
  small, so the large side is not shuffled at all;
* ``split_hot_join`` shuffles, but spreads each hot key over as many parts as its
  row count asks for and repeats only that key's single row on the other side.

Both return every row a plain join returns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

# A task sends at most this many histogram rows, whatever it read. An average bucket
# holds a quarter of the default ``share``, so a bucket above it points to a hot key.
_BUCKETS = 1 << 14


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot, and what may be broadcast.

    ``share`` bounds the number of hot keys (at most ``1 / share``), so the hot-key
    table is always small enough to hold and to broadcast. A key below ``min_rows`` fits in one task
    and is left alone. Keys between the two are for adaptive execution to split,
    which it can, since both sides of the join come straight from a shuffle.
    """

    share: float = 1 / 4000
    min_rows: int = 1_000_000
    rows_per_part: int = 500_000
    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 * 1024 * 1024


DEFAULT_POLICY = SkewPolicy()


def free_name(df: DataFrame, wanted: str, *others: DataFrame) -> str:
    """A column name like ``wanted`` that none of the frames has."""
    taken = {c.lower() for frame in (df, *others) for c in frame.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def hot_keys(
    rows: DataFrame, key: str, policy: SkewPolicy = DEFAULT_POLICY
) -> dict[object, int]:
    """Keys above the policy's threshold, each with the number of parts to split it into.

    Returns at most ``1 / share`` keys, null among them if it is as frequent.
    Counting every distinct key would shuffle about as many rows as there are
    keys. A histogram over a fixed number of hash buckets is counted first; only
    keys in an over-full bucket are then counted one by one, which is nothing at
    all on even data. Both passes read the key column alone.
    """
    total, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    threshold = max(total * policy.share, policy.min_rows)
    if total <= threshold:
        return {}
    keys = rows.select(key).filter(F.col(key).isNotNull())
    bucket, n = free_name(keys, "_bucket"), free_name(keys, "_n")
    keys = keys.withColumn(bucket, F.pmod(F.xxhash64(key), F.lit(_BUCKETS)))
    full_buckets = (
        keys.groupBy(bucket).agg(F.count(F.lit(1)).alias(n))
        .filter(F.col(n) > threshold)
        .select(bucket)
    )
    counts = (
        keys.join(F.broadcast(full_buckets), bucket, "left_semi")
        .groupBy(key).agg(F.count(F.lit(1)).alias(n))
        .filter(F.col(n) > threshold)
    )
    found = {k: rows for k, rows in counts.select(key, n).collect()}
    if nulls > threshold:
        found[None] = nulls
    return {k: math.ceil(n / policy.rows_per_part) for k, n in found.items()}


def split_hot_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    policy: SkewPolicy = DEFAULT_POLICY,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Join ``many`` to ``one`` on ``key``; ``how`` is inner or left (keeping ``many``).

    The hot keys are looked up first. Without any, this is the plain join.
    Otherwise the part of a row comes from its content plus the index of its input
    partition: distinct rows and identical copies both spread out, and a retried
    task sends each row to the same place as the first attempt did.

    Hot keys are counted in ``keys_of``, a stored table with about the keys of
    ``many``, where ``many`` itself is costly to compute. Which keys count as hot
    changes how the rows travel and never which rows come out.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    hot = hot_keys(many if keys_of is None else keys_of, key, policy)
    null_parts = hot.pop(None, None)
    if not hot and (null_parts is None or how == "inner"):
        return many.join(one, key, how)
    part, n_parts = free_name(many, "_part", one), free_name(many, "_parts", one)
    schema = StructType([many.schema[key], StructField(n_parts, IntegerType())])
    split = F.broadcast(many.sparkSession.createDataFrame(list(hot.items()), schema))
    # Null keys match nothing, but a left join keeps their rows, all in one task
    # unless they are numbered too.
    parts = F.when(F.col(key).isNull(), F.lit(null_parts)).otherwise(F.col(n_parts))
    spread = F.pmod(F.xxhash64(*many.columns), parts) + F.spark_partition_id()
    left = many.join(split, key, "left").withColumn(
        part, F.when(parts.isNotNull(), F.pmod(spread, parts).cast("int")).otherwise(F.lit(0))
    ).drop(n_parts)
    right = one.join(split, key, "left").withColumn(
        part, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n_parts), F.lit(1)) - 1))
    ).drop(n_parts)
    return left.join(right, [key, part], how).drop(part)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes held in the text of a row, plus a fixed allowance per column."""
    text = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, (StringType, BinaryType))
    ]
    return sum(text, F.lit(16 * len(df.columns)))


def fits_broadcast(df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> bool:
    """Measure whether ``df`` is small enough to broadcast: one scan, two numbers back."""
    rows, size = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))
    ).first()
    return rows <= policy.broadcast_rows and size <= policy.broadcast_bytes


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    how: str = "inner",
    policy: SkewPolicy = DEFAULT_POLICY,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Join to a lookup table: broadcast while it measures small, split hot keys beyond."""
    if fits_broadcast(one, policy):
        return many.join(F.broadcast(one), key, how)
    return split_hot_join(many, one, key, how, policy, keys_of)
