"""Copies, of whole rows or of keys, found without sending every row through the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from cartledger.operators.cleaning import drop_duplicate_keys
from cartledger.operators.skew import DEFAULT_POLICY, SkewPolicy, free_name

#: Bytes of an entry in the table of repeated hashes, about.
_ENTRY_BYTES = 64


def _row_hash(df: DataFrame) -> Column:
    """64 bits of a row, equal for rows that are."""
    # Adding 0 makes -0.0 and 0.0, which are equal, one.
    plain = [
        F.col(_quoted(f.name)) + F.lit(0.0).cast(f.dataType) if isinstance(f.dataType, (FloatType, DoubleType))
        else F.col(_quoted(f.name))
        for f in df.schema.fields
    ]
    return F.xxhash64(*plain, *[c.isNull() for c in plain])  # hashes pass over nulls


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _in_two_passes(
    df: DataFrame, of: DataFrame, drop: Callable[[DataFrame], DataFrame], policy: SkewPolicy
) -> DataFrame:
    """``drop`` of the rows of ``df`` whose hash, by the columns of ``of``, occurs twice, and all others."""
    mark = free_name(df, "_hash")
    hashed = df.withColumn(mark, _row_hash(of))
    repeated = hashed.groupBy(mark).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(mark)
    few = min(policy.broadcast_rows, policy.broadcast_bytes // _ENTRY_BYTES)
    found = repeated.limit(few + 1).count()
    if not found:
        return df
    if found > few:
        return drop(df)
    small = F.broadcast(repeated)
    alone = hashed.join(small, mark, "left_anti").drop(mark)
    met = hashed.join(small, mark, "left_semi").drop(mark)
    return alone.unionByName(drop(met))


def drop_duplicate_rows_two_pass(df: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """One of each group of equal rows, like ``dropDuplicates``, in two passes over ``df``.

    The first counts row hashes, so 8 bytes a row and their count are shuffled, or one row a task of
    a row with very many copies. Rows whose hash occurs once have no copy and pass through where they
    lie; only the others are exchanged whole and compared, so hashes that collide by chance cost
    time, not rows. That pays while few different rows are repeated: the table of their hashes is
    broadcast behind a count of its size, and beyond the policy's limit all rows are exchanged.
    ``df`` is read twice, so hand in a stored table. Rows of maps cannot be compared.
    """
    if not df.columns:
        return df.dropDuplicates()
    return _in_two_passes(df, df, DataFrame.dropDuplicates, policy)


def drop_duplicate_keys_two_pass(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """One row per key, the same as ``cleaning.drop_duplicate_keys`` keeps, in two passes over ``df``.

    As for whole rows: hashes of keys are counted, and only rows whose key may have another row are
    exchanged and sorted. ``df`` is read twice, so hand in a stored table.
    """
    return _in_two_passes(df, df.select(*map(_quoted, keys)), lambda met: drop_duplicate_keys(met, keys, order_by), policy)
