"""Shards of bounded size by extendible hashing, with DataFrame operations only.

The directory is indexed by the leading bits of a hash of the key. A bucket that is too
large is split on its next bit, and only such buckets are, until each fits. Sums by hash
prefix replace the one-by-one insertion of the textbook: one grouped pass gives the bytes
of every bucket down to some depth, and only the rows of buckets that are still too large
are looked at again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartledger.llm.common import free_name, quoted, stored

BITS = 60
#: Bits added at once below a bucket that is too large.
STEP = 8


def hash_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(value), 1, BITS // 4), 16, 10).cast("long")


def _split(rows: DataFrame, limit: int, first: int) -> tuple[DataFrame, DataFrame | None]:
    """Leaves of the rows (parent, h, bytes), and the (parent, h) of values too large to split.

    A leaf row (parent, at, cell, depth, total) says: hashes of ``parent`` whose leading ``at``
    bits are ``cell`` belong to the bucket of their leading ``depth`` bits, of ``total`` bytes.
    """
    leaves, low, at = [], 0, min(first, BITS)
    todo = rows
    while True:
        prefix = F.shiftright("h", BITS - at)
        cells = stored(
            todo.groupBy("parent", prefix.alias("cell")).agg(
                F.sum("bytes").alias("bytes"), F.count("*").alias("n")
            ),
            "cells",
        )
        levels = cells.select(
            "*", F.explode(F.sequence(F.lit(low), F.lit(at))).alias("depth")
        ).withColumn("bucket", F.expr(f"shiftright(cell, {at} - depth)"))
        fits = (
            levels.groupBy("parent", "depth", "bucket")
            .agg(F.sum("bytes").alias("total"), F.sum("n").alias("rows"))
            .where((F.col("total") <= limit) | (F.col("rows") == 1))
            .select("parent", "depth", "bucket", "total")
        )
        found = stored(
            levels.join(fits, ["parent", "depth", "bucket"])
            .groupBy("parent", "cell")
            .agg(F.min(F.struct("depth", "total")).alias("least"))
            .select("parent", F.lit(at).alias("at"), "cell", "least.depth", "least.total"),
            "leaves",
        )
        leaves.append(found)
        large = stored(
            cells.join(found, ["parent", "cell"], "left_anti").select("parent", "cell"), "large"
        )
        if large.isEmpty():
            return _union(leaves), None
        if at == BITS:
            return _union(leaves), large.select("parent", F.col("cell").alias("h"))
        todo = stored(
            todo.withColumn("cell", prefix).join(large, ["parent", "cell"], "left_semi").drop("cell"),
            "oversized",
        )
        low, at = at + 1, min(at + STEP, BITS)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def _named(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows that reach a leaf, with ``shard``, the bits of the path from the parent, and its
    ``shard_bytes``, which the leaf knows."""
    depths = [r["at"] for r in leaves.select("at").distinct().collect()]  # one per pass
    parts = []
    for at in depths:
        cells = leaves.where(F.col("at") == at).drop("at")
        bits = F.lpad(F.bin(F.expr(f"shiftright(h, {BITS} - depth)")), F.col("depth"), F.lit("0"))
        parts.append(
            rows.withColumn("cell", F.shiftright("h", BITS - at))
            .join(cells, ["parent", "cell"])
            .withColumn("shard", F.concat("parent", F.when(F.col("depth") == 0, "").otherwise(bits)))
            .withColumnRenamed("total", "shard_bytes")
            .drop("cell", "depth")
        )
    empty = rows.limit(0).withColumn("shard", F.lit("")).withColumn("shard_bytes", F.lit(0).cast("long"))
    return _union(parts or [empty])


def shard(docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, bytes, shard, shard_bytes) of every row; no shard of several rows exceeds ``limit``.

    Bytes are those of the text in UTF-8, null counting 0. ``shard`` is the bucket's hash
    prefix as bits. Rows of one key stay together while they fit; a key that is too large
    by itself is split on the bits of a second hash, of the whole row, after a dot, and
    equal rows, if still too large, are dealt into numbered parts after a hash sign. A
    row that exceeds the limit alone has a shard of its own. Null keys count as one key.
    An empty table gives no rows.
    """
    rows = stored(
        docs.select(
            quoted(key).alias("id"),
            F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long").alias("bytes"),
            hash_bits(F.coalesce(quoted(key).cast("string"), F.lit(""))).alias("h"),
            F.shiftrightunsigned(F.xxhash64(*[quoted(c) for c in docs.columns]), 64 - BITS).alias(
                "h2"
            ),
            F.lit("").alias("parent"),
        ),
        "sized",
    )
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    first = max(0, math.ceil(math.log2(max(1, total / limit)))) + 3
    leaves, whole_keys = _split(rows, limit, first)
    done = [_named(rows, leaves)]
    if whole_keys is not None:
        inner = stored(
            rows.join(whole_keys, ["parent", "h"], "left_semi").select(
                "id", "bytes", F.col("h2").alias("h"), "h2",
                F.concat(F.lpad(F.bin("h"), BITS, "0"), F.lit(".")).alias("parent"),
            ),
            "keys",
        )
        leaves, equal = _split(inner, limit, STEP)
        done.append(_named(inner, leaves))
        if equal is not None:
            done.append(_dealt(inner.join(equal, ["parent", "h"], "left_semi"), limit))
    return _union([d.select(F.col("id").alias(key), "bytes", "shard", "shard_bytes") for d in done])


def _dealt(rows: DataFrame, limit: int) -> DataFrame:
    """Equal rows in numbered parts: counted by partition, then numbered inside each; the bytes
    of these parts alone are summed up."""
    rows = stored(rows.withColumn("pid", F.spark_partition_id()), "equal")
    counts = rows.groupBy("parent", "h", "pid").count()
    before = Window.partitionBy("parent", "h").orderBy("pid").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = counts.select(
        "parent", "h", "pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("parent", "h", "pid").orderBy("h2")
    place = F.col("before") + F.row_number().over(inside) - 1
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))))
    parts = rows.join(counts, ["parent", "h", "pid"]).withColumn(
        "shard",
        F.concat("parent", F.lpad(F.bin("h"), BITS, "0"), F.lit("#"), F.floor(place / fit)),
    )
    parts = stored(parts, "dealt")
    return parts.join(parts.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes")), "shard")


def write_shards(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text"):
    """Write the rows of ``docs`` as Parquet, one folder ``shard=...`` each; keys must be unique."""
    name, other = free_name(docs.columns, "shard"), free_name(docs.columns, "_key")
    places = shard(docs, limit, key, text).select(
        quoted(key).alias(other), F.col("shard").alias(name)
    )
    placed = docs.join(places, quoted(key).eqNullSafe(F.col(other))).drop(other)
    placed.repartition(name).write.partitionBy(name).parquet(path)


SQL = """
WITH sized AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
    ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
  FROM documents),
buckets AS (
  SELECT d.depth, h >> (60 - d.depth) AS bucket, sum(bytes) AS total, count(*) AS n
  FROM sized, range(0, 61) d(depth) GROUP BY ALL),
placed AS (
  SELECT s.doc_id, s.bytes, s.h, min(b.depth) AS depth
  FROM sized s JOIN buckets b ON b.bucket = s.h >> (60 - b.depth)
  WHERE b.total <= {limit} OR b.n = 1 GROUP BY ALL)
SELECT p.doc_id, p.bytes,
  CASE WHEN p.depth = 0 THEN '' ELSE lpad(bin(p.h >> (60 - p.depth)), p.depth::INT, '0') END AS shard,
  b.total::BIGINT AS shard_bytes
FROM placed p JOIN buckets b ON b.depth = p.depth AND b.bucket = p.h >> (60 - p.depth)
"""
