"""Stored tables whose layout spares work later: buckets by key, partitions by year."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartledger.operators.skew import DEFAULT_POLICY, SkewPolicy, hot_keys
from cartledger.sources.sinks import PARQUET_CODEC, write_parquet

YEAR = "purchase_year"
#: Rows of the longest table that a bucket holds, about. Whoever joins and groups buckets keeps
#: this many rows of each table in a task.
ROWS_PER_BUCKET = 500_000


def _bucket_table(path: str) -> str:
    """The name under which the catalogue knows the layout of the files at ``path``."""
    return "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def buckets_for(tables: Iterable[DataFrame], least: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for tables that are dealt by one key, ``least`` or as many as the longest asks for.

    A fixed number would let a task grow with the tables. Rows are counted, which takes Parquet
    files no more than their footers.
    """
    return max([least, *(math.ceil(df.count() / rows_per_bucket) for df in tables)])


def write_bucketed(
    df: DataFrame, path: str, key: str, buckets: int, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Store ``df`` at ``path``, dealt into ``buckets`` by ``key`` and sorted by it, and read it back.

    Tables with as many buckets by the same key are joined and grouped by it without an
    exchange, each bucket in a task; ``buckets_for`` finds a number that keeps those tasks small
    whatever the tables hold. A key too frequent for one task, by ``policy``, would make
    its bucket one, so such a table is stored plainly and shuffled by whoever joins it.
    """
    spark = df.sparkSession
    name = _bucket_table(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay until they are overwritten
    if hot_keys(df, key, policy):
        write_parquet(df, path)
        return spark.read.parquet(path)
    (
        df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet")
        .option("compression", PARQUET_CODEC).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    )
    return spark.table(name)


def stored_table(spark: SparkSession, path: str) -> DataFrame:
    """A table stored at ``path``, in buckets as far as this catalogue knows of them."""
    name = _bucket_table(path)
    return spark.table(name) if spark.catalog.tableExists(name) else spark.read.parquet(path)


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """What ``write_bucketed`` stored in buckets, perhaps in another application."""
    name = _bucket_table(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def write_years(df: DataFrame, path: str, timestamp: str) -> None:
    """Store ``df`` in a partition for each year of ``timestamp``.

    Only the years that ``df`` holds are replaced, the others stay as they are.
    """
    (
        df.withColumn(YEAR, F.year(timestamp)).write.mode("overwrite")
        .option("compression", PARQUET_CODEC).option("partitionOverwriteMode", "dynamic")
        .partitionBy(YEAR).parquet(path)
    )


def in_years(years: Iterable[int | None], year: Column | str = YEAR) -> Column:
    """A condition on the partition; rows without a date are the year None."""
    years = list(years)
    c = F.col(year) if isinstance(year, str) else year
    known = c.isin([y for y in years if y is not None])
    return F.coalesce(known, F.lit(False)) | c.isNull() if None in years else known
