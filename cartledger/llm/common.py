"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartledger.sources.scratch import scratch_path

# White space of the word rule: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns, wanted: str) -> str:
    """A column name that none of ``columns`` has, whatever its case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def quoted(name: str):
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ranked(df: DataFrame, by: str, rank: str) -> DataFrame:
    """Add ``rank``, the place from 0 of each row in the order of ``by``, nulls last.

    Rows are dealt by range, numbered inside each range, and each range is moved by
    the rows before it, so no task sees all rows. Rows of one value may come in any
    order among themselves; give unique values where that matters.
    """
    dealt = df.repartitionByRange(F.col(by).asc_nulls_last()).withColumn(
        "_range", F.spark_partition_id()
    )
    dealt = stored(dealt, "ranked")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range: as many as there are shuffle partitions.
    before = sizes.withColumn(
        "_before",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).drop("_n")
    inside = Window.partitionBy("_range").orderBy(F.col(by).asc_nulls_last())
    return (
        dealt.withColumn("_row", F.row_number().over(inside) - 1)
        .join(F.broadcast(before), "_range")
        .withColumn(rank, F.col("_before") + F.col("_row"))
        .drop("_range", "_row", "_before")
    )
