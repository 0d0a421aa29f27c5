"""Tables about tables: completeness, cardinality, shape and size."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

from cartledger.functions import r2


def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _common_type(kind: DataType) -> str:
    """A type that holds every value of ``kind``, shared by as many columns as can be."""
    if isinstance(kind, IntegralType):
        return "bigint"
    if isinstance(kind, (DoubleType, FloatType)):
        return "double"
    if isinstance(kind, DecimalType):
        return f"decimal(38,{kind.scale})"
    if isinstance(kind, (BooleanType, DateType, TimestampNTZType, TimestampType)):
        return kind.simpleString()
    return "string"


def _columns_of(df: DataFrame) -> Column:
    """Rows (position, column, type) describing the columns of ``df``."""
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )


def _count_columns(df: DataFrame, names: list[str], kind: str) -> DataFrame:
    values = df.select(
        *[F.when(~_missing(df, c), F.col(c)).cast(kind).alias(c) for c in names]
    ).unpivot([], names, "Columna", "_value")
    return values.groupBy("Columna").agg(
        F.count("_value").alias("No_Nulos"),
        F.count_if(F.col("_value").isNull()).alias("Nulos"),
        F.count_distinct("_value").alias("Valores_Unicos"),
    )


def quality_report(df: DataFrame) -> DataFrame:
    """Per column: type, filled and missing values, percentage missing, distinct values.

    Columns of like type are turned into (column, value) rows and grouped, so that
    one exact distinct count serves them all; equal values are merged before the
    shuffle, and no value is turned into text. Each group of columns scans only
    itself, so hand in a stored table rather than one that is expensive to compute.
    """
    alike: dict[str, list[str]] = {}
    for f in df.schema.fields:
        alike.setdefault(_common_type(f.dataType), []).append(f.name)
    counted = reduce(
        DataFrame.unionByName, [_count_columns(df, names, kind) for kind, names in alike.items()]
    )
    rows = F.col("No_Nulos") + F.col("Nulos")
    # The columns themselves are the left side, so an empty table is reported too.
    columns = df.sparkSession.range(1).select(
        F.inline(_columns_of(df)).alias("_position", "Columna", "Tipo")
    )
    return (
        columns.join(counted, "Columna", "left")
        .orderBy("_position")
        .select(
            "Columna",
            "Tipo",
            F.coalesce("No_Nulos", F.lit(0)).alias("No_Nulos"),
            F.coalesce("Nulos", F.lit(0)).alias("Nulos"),
            r2(F.try_divide(F.lit(100.0) * F.col("Nulos"), rows)).alias("Porcentaje_Nulos"),
            F.coalesce("Valores_Unicos", F.lit(0)).alias("Valores_Unicos"),
        )
    )


#: Binary logarithm of the registers of a sketch: the estimates have a standard error of 1.6 %.
SKETCH_BITS = 12


def column_sketches(df: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """(position, column, type, filled, missing, sketch) of each column of a part of a table.

    ``sketch`` is a HyperLogLog sketch of the column's values, a few kilobytes whatever the
    part holds. All columns take one scan, and a task sends one row. Stored beside their parts,
    sketches are merged later without reading the data again.
    """

    def entry(i: int) -> Column:
        f = df.schema.fields[i]
        value = F.when(~_missing(df, f.name), F.col(f.name))
        if isinstance(f.dataType, (DoubleType, FloatType)):
            value = value + F.lit(0.0)  # -0.0 is 0.0
        value = value.cast("bigint" if isinstance(f.dataType, IntegralType) else "string")
        return F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.count(value).alias("filled"), F.count_if(value.isNull()).alias("missing"),
            F.hll_sketch_agg(value, bits).alias("sketch"),
        )

    counted = df.agg(*[entry(i).alias(f"c{i}") for i in range(len(df.columns))])
    return counted.select(F.inline(F.array(*counted.columns)))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row for each column of all parts whose sketches are given, in the same form."""
    return sketches.groupBy("position", "column", "type").agg(
        F.sum("filled").alias("filled"), F.sum("missing").alias("missing"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def quality_report_from_sketches(sketches: DataFrame) -> DataFrame:
    """``quality_report`` of all parts together, its distinct values estimated.

    The estimates are within 5 % (three standard errors) nearly always; all other figures are exact.
    """
    rows = F.col("filled") + F.col("missing")
    return merged_sketches(sketches).orderBy("position").select(
        F.col("column").alias("Columna"),
        F.col("type").alias("Tipo"),
        F.col("filled").alias("No_Nulos"),
        F.col("missing").alias("Nulos"),
        r2(F.try_divide(F.lit(100.0) * F.col("missing"), rows)).alias("Porcentaje_Nulos"),
        F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("Valores_Unicos"),
    )


def table_info(df: DataFrame, table: str = "") -> DataFrame:
    """One row per column with its type and missing values, beside the table's size."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_missing(df, c)).alias(c) for c in df.columns],
    )
    names = df.columns
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f.name).alias("nulls"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counts.select(
        F.lit(table).alias("table"),
        F.col("_rows").alias("rows"),
        F.lit(len(names)).alias("columns"),
        F.lit(", ".join(names[:10])).alias("first_columns"),
        F.inline(described),
    )


def run_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
