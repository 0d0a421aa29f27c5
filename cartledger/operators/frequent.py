"""The most frequent value of a column from small summaries, decided exactly."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

#: Values that a task's summary keeps, and candidates that are counted again.
COUNTERS, CANDIDATES = 1_024, 4_096


def reduced(counts: dict, most: int) -> tuple[dict, int]:
    """The counts cut down to ``most`` values, and by how much every count may now be short."""
    if len(counts) <= most:
        return counts, 0
    cut = sorted(counts.values(), reverse=True)[most]
    return {v: n - cut for v, n in counts.items() if n > cut}, cut


def _summaries(values: DataFrame, counters: int) -> DataFrame:
    """(value, n, short): Misra-Gries summaries of a column ``value`` without nulls, one a task.

    In a task a value occurs ``n`` times at least, and ``short`` times more at most; one that the
    summary lacks at most ``short`` times. A row without a value states ``short`` once a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, short, kind = {}, 0, None
        for batch in batches:
            column = batch.column(0)
            kind = column.type
            for entry in pc.value_counts(column).to_pylist():
                counts[entry["values"]] = counts.get(entry["values"], 0) + entry["counts"]
            counts, cut = reduced(counts, counters)
            short += cut
        if kind is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None, *counts], kind), pa.array([0, *counts.values()], pa.int64()),
                    pa.array([short, *[0] * len(counts)], pa.int64()),
                ],
                names=["value", "n", "short"],
            )

    schema = StructType([*values.schema.fields, StructField("n", LongType()), StructField("short", LongType())])
    return values.mapInArrow(run, schema)


def _values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column that are neither null nor NaN, equal ones alike."""
    c, kind = F.col("`" + column.replace("`", "``") + "`"), df.schema[column].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        c = F.when(~F.isnan(c), c + F.lit(0.0).cast(kind))  # -0.0 is 0.0
    return df.select(c.alias("value")).where("value is not null")


def most_frequent(
    df: DataFrame, column: str, counters: int = COUNTERS, candidates: int = CANDIDATES
) -> tuple[object, bool]:
    """(value, decided): the most frequent value of a column, the smallest of equals; None without any.

    Each task sums up its rows in at most ``counters`` values and a bound on what it left out.
    The summaries are added up, and the few values that can be the most frequent are counted
    again, exactly: a scan, but no shuffle of the values. Only where the bounds leave open whether
    another value is as frequent, as in columns of almost unique values, all are counted by a
    shuffle; ``decided`` tells. Runs at once, over ``df`` two or three times.
    """
    values = _values(df, column)
    found = _summaries(values, counters).groupBy("value").agg(F.sum("n").alias("n"), F.sum("short").alias("short"))
    # At most ``counters`` rows of each task, of which the first few reach the driver.
    top = found.orderBy(F.col("value").isNotNull(), F.desc("n"), "value").limit(candidates + 2).collect()
    if len(top) < 2 and not (top and top[0]["short"]):
        return None, True
    short, ranked = top[0]["short"], top[1:]
    if not short:
        return ranked[0]["value"], True  # nothing was left out
    likely = [(r["value"],) for r in ranked if r["n"] + short >= ranked[0]["n"]]
    if 0 < len(likely) <= candidates:
        again = values.join(F.broadcast(df.sparkSession.createDataFrame(likely, values.schema)), "value", "left_semi")
        best = _first(again)
        if best["n"] > short:
            return best["value"], True
    return _first(values)["value"], False


def _first(values: DataFrame):
    return values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").first()


def fill_mode_from_summaries(
    df: DataFrame, columns: Sequence[str] | None = None, counters: int = COUNTERS, candidates: int = CANDIDATES
) -> DataFrame:
    """Fill nulls (and NaN) with the most frequent value, as ``fill_mode`` does.

    The values are found at once, column by column, without shuffling every value of a
    column; see ``most_frequent``. An all-null column stays null.
    """
    filled = {}
    for c in columns or df.columns:
        value, _ = most_frequent(df, c, counters, candidates)
        if value is not None:
            kind, own = df.schema[c].dataType, F.col("`" + c.replace("`", "``") + "`")
            known = F.when(~F.isnan(own), own) if isinstance(kind, (DoubleType, FloatType)) else own
            filled[c] = F.coalesce(known, F.lit(value).cast(kind))
    return df.withColumns(filled)
