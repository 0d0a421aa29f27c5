"""Column names, tolerant dates, null handling and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    NumericType,
    StringType,
)

from cartledger.functions.dates import FORMS, best_form, form_counts, parse_as, parse_timestamp
from cartledger.operators.skew import free_name


def clean_names(df: DataFrame) -> DataFrame:
    """Lower-case, trim, and turn each inner space into an underscore."""
    names = [c.lower().strip().replace(" ", "_") for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"cleaned column names collide: {clashes}")
    return df.toDF(*names)


def parse_dates(df: DataFrame, columns: Iterable[str], day_first: bool = False) -> DataFrame:
    """Read the given columns as timestamps, in any of the forms of ``parse_timestamp``.

    Text that is no date becomes null; columns that are dates already stay.
    """
    present = [c for c in columns if c in df.columns]
    return df.withColumns(
        {
            c: parse_timestamp(F.col(c), day_first)
            if isinstance(df.schema[c].dataType, StringType)
            else F.col(c).try_cast("timestamp_ntz")
            for c in present
        }
    )


def _texts(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, StringType)]


def date_formats(df: DataFrame, columns: Iterable[str], offsets: str = "utc") -> DataFrame:
    """(column, form, values, fits, misfits) of text columns: the form of a date that most values fit.

    One aggregate over the rows. A column without any date has no form; of forms that as many
    values fit the first of ``functions.dates.FORMS`` is taken, so where nothing tells, the
    month comes first.
    """
    chosen = _texts(df, columns)
    if not chosen:
        return df.sparkSession.createDataFrame([], "column string, form string, values bigint, fits bigint, misfits bigint")
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.when(best["fits"] > 0, best["form"]).alias("form"),
            F.col(f"c{i}_values").alias("values"), best["fits"].alias("fits"),
            (F.col(f"c{i}_values") - best["fits"]).alias("misfits"),
        )
        for i, c in enumerate(chosen)
        for best in [F.col(f"c{i}")]
    ]
    return _best_forms(df, chosen, offsets).select(F.inline(F.array(*rows)))


def _best_forms(df: DataFrame, columns: Sequence[str], offsets: str) -> DataFrame:
    """One row: ``best_form`` as c0, c1, ... and the numbers of values as c0_values, ... of the columns."""
    counts = [count for i, c in enumerate(columns) for count in form_counts(F.col(c), f"c{i}", offsets)]
    return df.agg(*counts).select("*", *[best_form(f"c{i}").alias(f"c{i}") for i in range(len(columns))])


def parse_dates_by_column(df: DataFrame, columns: Iterable[str], offsets: str = "utc") -> DataFrame:
    """Read text columns as timestamps, each by the one form that most of its values fit.

    So the column decides whether the day or the month comes first. Values of another form
    become null; ``date_formats`` counts them. The forms are a scalar subquery, so nothing
    runs before the result is used.
    """
    chosen = _texts(df, columns)
    if not chosen:
        return df
    best = _best_forms(df, chosen, offsets)
    forms = best.select(F.struct(*[F.col(f"c{i}")["form"].alias(c) for i, c in enumerate(chosen)]).alias("forms"))
    held = free_name(df, "_forms")
    known = df.withColumn(held, forms.scalar())  # named once, as every mention would be planned anew

    def parsed(c: str) -> Column:
        return F.coalesce(*[F.when(F.col(held)[c] == f, parse_as(F.col(c), f, offsets)) for f in FORMS])

    return known.withColumns({c: parsed(c) for c in chosen}).drop(held)


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns or df.columns))


def fill_zero(
    df: DataFrame, columns: Sequence[str] | None = None, include_text: bool = False
) -> DataFrame:
    """Fill numeric nulls (and NaN) with 0; text only on request, dates never."""
    chosen = [df.schema[c] for c in (columns or df.columns)]
    fills: dict[str, Column] = {}
    for f in chosen:
        if isinstance(f.dataType, NumericType):
            fills[f.name] = F.coalesce(_no_nan(df, f.name), F.lit(0).cast(f.dataType))
        elif include_text and isinstance(f.dataType, StringType):
            fills[f.name] = F.coalesce(F.col(f.name), F.lit("0"))
    return df.withColumns(fills)


def fill_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill numeric nulls with the column mean; the filled column is a double, or for
    decimals a decimal with six more places.

    Without an explicit list, whole numbers are left alone along with text and dates: as
    doubles the largest would change. All means come from one aggregate, read back as a
    scalar subquery.
    """
    wide = (DoubleType, DecimalType)
    kinds = NumericType if columns else wide
    targets = [c for c in (columns or df.columns) if isinstance(df.schema[c].dataType, kinds)]
    if not targets:
        return df
    means = df.agg(
        F.struct(*[_mean(df, c).alias(c) for c in targets]).alias("means")
    ).scalar()

    def filled(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, DecimalType):
            finer = DecimalType(38, min(38, kind.scale + 6))
            return F.coalesce(F.col(c).cast(finer), means[c].cast(finer))
        return F.coalesce(_no_nan(df, c).cast("double"), means[c])

    return df.withColumns({c: filled(c) for c in targets})


def _mean(df: DataFrame, column: str) -> Column:
    value = _no_nan(df, column)
    if isinstance(df.schema[column].dataType, LongType):
        value = value.cast("decimal(20,0)")
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def fill_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls with the most frequent value; the smallest wins a tie.

    One pass counts the values of all columns at once (a grouping set per column),
    so no value list is ever held in one aggregate buffer. The top count per
    column is a ``row_number() = 1`` filter, which Spark cuts down before the
    shuffle. An all-null column stays null.
    """
    targets = list(columns or df.columns)
    # grouping_id() has one bit per column.
    for start in range(0, len(targets), 32):
        df = _fill_mode_once(df, targets[start : start + 32])
    return df


def _fill_mode_once(df: DataFrame, targets: list[str]) -> DataFrame:
    values = df.select(*[_no_nan(df, c).alias(c) for c in targets])
    counts = values.groupingSets([[c] for c in targets], *targets).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")
    )
    # In the grouping set of one column, the bits of all others are 1.
    ones = (1 << len(targets)) - 1
    in_set = {
        c: F.col("_set") == F.lit(ones ^ (1 << (len(targets) - 1 - i)))
        for i, c in enumerate(targets)
    }
    known = F.coalesce(*[F.when(in_set[c], F.col(c).isNotNull()) for c in targets])
    order = Window.partitionBy("_set").orderBy(F.desc("_n"), *[F.asc(c) for c in targets])
    top = (
        counts.filter(known)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
    )
    modes = top.agg(
        F.struct(*[F.max(F.when(in_set[c], F.col(c))).alias(c) for c in targets]).alias("modes")
    ).scalar()
    return df.withColumns({c: F.coalesce(_no_nan(df, c), modes[c]) for c in targets})


def handle_missing(
    df: DataFrame, strategy: str = "drop", columns: Sequence[str] | None = None
) -> DataFrame:
    """Treat nulls by the name of a strategy; all columns unless some are named."""
    strategies = {
        "drop": drop_nulls,
        "fill_zero": fill_zero,
        "fill_mean": fill_mean,
        "fill_mode": fill_mode,
    }
    if strategy not in strategies:
        raise ValueError(f"strategy must be one of {sorted(strategies)}, not {strategy!r}")
    return strategies[strategy](df, columns)


def _no_nan(df: DataFrame, column: str) -> Column:
    """NaN counts as missing in floating-point columns."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(c), c)
    return c


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_duplicate_keys(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Keep one row per key, the first in ``order_by``; null keys count as equal.

    The default order is over all other columns, so the survivor does not depend
    on how the data was split. Pass the columns
    ``sources.FILE_POSITION`` to keep the first row of the file instead.
    Each task drops all but its own first row per key before the shuffle, so a
    key with many copies costs one row per task.
    """
    order = list(order_by or [c for c in df.columns if c not in keys] or keys)
    first = Window.partitionBy(*keys).orderBy(*order)
    copy = free_name(df, "_copy")
    return df.withColumn(copy, F.row_number().over(first)).filter(F.col(copy) == 1).drop(copy)
