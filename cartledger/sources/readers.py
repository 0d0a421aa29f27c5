"""Lazy scans: CSV, Parquet, JDBC and SQL over registered tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from cartledger.functions.dates import best_form, form_counts, parse_as, parse_timestamp
from cartledger.sources.headers import header_groups

# The text pandas reads as missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

#: Names of the fields of a row that did not fit their type, where a reader is asked for them.
REJECTED = "_rejected"
FILE_POSITION = ("_file", "_block", "_row")


def _existing(path: str, load) -> DataFrame:
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def _clean(name: str) -> str:
    return name.lower().strip().replace(" ", "_")


def _unused(name: str, taken: Iterable[str]) -> str:
    if _clean(name) in map(_clean, taken):
        raise ValueError(f"the column {name!r} is there already")
    return name


def _groups(spark: SparkSession, path: str, reader, multi_line: bool, options: Mapping) -> list[tuple[list[str], list[str]]]:
    """(header, files) of the files that share a header, found by one query over the files."""
    # Opened with some schema, so that no job looks for one.
    listed = _existing(path, lambda: reader().schema("line string").csv(path)).inputFiles()
    if len(listed) < 2:
        return [(reader().csv(path).columns, [path])]
    found = header_groups(spark, path, multi_line, options.get("quote", '"'), options.get("comment", ""))
    if len(found) < 2:
        return [(reader().csv(found[0][1][0]).columns if found else [], [path])]
    # Lines that are spelled differently may still name the same columns.
    groups: dict[tuple[str, ...], list[str]] = {}
    for _, files in found:
        groups.setdefault(tuple(reader().csv(files[0]).columns), []).extend(files)
    if len(groups) < 2:
        return [(list(next(iter(groups))), [path])]
    return [(list(header), files) for header, files in groups.items()]


def _convert(text: Column, kind: DataType, day_first: bool, form: str | None = None) -> Column:
    """Text as a value of ``kind``, dates by ``form`` if given; null where it does not fit without loss."""
    if isinstance(kind, IntegralType):
        # Most are written plainly, and need no decimal.
        exact = text.try_cast("decimal(38,10)")
        return F.coalesce(text.try_cast(kind), F.when(exact == F.floor(exact), exact).try_cast(kind))
    if isinstance(kind, DecimalType):
        exact = text.try_cast("decimal(38,10)")
        value = text.try_cast(kind)
        fits = exact == value
        if kind.scale <= 2 and kind.precision - kind.scale <= 28:
            # A negative exponent takes three characters, so so few behind the point are digits that fit.
            point = F.instr(text, ".")
            fits = ((point > 0) & (F.length(text) - point <= kind.scale)) | fits
        return F.when(fits, value)
    if isinstance(kind, (TimestampNTZType, DateType)):
        return (parse_as(text, form) if form else parse_timestamp(text, day_first)).cast(kind)
    return text.try_cast(kind)


def _inferred(df: DataFrame, columns: list[str]) -> dict[str, DataType]:
    """What the non-null values of text columns all are, in one pass: boolean, whole
    number, double, or text. A number written with leading zeros is a code, hence text."""
    if not columns:
        return {}

    def tests(name: str) -> Column:
        text = F.trim(_quoted(name))
        whole, real = text.try_cast("bigint"), text.try_cast("double")
        return F.struct(
            F.count(text).alias("n"),
            F.count_if(F.lower(text).isin("true", "false")).alias("boolean"),
            F.count(whole).alias("whole"),
            F.count(real).alias("real"),
            F.count_if(text.rlike(r"^[+-]?0\d")).alias("codes"),
            F.coalesce(F.min(whole), F.lit(0)).alias("least"),
            F.coalesce(F.max(whole), F.lit(0)).alias("most"),
        )

    seen = df.agg(*[tests(c).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    kinds: dict[str, DataType] = {}
    for i, c in enumerate(columns):
        t = seen[f"c{i}"]
        if not t["n"] or t["codes"]:
            kinds[c] = StringType()
        elif t["boolean"] == t["n"]:
            kinds[c] = BooleanType()
        elif t["whole"] == t["n"]:
            small = -(1 << 31) <= t["least"] and t["most"] < 1 << 31
            kinds[c] = IntegerType() if small else LongType()
        else:
            kinds[c] = DoubleType() if t["real"] == t["n"] else StringType()
    return kinds


def _date_forms(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The form that most values of each text column fit, in one pass."""
    if not columns:
        return {}
    counts = [count for i, c in enumerate(columns) for count in form_counts(F.trim(_quoted(c)), f"c{i}")]
    seen = df.agg(*counts).select(*[best_form(f"c{i}")["form"] for i in range(len(columns))]).first()
    return dict(zip(columns, seen))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multi_line: bool = False,
    null_tokens: Iterable[str] = NULL_TOKENS,
    infer: bool = False,
    rejects: str | None = None,
    file_position: bool = False,
    day_first: bool = False,
    dates_by_column: bool = False,
    **options,
) -> DataFrame:
    """CSV with a header line, typed by ``schema``.

    Columns are matched by their cleaned names in every file, so their order may differ
    from file to file and from the schema, and a file may lack some; the first file's
    spelling names the column. All fields are read as text, ``null_tokens`` become null,
    and the rest is converted: whole numbers may be written ``1.0``, amounts must fit
    their scale, dates have the forms of ``parse_timestamp``. A field that does not fit is
    null, and ``rejects`` adds an array of the names of such fields to each row.

    Dates are read value by value, or with ``dates_by_column`` all of a column by the one form
    that most of them fit, found in an extra pass; so ``05/01/2023`` is in May or January by what
    the rest of the column says, and what has another form is a misfit.

    A column without a declared type is text, or with ``infer`` what all its values are,
    found in an extra pass. ``file_position`` adds ``FILE_POSITION``. Other keywords are
    Spark CSV options.
    """

    def reader():
        return (
            spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("escape", '"')
            .option("multiLine", multi_line)
            .options(**options)
        )

    spelled: dict[str, str] = {}
    opened = []
    for header, files in _groups(spark, path, reader, multi_line, options):
        clean = [_clean(c) for c in header]
        if len(set(clean)) < len(clean):
            raise ValueError(f"columns of {files[0]} have the same cleaned name: {header}")
        for c, name in zip(clean, header):
            spelled.setdefault(c, name)
        text = StructType([StructField(c, StringType()) for c in header])
        # Files are checked against the header they were grouped by.
        opened.append((clean, reader().schema(text).option("enforceSchema", False).csv(files)))
    flat = file_position and _in_one_folder(*[part for _, part in opened])
    parts = []
    for clean, part in opened:
        if file_position:
            part = _placed(part, flat)
        # One by one by their place: the names may hold dots and quotes.
        named = [spelled[c] for c in clean] + list(FILE_POSITION if file_position else ())
        parts.append(part.toDF(*named))
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    fields = list(spelled.values())

    tokens = list(null_tokens)
    if tokens and fields:
        df = df.withColumns({c: F.when(~_quoted(c).isin(tokens), _quoted(c)) for c in fields})
    declared = {_clean(f.name): f.dataType for f in schema or []}
    undeclared = [c for c in fields if _clean(c) not in declared]
    inferred = _inferred(df, undeclared) if infer else {}
    kinds = {c: declared.get(_clean(c)) or inferred.get(c) or StringType() for c in fields}
    dates = [c for c, kind in kinds.items() if isinstance(kind, (TimestampNTZType, DateType))]
    forms = _date_forms(df, dates) if dates_by_column else {}
    converted = {
        c: _convert(F.trim(_quoted(c)), kind, day_first, forms.get(c))
        for c, kind in kinds.items()
        if not isinstance(kind, StringType)
    }
    if not rejects:
        return df.withColumns(converted)
    # A value is converted once: what is lost is told from its result.
    made = {c: f"_made_{i}" for i, c in enumerate(converted)}
    made = {c: _unused(name, df.columns) for c, name in made.items()}
    lost = {c: _quoted(c).isNotNull() & F.col(name).isNull() for c, name in made.items()}
    names = F.array().cast("array<string>")
    if lost:
        # Not array_compact, whose lambda would keep the whole projection out of the generated code.
        named = F.array_except(
            F.array(*[F.when(gone, F.lit(c)) for c, gone in lost.items()]), F.array(F.lit(None).cast("string"))
        )
        names = F.when(reduce(Column.__or__, lost.values()), named).otherwise(names)
    read = [F.col(made[c]).alias(c) if c in made else _quoted(c) for c in df.columns]
    rejected = _unused(rejects, df.columns)
    df = df.withColumns({made[c]: value for c, value in converted.items()}).select(*read, names.alias(rejected))
    return df


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(name: str):
    return F.col(quoted_name(name))


def with_file_position(df: DataFrame) -> DataFrame:
    """Add ``FILE_POSITION`` columns, which order the rows as they stand in the files.

    Within a task rows are numbered as read, and a task reads the blocks of a file
    one after the other, so (file, block, number) is the order in the file. Files of one folder
    are told by their names, as the folder would be repeated in each row.
    """
    return _placed(df, _in_one_folder(df))


def _in_one_folder(*parts: DataFrame) -> bool:
    return len({file.rpartition("/")[0] for part in parts for file in part.inputFiles()}) < 2


def _placed(df: DataFrame, flat: bool) -> DataFrame:
    file, block, row = (_unused(c, df.columns) for c in FILE_POSITION)
    return df.withColumns(
        {
            file: F.col("_metadata.file_name" if flat else "_metadata.file_path"),
            block: F.col("_metadata.file_block_start"),
            row: F.monotonically_increasing_id(),
        }
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _existing(path, lambda: spark.read.parquet(path))


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Result of a query run by a database.

    ``split`` is (numeric column, lower bound, upper bound, parts) and makes the
    read parallel; the bounds only shape the parts and never filter rows. Without
    it the whole result comes through one task, which suits small results only.
    """
    options = {"url": url, "dbtable": f"({query.strip().rstrip(';')}) q", **(properties or {})}
    if split:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return spark.read.format("jdbc").options(**options).load()


#: Given tables are views of the session while their query is resolved.
_VIEWS = Lock()


def _is_view(spark: SparkSession, name: str) -> bool:
    try:
        return spark.catalog.getTable(name).isTemporary
    except AnalysisException:
        return False


def run_query(
    spark: SparkSession, query: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Result of a SQL query over catalogue tables and the given ones, by name.

    The given tables hide tables and views of the same name in this one query. They are
    views only while Spark resolves it; afterwards the caller's views are as before. Names
    are those of unquoted SQL, whatever their case.
    """
    text = query.strip().rstrip(";")
    with _VIEWS:
        hidden = {name: spark.table(quoted_name(name)) for name in tables or () if _is_view(spark, quoted_name(name))}
        try:
            for name, df in (tables or {}).items():
                df.createOrReplaceTempView(quoted_name(name))
            return spark.sql(text)
        finally:
            for name in tables or ():
                if name in hidden:
                    hidden[name].createOrReplaceTempView(quoted_name(name))
                else:
                    spark.catalog.dropTempView(name)
