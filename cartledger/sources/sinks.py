"""Writers: Parquet, CSV, a bundle of tables, and database tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from threading import Thread

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

# What to do when the target table exists, as a Spark save mode.
SAVE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
INSERT_BATCH_ROWS = 1000
#: Of Parquet files. A run keeps its tables several times over, and these take two thirds of the
#: room that Spark's own choice takes, in no more time.
PARQUET_CODEC = "zstd"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", PARQUET_CODEC).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    """A folder of CSV part files with headers; null and empty text are both blank.

    Other keywords are Spark's options of a CSV writer, such as ``compression``.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
        .options(**options)
        .csv(path)
    )


def write_bundle(spark: SparkSession, tables: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Several tables under one folder, with a manifest that is also returned.

    Row counts come from the footers of the written files.
    """
    root = path.rstrip("/")
    for name, df in tables.items():
        write_parquet(df, f"{root}/{name}")
    entries = [
        spark.read.parquet(f"{root}/{name}")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            F.lit(name).alias("table"),
            F.lit(f"{root}/{name}").alias("path"),
            "rows",
            F.lit(df.schema.simpleString()).alias("schema"),
        )
        for name, df in tables.items()
    ]
    write_parquet(reduce(DataFrame.unionByName, entries), f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database reached over JDBC.

    ``connections`` bounds how many tasks write at once. ``truncate`` empties a table that
    is replaced instead of dropping it, which keeps its columns, so only for loads whose
    columns never change.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16
    truncate: bool = False

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(INSERT_BATCH_ROWS),
            "numPartitions": str(self.connections),
            "truncate": str(self.truncate).lower(),
            **self.properties,
        }

    def save(self, df: DataFrame, table: str, mode: str) -> None:
        df.write.format("jdbc").options(**self.options(table)).mode(mode).save()

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(table)).load()

    def exists(self, spark: SparkSession, table: str) -> bool:
        schema, _, name = table.rpartition(".")
        listed = self.read(spark, "information_schema.tables").filter(F.col("table_name") == name)
        if schema:
            listed = listed.filter(F.col("table_schema") == schema)
        return not listed.limit(1).isEmpty()


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of the Spark catalogue, their files under ``location``."""

    location: str
    database: str | None = None

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}" if self.database else table

    def save(self, df: DataFrame, table: str, mode: str) -> None:
        (
            df.write.format("parquet")
            .mode(mode)
            .option("path", f"{self.location.rstrip('/')}/{table}")
            .saveAsTable(self._name(table))
        )

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(self._name(table))

    def exists(self, spark: SparkSession, table: str) -> bool:
        return spark.catalog.tableExists(self._name(table))


Target = JdbcTarget | CatalogTarget


#: Seconds to wait for the row count of a finished write.
COUNT_WAIT = 60.0


def _observed(written: Observation) -> int | None:
    """The counted rows, or nothing where the write reports none in time."""
    rows: list[int] = []
    waiting = Thread(target=lambda: rows.append(written.get["rows"]), daemon=True)
    waiting.start()
    waiting.join(COUNT_WAIT)
    return rows[0] if rows else None


def load_table(
    df: DataFrame, target: Target, table: str, if_exists: str = "replace"
) -> int | None:
    """Load one table and return the rows written; any failure is raised.

    The rows are counted by the write itself, so nothing is computed twice. Nothing is
    returned for a write that reports no count within ``COUNT_WAIT``.
    """
    if if_exists not in SAVE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(SAVE_MODES)}, not {if_exists!r}")
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    target.save(counted, table, SAVE_MODES[if_exists])
    return _observed(written)


def load_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    target: Target,
    if_exists: str = "replace",
) -> DataFrame:
    """Load several tables; one that fails is recorded and the others still load."""
    results = []
    for name, df in tables.items():
        try:
            results.append((name, True, load_table(df, target, name, if_exists), None))
        except Exception as e:  # noqa: BLE001 - recorded per table
            results.append((name, False, None, str(e)))
    return spark.createDataFrame(results, "table string, ok boolean, rows bigint, error string")


def table_exists(spark: SparkSession, target: Target, table: str) -> bool:
    return target.exists(spark, table)


def row_count(spark: SparkSession, target: Target, table: str) -> DataFrame:
    return target.read(spark, table).agg(F.count(F.lit(1)).alias("rows"))
