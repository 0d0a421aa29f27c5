"""Bundles of tables that readers see whole or not at all."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cartledger.sources.sinks import write_parquet
from cartledger.sources.together import together

_MANIFEST = "version string, tables int, table string, path string, rows bigint, schema string"


def publish_bundle(spark: SparkSession, tables: Mapping[str, DataFrame], path: str) -> str:
    """Write a new version of a bundle and return its name; what is there already stays.

    Every version has a folder of its own. The manifest is written last, as one file that names
    all tables of the version, and is the commit: until it is there, and for good if a table
    fails, readers find the version before. Of two versions published at once both are whole,
    and the one that began later counts.
    """
    if not tables:
        raise ValueError("a bundle holds at least one table")
    root = path.rstrip("/")
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"

    def entry(name: str) -> tuple:
        df, place = tables[name], f"{root}/versions/{version}/{name}"
        write_parquet(df, place, "errorifexists")
        rows = spark.read.schema(df.schema).parquet(place).count()  # read off the footers
        return version, len(tables), name, place, rows, df.schema.json()

    entries = together(spark, entry, tables)
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The manifest rows of all complete versions."""
    try:
        rows = spark.read.schema(_MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)
    whole = rows.groupBy("version", "tables").count().where("count = tables").select("version")
    return rows.join(F.broadcast(whole), "version", "left_semi")  # a row for each version


def read_published(spark: SparkSession, path: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of a version, the last complete one unless it is named."""
    found = versions(spark, path)
    wanted = version or found.agg(F.max("version")).first()[0]
    entries = found.where(F.col("version") == F.lit(wanted)).collect()  # a row for each table
    if not entries:
        raise FileNotFoundError(f"no complete version {wanted or ''} of a bundle at {path}")
    return {
        r["table"]: spark.read.schema(StructType.fromJson(json.loads(r["schema"]))).parquet(r["path"]) for r in entries
    }
