"""The nine source tables of a folder, by logical name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cartledger.sources.readers import read_csv, read_parquet
from cartledger.sources.schemas import TABLES, TableSource
from cartledger.sources.together import together


@dataclass
class Catalog:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)


def read_catalog(
    spark: SparkSession,
    root: str,
    prefix: str = "",
    files: Mapping[str, str] | None = None,
    fmt: str = "csv",
    land: Callable[[str, str, Callable[[], DataFrame]], DataFrame] | None = None,
    **csv,
) -> Catalog:
    """Open every known table found under ``root``; list those that are missing.

    A table's file is ``{prefix}{stem}.{fmt}``, or without the prefix when that
    does not exist. ``files`` overrides the file name of single tables. ``land`` is
    called with a table's name, its path, and how to open it, and returns the table. Other keywords
    go to ``read_csv``, such as ``infer`` or ``rejects``. Some tables are opened and landed at
    the same time, from threads.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown table format {fmt!r}")

    def table(name: str, source: TableSource) -> DataFrame | None:
        candidates = [f"{prefix}{source.stem}.{fmt}", f"{source.stem}.{fmt}"]
        if files and name in files:
            candidates = [files[name]]
        for file in dict.fromkeys(candidates):
            path = f"{root.rstrip('/')}/{file}"

            def opened(path=path) -> DataFrame:
                if fmt == "csv":
                    return read_csv(spark, path, source.schema, source.multi_line, **csv)
                return read_parquet(spark, path)

            try:
                return land(name, path, opened) if land else opened()
            except FileNotFoundError:
                continue
        return None

    found = Catalog()
    for name, df in zip(TABLES, together(spark, lambda t: table(*t), TABLES.items())):
        if df is None:
            found.missing.append(name)
        else:
            found.tables[name] = df
    return found
