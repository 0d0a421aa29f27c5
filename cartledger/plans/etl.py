"""Extract, transform and load as one run.

Every phase writes its tables and the next one reads them back, so a lost executor
costs at most the phase at hand, no table is computed twice, and row counts come
from file footers. Within a phase some tables are worked on at the same time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from cartledger.plans import marts
from cartledger.plans.audit import AuditLog
from cartledger.plans.incremental import PARTS, SalesByYear
from cartledger.plans.quality import quality_report, run_summary
from cartledger.plans.steps import Ledger, digest, files_fingerprint
from cartledger.sources import (
    REJECTED,
    read_catalog,
    read_csv,
    read_parquet,
    with_file_position,
)
from cartledger.sources.layouts import stored_table, write_bucketed
from cartledger.sources.publish import publish_bundle, read_published
from cartledger.sources.scratch import release_shuffles
from cartledger.sources.sinks import (
    Target,
    load_tables,
    write_csv,
    write_parquet,
)
from cartledger.sources.together import together

EXPORT_FORMATS = ("csv", "parquet", "bundle", "all")
# The tables of the bundle.
BUNDLE_TABLES = ("orders", "sales_summary", "products", "customers")


@dataclass(frozen=True)
class EtlConfig:
    source: str
    output: str
    prefix: str = ""
    source_format: str = "csv"
    export: str = "csv"
    target: Target | None = None
    infer: bool = False
    day_first: bool = False
    dates_by_column: bool = False
    #: Buckets by order of the landed orders, items and payments; none lands them plainly. A task
    #: takes a bucket, so longer tables need more (``layouts.buckets_for``).
    buckets: int | None = None
    #: Keep the sales mart by year of purchase and replace only the years that changed.
    incremental: bool = False
    #: Go on where an earlier run into the same output stopped, as far as its inputs are the same.
    resume: bool = False

    def __post_init__(self):
        if self.export not in EXPORT_FORMATS:
            raise ValueError(f"export must be one of {EXPORT_FORMATS}, not {self.export!r}")


@dataclass
class EtlResult:
    tables: dict[str, DataFrame]
    missing: list[str]
    audit: DataFrame
    rejected: DataFrame | None
    summary: DataFrame
    quality: DataFrame | None
    loads: DataFrame | None
    seconds: float


def _store(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return read_parquet(spark, path)


def _ledger(spark: SparkSession, cfg: EtlConfig) -> Ledger:
    return Ledger(spark, f"{cfg.output}/ledger" if cfg.resume else None)


def extract(
    spark: SparkSession, cfg: EtlConfig, audit: AuditLog, ledger: Ledger | None = None
) -> tuple[dict[str, DataFrame], list[str]]:
    """Land the source tables as Parquet, each row with its place in the file.

    From CSV each row also names its fields that did not fit their type; the audit counts
    them. Types that are not declared are inferred here, once, if asked for.
    """
    ledger = ledger or _ledger(spark, cfg)
    csv = cfg.source_format == "csv"
    options = {
        "infer": cfg.infer, "day_first": cfg.day_first, "dates_by_column": cfg.dates_by_column,
        "rejects": REJECTED, "file_position": True,
    }

    def land(name: str, path: str, opened: Callable[[], DataFrame]) -> DataFrame:
        output = f"{cfg.output}/landing/{name}"

        def inputs() -> str:
            ledger.at_hand[name] = digest(files_fingerprint(spark, path), cfg.source_format, options, cfg.buckets)
            return ledger.at_hand[name]

        def make() -> DataFrame:
            placed = opened() if csv else with_file_position(opened())
            if cfg.buckets and name in PARTS and "order_id" in placed.columns:
                return write_bucketed(placed, output, "order_id", cfg.buckets)
            return _store(spark, placed, output)

        landed = ledger.run("extract", name, inputs, make, lambda: stored_table(spark, output))
        audit.done("extract", name)
        return landed

    found = read_catalog(
        spark, cfg.source, cfg.prefix, fmt=cfg.source_format, land=land, **(options if csv else {})
    )
    if not found.tables:
        raise FileNotFoundError(f"no known table under {cfg.source}")
    for name, landed in found.tables.items():
        audit.record("extract", name, None, landed, ("extract", name) in ledger.taken)
    return found.tables, found.missing


def transform(
    spark: SparkSession, cfg: EtlConfig, landed: dict[str, DataFrame], audit: AuditLog, ledger: Ledger | None = None
) -> dict[str, DataFrame]:
    """Clean every table and build the sales mart from the cleaned ones."""
    ledger = ledger or _ledger(spark, cfg)
    raw = dict(ledger.at_hand)

    def inputs(*names: str) -> Callable[[], str]:
        # Without fingerprints of what was landed nothing is known to be the same.
        return lambda: digest(*(raw.get(n) or uuid.uuid4() for n in names if n in landed))

    def clean(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{cfg.output}/marts/{name}"
        of = inputs(name, "category_translation") if name == "products" else inputs(name)
        cleaned = ledger.run("clean", name, of, lambda: _store(spark, build(), path), lambda: read_parquet(spark, path))
        audit.done("clean", name)
        return cleaned

    # What lies in buckets by order is not exchanged anyway.
    built = marts.builders(landed, [n for n in landed if not (cfg.buckets and n in PARTS)])
    tables = dict(zip(built, together(spark, lambda t: clean(*t), built.items())))
    for name, df in tables.items():
        audit.record("clean", name, landed[name], df, ("clean", name) in ledger.taken)
    if set(PARTS) <= set(tables):
        path = f"{cfg.output}/marts"

        def by_year() -> DataFrame:
            sales = SalesByYear(spark, path)
            sales.refresh(tables)
            return sales.read()

        tables["sales_summary"] = by_year() if cfg.incremental else ledger.run(
            "summarise", "sales_summary", inputs(*PARTS),
            lambda: _store(spark, marts.sales_summary(*(tables[t] for t in PARTS)), f"{path}/sales_summary"),
            lambda: read_parquet(spark, f"{path}/sales_summary"),
        )
        taken = ("summarise", "sales_summary") in ledger.taken
        audit.record("summarise", "sales_summary", tables["orders"], tables["sales_summary"], taken)
    return tables


def load(
    spark: SparkSession, cfg: EtlConfig, tables: dict[str, DataFrame], audit: AuditLog
) -> tuple[DataFrame | None, DataFrame | None]:
    """Export the tables, profile the sales mart, and fill the database if there is one.

    Exports are always written anew: they are copies of finished tables. The bundle is
    published as a version of its own, so readers of the last one see it whole until then. The
    profile is made meanwhile.
    """
    exported = partial(_export, spark, cfg, tables, audit)
    _, quality = together(spark, lambda work: work(), [exported, partial(_profile, spark, cfg, tables)])
    loads = load_tables(spark, tables, cfg.target) if cfg.target else None
    if loads is not None:
        for r in loads.collect():  # one row per table
            audit.record("load", r["table"], tables[r["table"]], r["rows"])
    return quality, loads


def _profile(spark: SparkSession, cfg: EtlConfig, tables: dict[str, DataFrame]) -> DataFrame | None:
    if "sales_summary" not in tables:
        return None
    reports = f"{cfg.output}/reports"
    quality = _store(spark, quality_report(tables["sales_summary"]), f"{reports}/quality/sales_summary")
    release_shuffles(spark)  # all values of the mart, while the exports go on
    write_csv(quality, f"{reports}/csv/data_quality_report")
    return quality


def _export(spark: SparkSession, cfg: EtlConfig, tables: dict[str, DataFrame], audit: AuditLog) -> None:
    reports = f"{cfg.output}/reports"
    if cfg.export in ("csv", "all"):
        def as_csv(name: str) -> DataFrame:
            write_csv(tables[name], f"{reports}/csv/{name}")
            written = read_csv(spark, f"{reports}/csv/{name}", multi_line=True)
            audit.done("export_csv", name)
            return written

        for (name, df), written in zip(tables.items(), together(spark, as_csv, tables)):
            audit.record("export_csv", name, df, written)
    if cfg.export in ("parquet", "all"):
        def as_parquet(name: str) -> DataFrame:
            written = _store(spark, tables[name], f"{reports}/parquet/{name}")
            audit.done("export_parquet", name)
            return written

        for (name, df), written in zip(tables.items(), together(spark, as_parquet, tables)):
            audit.record("export_parquet", name, df, written)
    if cfg.export in ("bundle", "all"):
        chosen = {name: tables[name] for name in BUNDLE_TABLES if name in tables}
        if chosen:
            version = publish_bundle(spark, chosen, f"{reports}/bundle")
            written = read_published(spark, f"{reports}/bundle", version)
            for name, df in chosen.items():
                audit.record("export_bundle", name, df, written[name])


def run(spark: SparkSession, cfg: EtlConfig) -> EtlResult:
    """The whole run. The session is the caller's; an error in any phase is raised."""
    start = time.monotonic()
    audit, ledger = AuditLog(), _ledger(spark, cfg)
    landed, missing = extract(spark, cfg, audit, ledger)
    tables = transform(spark, cfg, landed, audit, ledger)
    release_shuffles(spark)  # the exports need the room
    quality, loads = load(spark, cfg, tables, audit)
    rejected = audit.rejected()
    if rejected is not None:
        rejected = _store(spark, rejected, f"{cfg.output}/audit/rejected")
    return EtlResult(
        tables=tables,
        missing=missing,
        audit=_store(spark, audit.counts(), f"{cfg.output}/audit/steps"),
        rejected=rejected,
        summary=run_summary(tables),
        quality=quality,
        loads=loads,
        seconds=time.monotonic() - start,
    )
