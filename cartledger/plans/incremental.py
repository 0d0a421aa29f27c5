"""The sales mart by year of purchase, of which a run replaces only the years that changed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartledger.operators.derive import PURCHASED
from cartledger.plans import marts
from cartledger.sources.layouts import YEAR, in_years, write_years

#: What a mart of a year is made of: its orders, and the rows that belong to them.
PARTS = ("orders", "order_items", "payments")
_LEDGER = "run bigint, purchase_year int, fingerprint string"


def _digest(df: DataFrame, *more) -> DataFrame:
    """(order_id, ..., n, total) of a table: its rows by order, in any order of rows."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)]).cast("decimal(38,0)")
    return df.groupBy("order_id", *more).agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("total"))


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(purchase_year, fingerprint) of cleaned orders, items and payments.

    A year's fingerprint changes with any row of an order of that year. Items and payments are
    reduced to a row an order before they meet it.
    """
    found = _digest(tables["orders"], F.year(PURCHASED).alias(YEAR))
    for name in PARTS[1:]:
        own = _digest(tables[name]).toDF("order_id", f"{name}_n", f"{name}_total")
        found = found.join(own, "order_id", "left")
    given = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in found.columns if c != YEAR]
    each = F.xxhash64(*given).cast("decimal(38,0)")
    return found.groupBy(YEAR).agg(F.concat_ws("-", F.count(F.lit(1)), F.sum(each)).alias("fingerprint"))


class SalesByYear:
    """The sales mart under ``root``: a partition for each year, and a ledger of their fingerprints.

    Partitions are replaced before the ledger names their fingerprints, so a run that dies
    between is repeated for those years. A year that no order has any more is no longer in the
    ledger's last run, and so not read.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.mart, self.ledger = f"{self.root}/sales_by_year", f"{self.root}/ledger"

    def _known(self) -> list:
        """The ledger rows of the last complete run, one a year."""
        try:
            rows = self.spark.read.schema(_LEDGER).parquet(self.ledger)
        except AnalysisException:
            return []
        last = rows.agg(F.max("run")).first()[0]
        return rows.where(F.col("run") == F.lit(last)).collect() if last is not None else []

    def refresh(self, tables: Mapping[str, DataFrame]) -> list[int | None]:
        """Bring the mart up to date with cleaned tables; returns the years that were replaced.

        The tables are read for their fingerprints and again for the years that changed, so hand in
        stored ones. In buckets by order (``layouts.write_bucketed``) they are not exchanged at all.
        """
        known = self._known()
        before = {r[YEAR]: r["fingerprint"] for r in known}
        now = {r[YEAR]: r["fingerprint"] for r in fingerprints(tables).collect()}  # a row a year
        changed = sorted((y for y in now if before.get(y) != now[y]), key=lambda y: (y is not None, y))
        if changed:
            orders, items, payments = (tables[t] for t in PARTS)
            if len(changed) < len(now):
                orders = orders.where(in_years(changed, F.year(PURCHASED)))
                ids = orders.select("order_id")
                items, payments = (df.join(ids, "order_id", "left_semi") for df in (items, payments))
            write_years(marts.sales_summary(orders, items, payments), self.mart, PURCHASED)
        if changed or before.keys() != now.keys():
            run = max((r["run"] for r in known), default=0) + 1
            rows = [(run, y, f) for y, f in now.items()]
            # One file: the run is in the ledger as a whole or not at all.
            self.spark.createDataFrame(rows, _LEDGER).coalesce(1).write.mode("append").parquet(self.ledger)
        return changed

    def read(self, years=None) -> DataFrame:
        """The mart, or some years of it; only their partitions are read."""
        valid = [r[YEAR] for r in self._known()]
        if years is not None:
            valid = [y for y in valid if y in set(years)]
        if not valid:
            raise FileNotFoundError(f"no year of {years or 'the mart'} in {self.root}")
        return self.spark.read.parquet(self.mart).where(in_years(valid))
