"""What each step took in and gave out."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cartledger.sources.readers import REJECTED


def _rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


@dataclass
class AuditLog:
    """Steps of a run, in order. Row counts are taken from written tables, where
    they are read off the file footers and cannot be inflated by a retried task."""

    entries: list[DataFrame] = field(default_factory=list)
    rejections: list[DataFrame] = field(default_factory=list)
    finished: dict[tuple[str, str], datetime] = field(default_factory=dict)

    def done(self, step: str, table: str) -> None:
        """Note when a step ended that is recorded later; steps at the same time are recorded in order."""
        self.finished[step, table] = datetime.now(timezone.utc).replace(tzinfo=None)

    def record(
        self, step: str, table: str, before: DataFrame | None, after: DataFrame | int | None, taken_over: bool = False
    ) -> None:
        """A step from one stored table to another; ``after`` may be a known number of rows.

        ``taken_over`` says that an earlier run did it. Without ``before`` the step began outside. Where the table written has the column
        ``REJECTED``, the values that did not fit their type are counted by column.
        """
        now = self.finished.get((step, table)) or datetime.now(timezone.utc).replace(tzinfo=None)
        read = F.lit(None).cast("bigint") if before is None else _rows(before, "n").scalar()
        if isinstance(after, DataFrame):
            counted = _rows(after, "rows_out")
        else:
            counted = before.sparkSession.range(1).select(
                F.lit(after).cast("bigint").alias("rows_out")
            )
        self.entries.append(
            counted.select(
                F.lit(len(self.entries)).alias("position"),
                F.lit(now).cast("timestamp_ntz").alias("ts"),
                F.lit(step).alias("step"),
                F.lit(table).alias("table"),
                read.alias("rows_in"),
                "rows_out",
                F.lit(taken_over).alias("taken_over"),
            )
        )
        if isinstance(after, DataFrame) and REJECTED in after.columns:
            self.rejections.append(
                after.select(F.explode(REJECTED).alias("column")).groupBy("column")
                .agg(F.count(F.lit(1)).alias("rejected"))
                .select(F.lit(step).alias("step"), F.lit(table).alias("table"), "column", "rejected")
            )

    def counts(self) -> DataFrame:
        """One row per step, with the rows it removed or added."""
        log = reduce(DataFrame.unionByName, self.entries)
        return log.withColumn("removed", F.col("rows_in") - F.col("rows_out"))

    def rejected(self) -> DataFrame | None:
        """(step, table, column, rejected): values lost for not fitting their type."""
        return reduce(DataFrame.unionByName, self.rejections) if self.rejections else None
