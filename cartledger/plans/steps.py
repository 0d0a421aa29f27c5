"""A ledger of finished steps, by which a run that died goes on where it was."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_STEPS = "step string, table string, fingerprint string, finished bigint"


def digest(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(str, parts)).encode()).hexdigest()


def files_fingerprint(spark: SparkSession, path: str) -> str:
    """A fingerprint of the names, lengths and times of the files at a path; contents are not read."""
    try:
        files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    row = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    return digest(*files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(row)).first())


class Ledger:
    """Finished steps under ``path``: of each (step, table) the fingerprint of what it was made from.

    An entry is appended as one file after the step's output is written, so a step is either
    finished or done again, and only the last entry of a step holds. Without a path nothing is
    kept, no fingerprint is looked for, and every step runs. Steps may run at the same time; their
    entries are written one after the other, as two writers of one folder would drop each other's files.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        self.writing = Lock()
        self.finished: dict[tuple[str, str], str] = {}
        #: Fingerprints of what this run has at hand, by table, and steps that it took over.
        self.at_hand: dict[str, str] = {}
        self.taken: set[tuple[str, str]] = set()
        if path:
            try:
                rows = spark.read.schema(_STEPS).parquet(path)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                return
            last = rows.groupBy("step", "table").agg(F.max_by("fingerprint", "finished").alias("fingerprint"))
            self.finished = {(r["step"], r["table"]): r["fingerprint"] for r in last.collect()}  # a row for each step

    def run(
        self, step: str, table: str, inputs: Callable[[], str], make: Callable[[], DataFrame], read: Callable[[], DataFrame]
    ) -> DataFrame:
        """What ``make`` writes and returns, or what ``read`` finds where that was done before from
        inputs of the same fingerprint."""
        if not self.path:
            return make()
        fingerprint = digest(step, table, inputs())
        if self.finished.get((step, table)) == fingerprint:
            self.taken.add((step, table))
            return read()
        made = make()
        entry = (step, table, fingerprint, time.time_ns())
        with self.writing:
            self.spark.createDataFrame([entry], _STEPS).coalesce(1).write.mode("append").parquet(self.path)
        self.finished[step, table] = fingerprint
        return made
