"""First lines of many files, read by tasks."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Lines of a file that Python looks at first. A file whose header goes on beyond them is looked at as a whole.
LINES = 4096
#: Files are cut at this many bytes, or not at all where they are looked at as a whole.
TASK_BYTES, WHOLE_BYTES = 1 << 27, 1 << 36


def _file_per_task(spark: SparkSession, task_bytes: int) -> SparkSession:
    """A session with the caller's settings, but for how files are dealt to tasks: no two share one."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", task_bytes)
    own.conf.set("spark.sql.files.openCostInBytes", task_bytes)
    return own


def _first_lines(
    spark: SparkSession, paths: str | list[str], multi_line: bool, quote: str, comment: str, whole: bool
) -> list[tuple[str | None, list[str]]]:
    """(header, files), where null stands for files that have to be looked at as a whole."""
    task_bytes = WHOLE_BYTES if whole else TASK_BYTES
    lines = _file_per_task(spark, task_bytes).read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.col("_metadata.file_size").alias("size"), "value",
        # The lower 33 bits number the lines of a task.
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("line"),
    )
    # Lines that are of no use are dropped before they travel to a Python worker.
    lines = lines.where("at = 0" if whole else f"at = 0 AND line < {LINES}").select("file", "size", "value")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        header, done, seen, last = "", False, 0, None
        for batch in batches:  # to the end, so the worker can go on with the next file
            if done or not batch.num_rows:
                continue
            seen, last = seen + batch.num_rows, batch.slice(0, 1)
            for line in batch.column(2).to_pylist():
                if not header and (not line.strip() or comment and line.startswith(comment)):
                    continue
                header = f"{header}\n{line}" if header else line
                if not multi_line or header.count(quote) % 2 == 0:
                    done = True
                    break
        cut = not whole and last is not None and (seen >= LINES or last.column(1)[0].as_py() > task_bytes)
        if done or cut:
            yield pa.RecordBatch.from_arrays(
                [last.column(0), pa.array([header if done else None], pa.string())], names=["file", "header"]
            )

    found = lines.mapInArrow(first, "file string, header string")
    grouped = found.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return [(r["header"], [unquote(f) for f in r["files"]]) for r in grouped.collect()]


def header_groups(
    spark: SparkSession, path: str, multi_line: bool = False, quote: str = '"', comment: str = ""
) -> list[tuple[str, list[str]]]:
    """(header line, files) of the files under ``path`` that begin with the same line.

    The list of files is dealt to tasks, and only the first lines of each reach Python, so any
    number of files of any length takes one query; files whose header is not among those lines
    take another. Blank lines and comments before the header are passed over; with ``multi_line``
    a header goes on while a quote is open. Files without a line are in no group. Only different
    headers and file names reach the driver.
    """
    groups: dict[str | None, list[str]] = {}
    found = _first_lines(spark, path, multi_line, quote, comment, whole=False)
    longer = [f for header, files in found if header is None for f in files]
    if longer:
        found += _first_lines(spark, longer, multi_line, quote, comment, whole=True)
    for header, files in found:
        if header is not None:
            groups.setdefault(header, []).extend(files)
    return sorted(((header, sorted(files)) for header, files in groups.items()), key=lambda g: g[1][0])
