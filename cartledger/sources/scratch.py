"""Folder for tables that are written and read again within a run."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-")


def run_folder(spark: SparkSession) -> str:
    """The one folder that holds all scratch tables of this application.

    It lies in the cluster's shared ``spark.checkpoint.dir``; whoever owns the run removes
    it when the results are written. Only in local mode, where the executors are this
    very process, may that be unset: a cluster would spread the rows over its disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder to run on {master}")
        base = _local_base()
    return f"{base.rstrip('/')}/cartledger-{spark.sparkContext.applicationId}"


def release_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished work go.

    Spark removes them once the driver has collected what stands for them, which a driver with
    little to do puts off for half an hour.
    """
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the run's folder."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
