"""Times the reports and the main tables, warm, median of three; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import duckdb  # noqa: E402
import pyspark  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from cartledger.checks.compare import connect  # noqa: E402
from cartledger.checks.oracle import oracle_sql  # noqa: E402
from cartledger.checks.registry import queries  # noqa: E402
from cartledger.plans.reports import REPORTS  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
NAMES = [*REPORTS, "mart_sales_summary", "jn_orders_items", "cln_dedup_key", "prf_quality_lineitem"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _warm_median(run) -> float:
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    spark = session()
    query, sql = queries(), oracle_sql()
    ours, theirs = {}, {}
    with connect(SF_DIR) as con:
        con.execute(f"SET threads TO {int(CPUS)}")
        for name in NAMES:
            ours[name] = _warm_median(
                lambda name=name: query[name](spark, SF_DIR).write.format("noop").mode(
                    "overwrite"
                ).save()
            )
            theirs[name] = _warm_median(lambda name=name: con.execute(sql[name]).fetchall())
            print(f"{name}: {ours[name]} s, DuckDB {theirs[name]} s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "sum of warm medians, reports and main tables",
                "value": round(sum(ours.values()), 3),
                "unit": "sec",
                "queries": ours,
                "duckdb": theirs,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "pyspark": pyspark.__version__,
                "duckdb_version": duckdb.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
