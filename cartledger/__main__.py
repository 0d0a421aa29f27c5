"""Run the pipeline: ``spark-submit`` this module, or ``python -m cartledger``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cartledger.plans import etl
from cartledger.sources.sinks import JdbcTarget


def main() -> None:
    args = argparse.ArgumentParser(prog="cartledger", description=__doc__)
    args.add_argument("source", help="folder holding the source tables")
    args.add_argument("output", help="folder for landed tables, marts and reports")
    args.add_argument("--prefix", default="", help="what the source file names start with")
    args.add_argument("--source-format", default="csv", choices=["csv", "parquet"])
    args.add_argument("--export", default="csv", choices=etl.EXPORT_FORMATS)
    args.add_argument("--jdbc-url", help="database to load the marts into")
    given = args.parse_args()

    spark = SparkSession.builder.appName("cartledger").getOrCreate()
    try:
        cfg = etl.EtlConfig(
            source=given.source,
            output=given.output,
            prefix=given.prefix,
            source_format=given.source_format,
            export=given.export,
            target=JdbcTarget(given.jdbc_url) if given.jdbc_url else None,
        )
        result = etl.run(spark, cfg)
        print(f"{len(result.tables)} tables in {result.seconds:.1f} s; missing: {result.missing}")
        result.summary.show(truncate=False)
        if result.loads is not None:
            result.loads.show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
