import datetime as dt
import glob
import uuid

import pytest
from conftest import bag
from pyspark.sql import functions as F

from cartledger.sources import read_parquet, sinks


@pytest.fixture
def target(spark, tmp_path):
    return sinks.CatalogTarget(str(tmp_path / "tables"))


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def test_parquet_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_parquet(spark.range(3), path)
    sinks.write_parquet(spark.range(2), path)
    sinks.write_parquet(spark.range(2), path, "append")
    assert bag(read_parquet(spark, path)) == [(0,), (0,), (1,), (1,)]


def test_csv_text(spark, tmp_path):
    df = spark.createDataFrame(
        [("a,b", None, dt.datetime(2024, 1, 2)), ('say "é"', "", None)],
        "s string, t string, d timestamp_ntz",
    ).coalesce(1)
    sinks.write_csv(df, str(tmp_path / "c"))
    (file,) = glob.glob(str(tmp_path / "c" / "part-*"))
    text = open(file, encoding="utf-8").read().splitlines()
    assert text == ["s,t,d", '"a,b",,2024-01-02 00:00:00', '"say ""é""",,']


def test_bundle_manifest(spark, tmp_path):
    manifest = sinks.write_bundle(
        spark, {"a": spark.range(3), "b": spark.range(0)}, str(tmp_path / "x")
    )
    assert bag(manifest, "table", "rows", "schema") == [
        ("a", 3, "struct<id:bigint>"),
        ("b", 0, "struct<id:bigint>"),
    ]
    for row in manifest.collect():
        assert read_parquet(spark, row.path).count() == row.rows


def test_load_modes(spark, target, name):
    assert not sinks.table_exists(spark, target, name)
    assert sinks.load_table(spark.range(3), target, name, "fail") == 3
    assert sinks.table_exists(spark, target, name)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        sinks.load_table(spark.range(3), target, name, "fail")
    assert sinks.load_table(spark.range(2), target, name, "append") == 2
    assert sinks.row_count(spark, target, name).first().rows == 5
    assert sinks.load_table(spark.range(1), target, name) == 1
    assert sinks.row_count(spark, target, name).first().rows == 1
    with pytest.raises(ValueError):
        sinks.load_table(spark.range(1), target, name, "upsert")


def test_an_empty_table_loads(spark, target, name):
    assert sinks.load_table(spark.range(10).filter("id < 0"), target, name) == 0


def test_rows_are_counted_after_a_shuffle(spark, target, name):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sinks.load_table(df, target, name) == 7


def test_one_failing_table_does_not_stop_the_others(spark, target, name):
    bad = spark.range(3).select(F.concat(F.lit("x"), F.col("id")).cast("int").alias("n"))
    results = sinks.load_tables(
        spark, {f"{name}_a": spark.range(3), f"{name}_b": bad, f"{name}_c": spark.range(2)}, target
    ).collect()
    assert [(r.ok, r.rows) for r in results] == [(True, 3), (False, None), (True, 2)]
    assert "CAST_INVALID_INPUT" in results[1].error


def test_jdbc_write_options():
    target = sinks.JdbcTarget("jdbc:x", {"user": "u"}, connections=4)
    assert target.options("t") == {
        "url": "jdbc:x",
        "dbtable": "t",
        "batchsize": "1000",
        "numPartitions": "4",
        "truncate": "false",
        "user": "u",
    }
