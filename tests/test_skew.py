"""Joins over data in which a third of the rows share one key."""

import pytest
from pyspark.sql import functions as F

from cartledger.operators.skew import (
    SkewPolicy,
    fits_broadcast,
    hot_keys,
    lookup_join,
    split_hot_join,
)

POLICY = SkewPolicy(share=0.01, min_rows=1000, rows_per_part=2000)
NOTHING_FITS = SkewPolicy(0.01, 1000, 2000, broadcast_rows=10)


@pytest.fixture(scope="module")
def many(spark):
    """A third under key 7, a third without a key, a third even; half are exact copies."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 3 == 1, n % 500)
    df = spark.range(0, 60_000, 1, 8)
    return df.select(key.alias("k"), (n % 2).alias("v"))


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))


def totals(df):
    row = F.xxhash64("k", "v", "w").cast("decimal(38,0)")
    return df.agg(F.count("*"), F.count("w"), F.sum("w"), F.sum(row)).first()


def test_only_the_hot_keys_are_found(many):
    assert hot_keys(many, "k", POLICY) == {7: 11, None: 10}
    assert hot_keys(many, "k") == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_split_join_returns_what_a_plain_join_does(many, one, how):
    assert totals(split_hot_join(many, one, "k", how, POLICY)) == totals(many.join(one, "k", how))
    assert totals(lookup_join(many, one, "k", how, NOTHING_FITS)) == totals(
        many.join(one, "k", how)
    )
    assert totals(lookup_join(many, one, "k", how)) == totals(many.join(one, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_no_task_gets_the_hot_key_whole(spark, many, one, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = split_hot_join(many, one, "k", how, POLICY)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(r["count"] for r in sizes) < 15_000


def test_frequent_nulls_alone_are_split(many, one):
    sparse = many.filter("k IS NULL OR k <> 7")
    assert hot_keys(sparse, "k", POLICY) == {None: 10}
    for how in ("inner", "left"):
        got = split_hot_join(sparse, one, "k", how, POLICY)
        assert totals(got) == totals(sparse.join(one, "k", how))


def test_hot_keys_may_be_counted_elsewhere(many, one):
    """Counting in another table moves rows differently and returns the same ones."""
    plain = totals(many.join(one, "k", "left"))
    for other in (many.filter("k = 7"), many.filter("k < 3"), many.limit(0)):
        got = split_hot_join(many, one, "k", "left", POLICY, keys_of=other)
        assert totals(got) == plain


def test_size_is_measured_in_rows_and_bytes(spark):
    assert fits_broadcast(spark.range(100), SkewPolicy(broadcast_rows=100))
    assert not fits_broadcast(spark.range(101), SkewPolicy(broadcast_rows=100))
    long_text = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert not fits_broadcast(long_text, SkewPolicy(broadcast_bytes=9000))
    assert fits_broadcast(spark.range(0))


def test_other_join_kinds_are_refused(many, one):
    with pytest.raises(ValueError):
        split_hot_join(many, one, "k", "full")
