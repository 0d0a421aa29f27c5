"""Layouts, partial and resumed runs, versions of bundles, copies and modes in few bytes."""

import datetime as dt
import glob
import os
import random
from collections import Counter

import pytest
from conftest import bag
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartledger.checks import registry
from cartledger.operators import cleaning, copies, frequent
from cartledger.operators.skew import SkewPolicy
from cartledger.plans import etl, incremental, marts, quality, star_mapping as star
from cartledger.plans.incremental import PARTS, SalesByYear
from cartledger.plans.steps import Ledger
from cartledger.sources import layouts, publish


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_mart_over_buckets_has_no_exchange(spark, sf_dir, tmp_path, no_broadcast):
    raw = {
        t: layouts.write_bucketed(getattr(star, t)(spark, sf_dir), f"{tmp_path}/{t}", "order_id", 4) for t in PARTS
    }
    cleaned = marts.build_all(raw)
    plan = physical(marts.sales_summary(*(cleaned[t] for t in PARTS)))
    assert "Bucketed: true" in plan and "Exchange" not in plan
    path = f"{tmp_path}/orders"
    spark.sql(f"DROP TABLE {layouts._bucket_table(path)}")
    again = layouts.open_bucketed(spark, path, "order_id", 4)
    assert "Exchange" not in physical(again.groupBy("order_id").count())
    assert bag(again) == bag(star.orders(spark, sf_dir))


def test_buckets_grow_with_the_longest_table(spark, sf_dir, tmp_path, no_broadcast):
    parts = [getattr(star, t)(spark, sf_dir) for t in PARTS]
    longest = max(df.count() for df in parts)
    assert layouts.buckets_for(parts, 8) == 8
    assert layouts.buckets_for(parts, 8, 100) == -(-longest // 100) > 8
    raw = registry._bucketed(spark, sf_dir, rows_per_bucket=300)
    n = -(-longest // 300)
    assert all(f"SelectedBucketsCount: {n} out of {n}" in physical(df.groupBy("order_id").count()) for df in raw.values())
    items = raw["order_items"].groupBy(F.input_file_name()).count().collect()
    assert len(items) <= n and max(r["count"] for r in items) < 600
    cleaned = marts.build_all(raw)
    assert "Exchange" not in physical(marts.sales_summary(*(cleaned[t] for t in PARTS)))


def test_a_hot_key_is_not_put_in_one_bucket(spark, tmp_path):
    rows = spark.range(600).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-1).alias("k"))
    policy = SkewPolicy(share=1 / 4, min_rows=10)
    stored = layouts.write_bucketed(rows, str(tmp_path / "t"), "k", 4, policy)
    assert "Bucketed: true" not in physical(stored) and stored.count() == 600
    even = layouts.write_bucketed(spark.range(600), str(tmp_path / "t"), "id", 4, policy)
    assert even.count() == 600


def _orders(spark, rows):
    data = [(i, f"c{i}", "x", when, None, None) for i, when in rows]
    names = "order_id long, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    return spark.createDataFrame(data, names + "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")


def _tables(spark, orders, items):
    data = [(o, n, p, 0.5) for o, n, p in items]
    lines = spark.createDataFrame(data, "order_id long, order_item_id int, price double, freight_value double")
    lines = lines.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")})
    pays = lines.select("order_id", F.col("order_item_id").alias("payment_sequential"), F.col("price").alias("payment_value"))
    return marts.build_all({"orders": _orders(spark, orders), "order_items": lines, "payments": pays})


def _mart(df):
    columns = ["order_id", "purchase_year", "total_items", "total_price", "total_payment"]
    return bag(df.select(*columns))


def test_only_changed_years_are_replaced(spark, tmp_path):
    day = lambda y: dt.datetime(y, 3, 4)
    orders = [(1, day(2016)), (2, day(2017)), (3, day(2018)), (4, None), (None, day(2016))]
    items = [(1, 1, 5.0), (2, 1, 6.0), (2, 2, 7.0), (9, 1, 1.0)]
    sales = SalesByYear(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        sales.read()
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/sales_by_year/*/part-*")}

    def refreshed(orders, items):
        tables = _tables(spark, orders, items)
        changed = SalesByYear(spark, str(tmp_path)).refresh(tables)
        assert _mart(sales.read()) == _mart(marts.sales_summary(*(tables[t] for t in PARTS)))
        return changed

    assert refreshed(orders, items) == [None, 2016, 2017, 2018]
    first = files()
    assert refreshed(orders, items) == [] and files() == first
    assert refreshed(orders, [*items, (2, 3, 1.0)]) == [2017]
    assert {f for f in first if "=2017" not in f} == {f for f in files() if "=2017" not in f}
    moved = [(1, day(2017)), *orders[1:]]
    assert refreshed(moved, items) == [2016, 2017]
    assert refreshed(moved[:2] + moved[3:], items) == []  # 2018 has no order any more
    assert refreshed(moved, items) == [2018]
    plan = physical(sales.read([2017]))
    assert "PartitionFilters: [isnotnull(purchase_year" in plan or "PartitionFilters: [(purchase_year" in plan
    assert _mart(sales.read([None])) == [(4, None, None, None, None)]


def test_a_refresh_from_buckets_exchanges_no_rows(spark, sf_dir, no_broadcast, monkeypatch):
    written, compared = [], []
    write, compare = incremental.write_years, incremental.fingerprints

    def kept_write(df, *where):
        written.append(physical(df))
        write(df, *where)

    def kept_compare(tables):
        found = compare(tables)
        compared.append(physical(found))
        return found

    monkeypatch.setattr(incremental, "write_years", kept_write)
    monkeypatch.setattr(incremental, "fingerprints", kept_compare)
    assert registry._etl_incremental(spark, sf_dir).count() > 0
    assert len(written) == len(compared) == 2
    assert not any("Exchange" in plan for plan in written)
    assert "LeftSemi" not in written[0] and "LeftSemi" in written[1]  # all years at first, then one
    assert [plan.count("Exchange") for plan in compared] == [1, 1]  # a row a year and task


def test_a_bundle_is_seen_whole(spark, tmp_path):
    path = str(tmp_path / "b")
    good, more = spark.range(3), spark.range(5).select(F.col("id").alias("a b"))
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, path)
    first = publish.publish_bundle(spark, {"one": good, "two": more}, path)
    broken = spark.range(2).select(F.assert_true(F.col("id") > 5))
    with pytest.raises(PySparkException):
        publish.publish_bundle(spark, {"one": spark.range(9), "two": more, "three": broken}, path)
    assert {t: df.count() for t, df in publish.read_published(spark, path).items()} == {"one": 3, "two": 5}
    publish.publish_bundle(spark, {"one": spark.range(4)}, path)
    assert {t: df.count() for t, df in publish.read_published(spark, path).items()} == {"one": 4}
    assert publish.read_published(spark, path, first)["two"].columns == ["a b"]
    assert publish.versions(spark, path).count() == 3


def test_a_run_goes_on_where_its_inputs_are_the_same(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    (source / "customers_dataset.csv").write_text("customer_id,customer_city\nc1,x\n", encoding="utf-8")
    sellers = source / "sellers_dataset.csv"
    sellers.write_text("seller_id,seller_city\ns1,x\n", encoding="utf-8")
    cfg = etl.EtlConfig(str(source), str(tmp_path / "out"), export="parquet", resume=True)
    taken = lambda result: {(r.step, r.table) for r in result.audit.filter("taken_over").collect()}
    assert taken(etl.run(spark, cfg)) == set()
    both = {(s, t) for s in ("extract", "clean") for t in ("customers", "sellers")}
    assert taken(etl.run(spark, cfg)) == both
    old = sellers.read_text()
    sellers.write_text("seller_id,seller_city\ns1,x\ns2,y\n", encoding="utf-8")
    result = etl.run(spark, cfg)
    assert taken(result) == {t for t in both if t[1] == "customers"}
    assert result.tables["sellers"].count() == 2
    # What was there two runs ago is not there any more.
    sellers.write_text(old, encoding="utf-8")
    result = etl.run(spark, cfg)
    assert taken(result) == {t for t in both if t[1] == "customers"}
    assert result.tables["sellers"].count() == 1


def test_a_step_is_finished_when_its_entry_is_written(spark, tmp_path):
    path = str(tmp_path / "ledger")

    def dies():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        Ledger(spark, path).run("s", "t", lambda: "f", dies, dies)
    assert Ledger(spark, path).run("s", "t", lambda: "f", lambda: 1, dies) == 1
    assert Ledger(spark, path).run("s", "t", lambda: "f", dies, lambda: 2) == 2
    assert Ledger(spark, path).run("s", "t", lambda: "g", lambda: 3, dies) == 3


AWKWARD = [(1, 0.0, "a", [1]), (1, -0.0, "a", [1]), (None, None, None, None), (None, None, None, None),
           (2, float("nan"), None, []), (2, float("nan"), None, []), (3, 1.0, "x", None), (None, 1.0, "x", None)]


def test_copies_in_two_passes(spark, tmp_path, no_broadcast):
    rows = AWKWARD + [(i % 50, 0.5, "y", [i % 50]) for i in range(75)] + [(9, 9.0, "hot", None)] * 60
    spark.createDataFrame(rows, "i long, `x.y` double, _hash string, l array<int>").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    got = copies.drop_duplicate_rows_two_pass(df)
    text = lambda d: Counter(str(tuple(r)).replace("-0.0", "0.0") for r in d.collect())
    assert text(got) == text(cleaning.drop_duplicate_rows(df))
    # Whole rows are exchanged under the semi join only.
    plan = physical(copies.drop_duplicate_rows_two_pass(df))
    kept = plan[: plan.index("LeftSemi")]
    assert "LeftAnti" in kept and plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    many = copies.drop_duplicate_rows_two_pass(df, SkewPolicy(broadcast_rows=3))
    assert text(many) == text(got) and "LeftAnti" not in physical(many)
    assert copies.drop_duplicate_rows_two_pass(df.limit(0)).collect() == []


def test_first_rows_by_key_in_two_passes(spark, tmp_path):
    rows = [(1, "a", 5), (1, "a", 3), (None, "a", 2), (None, "a", 1), (None, None, 4), (2, None, 6), (None, "b", 7)]
    rows += [(i, "c", i) for i in range(50)] + [(60, "hot", i) for i in range(40)]
    spark.createDataFrame(rows, "i long, k string, _hash int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for keys in (["i", "k"], ["k"], ["_hash", "i"]):
        got = copies.drop_duplicate_keys_two_pass(df, keys, ["_hash", "i", "k"])
        assert bag(got) == bag(cleaning.drop_duplicate_keys(df, keys, ["_hash", "i", "k"]))
    many = copies.drop_duplicate_keys_two_pass(df, ["k"], ["_hash"], SkewPolicy(broadcast_rows=1))
    assert "LeftAnti" not in physical(many) and len(many.collect()) == 5


def test_stored_tables_without_copies_are_cleaned_where_they_lie(spark, tmp_path):
    tables = {
        "orders": spark.range(40).selectExpr("cast(id as string) AS order_id", "'a' AS order_status", "id AS _row"),
        "order_items": spark.range(40).selectExpr("cast(id as string) AS order_id", "id AS price", "id AS _row"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
    raw = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in tables}
    for name, build in marts.builders(raw, raw).items():
        plan = physical(build())
        assert "Exchange" not in plan and "Window" not in plan and "_row" not in plan
        assert bag(build()) == bag(marts.build_all(raw)[name])
        assert bag(marts.builders({name: raw[name].union(raw[name])}, [name])[name]()) == bag(build())


def test_mode_from_summaries(spark):
    draw = random.Random(5)
    shapes = {
        "hot": [draw.choice(["h", "h", "h", *map(str, range(300))]) for _ in range(2_000)],
        "unique": [str(i) for i in range(2_000)],
        "tied": [str(i % 500) for i in range(2_000)],
        "two": ["b", "a"] * 1_000,
        "gaps": [None if i % 2 else "z" for i in range(2_000)],
        "none": [None] * 2_000,
    }
    df = spark.createDataFrame(list(zip(*shapes.values())), ", ".join(f"{c} string" for c in shapes)).repartition(5)
    for name, values in shapes.items():
        counts = Counter(v for v in values if v is not None)
        want = min(counts, key=lambda v: (-counts[v], v)) if counts else None
        value, decided = frequent.most_frequent(df, name, counters=16, candidates=40)
        assert value == want and decided == (name not in ("unique", "tied"))
    numbers = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (float("nan"),), (1.0,), (None,)], "x double")
    assert frequent.most_frequent(numbers, "x") == (0.0, True)
    assert bag(frequent.fill_mode_from_summaries(numbers)) == bag(cleaning.fill_mode(numbers))
    assert frequent.most_frequent(numbers.limit(0), "x") == (None, True)
    filled = frequent.fill_mode_from_summaries(df, ["hot", "gaps", "none"])
    assert bag(filled) == bag(cleaning.fill_mode(df, ["hot", "gaps", "none"]))


def test_summaries_are_bounded():
    counts, cut = frequent.reduced({v: v for v in range(1, 11)}, 4)
    assert cut == 6 and counts == {7: 1, 8: 2, 9: 3, 10: 4}


def test_sketches_merge(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 7).cast("double").alias("d"), F.lit(None).cast("string").alias("n"))
    parts = quality.column_sketches(df.filter("id < 9000")).union(quality.column_sketches(df.filter("id >= 5000")))
    rows = {r.Columna: r for r in quality.quality_report_from_sketches(parts).collect()}
    assert abs(rows["id"].Valores_Unicos - 20_000) < 1_000 and rows["id"].No_Nulos == 24_000
    assert rows["d"].Valores_Unicos == 7 and (rows["n"].Valores_Unicos, rows["n"].Nulos) == (0, 24_000)
