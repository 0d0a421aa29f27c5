import glob
import os
import time
from threading import Barrier

import pytest

from cartledger.checks import registry
from cartledger.plans import etl, star_mapping as star
from cartledger.plans.steps import Ledger
from cartledger.sources import TABLES, read_catalog
from cartledger.sources.scratch import release_shuffles
from cartledger.sources.sinks import CatalogTarget
from cartledger.sources.together import together

FILES = {
    "customers_dataset": "Customer_ID,customer_city,customer_state\nc1,x,SP\nc2,y,RJ\nc1,z,MG\n",
    "orders_dataset": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_delivered_customer_date\n"
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-03 09:00:00\n"
        "o2,c2,shipped,2018-01-02 00:00:00,\n"
        "o1,c9,canceled,2018-01-01 10:00:00,\n"
    ),
    "order_items_dataset": (
        "order_id,order_item_id,product_id,price,freight_value\n"
        "o1,1,p1,10.00,1.50\no1,1,p1,10.00,1.50\no1,2,p2,5.25,0.00\n"
    ),
    "order_payments_dataset": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,card,2,16.75\no1,1,card,2,16.75\n"
    ),
    "products_dataset": "product_id,product_category_name\np1,cama\np2,\n",
    "product_category_name_translation": (
        "product_category_name,product_category_name_english\ncama,bed\n"
    ),
}


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "raw"
    root.mkdir()
    for name, text in FILES.items():
        prefix = "" if name.startswith("product_category") else "shop_"
        (root / f"{prefix}{name}.csv").write_text(text, encoding="utf-8")
    return str(root)


def test_full_run(spark, source, tmp_path):
    out = str(tmp_path / "out")
    cfg = etl.EtlConfig(
        source, out, prefix="shop_", export="all", target=CatalogTarget(str(tmp_path / "db"))
    )
    result = etl.run(spark, cfg)
    try:
        assert sorted(result.missing) == ["geolocation", "reviews", "sellers"]
        assert {r.table: r.rows for r in result.summary.collect()} == {
            "orders": 2, "customers": 2, "products": 2, "order_items": 2, "payments": 2,
            "sales_summary": 2,
        }
        kept = {r.customer_id: r.customer_city for r in result.tables["customers"].collect()}
        assert kept == {"c1": "x", "c2": "y"}
        first = result.tables["sales_summary"].filter("order_id = 'o1'").first()
        assert (first.order_status, first.delivery_time_days) == ("delivered", 1)
        assert [float(first[c]) for c in ("total_items", "total_price", "total_freight",
                                          "total_payment")] == [2, 15.25, 1.5, 33.5]
        steps = {(r.step, r.table): r for r in result.audit.collect()}
        assert steps["clean", "order_items"].removed == 1
        assert steps["extract", "orders"].rows_in is None
        assert steps["extract", "orders"].rows_out == 3
        for step in ("export_csv", "export_parquet", "export_bundle", "load"):
            assert steps[step, "sales_summary"].rows_in == steps[step, "sales_summary"].rows_out == 2
        assert result.rejected.collect() == []
        assert {r.Columna: r.Nulos for r in result.quality.collect()}["total_items"] == 1
        assert all(r.ok for r in result.loads.collect())
        assert glob.glob(f"{out}/reports/csv/sales_summary/part-*")
        assert glob.glob(f"{out}/reports/csv/data_quality_report/part-*")
        assert glob.glob(f"{out}/reports/parquet/orders/part-*")
        assert glob.glob(f"{out}/reports/bundle/manifest/part-*")
        english = {r.product_id: r.product_category_name_english
                   for r in result.tables["products"].collect()}
        assert english == {"p1": "bed", "p2": None}
    finally:
        for name in result.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_parquet_sources(spark, source, tmp_path):
    root = str(tmp_path / "parquet")
    for name in FILES:
        prefix = "" if name.startswith("product_category") else "shop_"
        df = spark.read.option("header", True).csv(f"{source}/{prefix}{name}.csv")
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    cfg = etl.EtlConfig(root, str(tmp_path / "out"), source_format="parquet", export="parquet")
    result = etl.run(spark, cfg)
    kept = {r.customer_id: r.customer_city for r in result.tables["customers"].collect()}
    assert kept == {"c1": "x", "c2": "y"}
    first = result.tables["orders"].filter("order_id = 'o1'").first()
    assert (first.order_status, first.delivery_time_days) == ("delivered", 1)
    assert result.loads is None


def test_an_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        etl.run(spark, etl.EtlConfig(str(tmp_path), str(tmp_path / "out")))


def test_an_unknown_export_is_an_error():
    with pytest.raises(ValueError):
        etl.EtlConfig("a", "b", export="excel97")


def test_tables_of_a_phase_are_written_at_the_same_time(spark, source, tmp_path, monkeypatch):
    met, parties = [], Barrier(2)
    store = etl._store

    def meeting(session, df, path):
        if "/marts/" in path and path.endswith(("orders", "order_items")):
            parties.wait(60)  # breaks where the tables are written one after the other
            met.append(path.rsplit("/", 1)[1])
        return store(session, df, path)

    monkeypatch.setattr(etl, "_store", meeting)
    cfg = etl.EtlConfig(source, str(tmp_path / "out"), prefix="shop_", export="parquet")
    result = etl.run(spark, cfg)
    assert sorted(met) == ["order_items", "orders"]
    steps = [(r.step, r.table) for r in result.audit.orderBy("position").collect()]
    clean = [t for s, t in steps if s == "clean"]
    # Recorded in the order of the tables, whichever was done first.
    assert clean == ["orders", "customers", "products", "order_items", "payments"]
    assert steps == sorted(steps, key=lambda s: ("extract", "clean", "summarise", "export_parquet").index(s[0]))


def test_steps_at_the_same_time_are_all_in_the_ledger(spark, tmp_path):
    path, names = str(tmp_path / "ledger"), [f"t{i}" for i in range(12)]

    def step(ledger, name):
        return ledger.run("clean", name, lambda: name, lambda: "made", lambda: "read")

    first = Ledger(spark, path)
    assert together(spark, lambda n: step(first, n), names) == ["made"] * 12
    again = Ledger(spark, path)
    assert together(spark, lambda n: step(again, n), names) == ["read"] * 12


def test_an_error_in_one_table_is_raised_and_begins_no_more(spark):
    begun = []

    def work(n):
        begun.append(n)
        if n == 0:
            raise ValueError("bad table")
        return n

    assert together(spark, str, [3, 1, 2]) == ["3", "1", "2"]
    with pytest.raises(ValueError, match="bad table"):
        together(spark, work, range(100), at_once=1)
    assert len(begun) < 100


def test_tables_of_a_run_are_packed_well(spark, source, tmp_path):
    out = str(tmp_path / "out")
    etl.run(spark, etl.EtlConfig(source, out, prefix="shop_", export="all"))
    tables = glob.glob(f"{out}/**/orders/**/part-*.parquet", recursive=True)
    assert {f.removeprefix(out).split("/")[1] for f in tables} == {"landing", "marts", "reports"}
    assert all(f.endswith(".zstd.parquet") for f in tables)
    assert glob.glob(f"{out}/reports/csv/orders/part-*.csv")  # for any reader


def test_source_files_are_packed_and_hold_every_row(spark, sf_dir, monkeypatch):
    monkeypatch.setitem(registry._PACKED, "maxRecordsPerFile", 1000)  # a table goes to several files
    root = registry._write_sources(spark, sf_dir).removeprefix("file:")
    raw, found = star.raw_tables(spark, sf_dir), read_catalog(spark, root).tables
    assert found.keys() == raw.keys()
    for name, df in found.items():
        files = glob.glob(f"{root}/{TABLES[name].stem}.csv/part-*")
        assert files and all(f.endswith(".csv.gz") for f in files)
        assert df.count() == raw[name].count()
    assert len(glob.glob(f"{root}/{TABLES['order_items'].stem}.csv/part-*")) > 1
    priced = [t["order_items"].groupBy("order_id").sum("price") for t in (found, raw)]
    assert sorted((int(r[0]), r[1]) for r in priced[0].collect()) == sorted(map(tuple, priced[1].collect()))


def test_shuffle_files_of_finished_work_go(spark, tmp_path):
    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles()
        return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    etl._store(spark, spark.range(1000).repartition(3, "id"), str(tmp_path / "t"))
    made = files() - before
    assert made
    release_shuffles(spark)
    end = time.monotonic() + 60
    while made & files() and time.monotonic() < end:
        time.sleep(0.2)
    assert not made & files()


def test_shuffle_files_go_between_the_phases_of_a_run(spark, source, tmp_path, monkeypatch):
    there = []
    monkeypatch.setattr(etl, "release_shuffles", lambda _: there.append(os.path.exists(f"{tmp_path}/out/reports/csv")))
    etl.run(spark, etl.EtlConfig(source, str(tmp_path / "out"), prefix="shop_"))
    assert len(there) == 2 and not there[0]  # before the exports, and after the profile
