import datetime as dt
import uuid
from decimal import Decimal

import pytest
from conftest import bag

from cartledger.operators.cleaning import drop_duplicate_keys
from cartledger.sources import headers
from cartledger.sources import (
    FILE_POSITION,
    REJECTED,
    TABLES,
    read_catalog,
    read_csv,
    read_parquet,
    run_query,
    scratch_path,
    with_file_position,
)
from cartledger.sources.readers import read_jdbc

REVIEWS = '''review_id,order_id,review_score,review_comment_message,review_creation_date,extra
r1,o1,5,"two
lines, and ""quotes""",2018-01-02 03:04:05,01310
r2,o2,NA,NA,bad date,
r3,o3,x,,2018-01-03,7
'''


@pytest.fixture
def reviews_file(tmp_path):
    path = tmp_path / "order_reviews_dataset.csv"
    path.write_text(REVIEWS, encoding="utf-8")
    return str(path)


def test_csv_is_typed_by_name_and_tolerant(spark, reviews_file):
    source = TABLES["reviews"]
    rows = read_csv(spark, reviews_file, source.schema, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [
        ("r1", "o1", 5, 'two\nlines, and "quotes"', dt.datetime(2018, 1, 2, 3, 4, 5), "01310"),
        ("r2", "o2", None, None, None, None),
        ("r3", "o3", None, None, dt.datetime(2018, 1, 3), "7"),
    ]


def test_csv_null_words_are_configurable_and_options_pass_through(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a;b\nNA;-\n", encoding="utf-8")
    assert tuple(read_csv(spark, str(path), null_tokens=("-",), sep=";").first()) == ("NA", None)


def test_types_are_inferred_only_on_request(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("n,x,Price\n1,1.5,2\n2,2.5,3\n", encoding="utf-8")
    text = read_csv(spark, str(path))
    assert {t for _, t in text.dtypes} == {"string"}
    typed = read_csv(spark, str(path), TABLES["order_items"].schema, infer=True)
    assert typed.dtypes == [("n", "int"), ("x", "double"), ("Price", "decimal(18,2)")]


def test_untidy_headers_find_their_type(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(" Order ID ,PRICE\no1,1.50\n", encoding="utf-8")
    df = read_csv(spark, str(path), TABLES["order_items"].schema)
    assert df.columns == [" Order ID ", "PRICE"]
    assert tuple(df.first()) == ("o1", Decimal("1.50"))


def test_a_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        read_parquet(spark, str(tmp_path / "none.parquet"))


def test_catalog_lists_what_is_missing(spark, tmp_path, reviews_file):
    (tmp_path / "shop_orders_dataset.csv").write_text("order_id\no1\n", encoding="utf-8")
    (tmp_path / "mine.csv").write_text("seller_id\ns1\ns2\n", encoding="utf-8")
    found = read_catalog(spark, str(tmp_path), prefix="shop_", files={"sellers": "mine.csv"})
    assert {name: df.count() for name, df in found.tables.items()} == {
        "orders": 1,
        "reviews": 3,
        "sellers": 2,
    }
    assert sorted(found.missing) == [
        "category_translation", "customers", "geolocation", "order_items", "payments", "products",
    ]


def test_file_position_is_the_order_in_the_file(spark, tmp_path):
    """Many small splits: the first copy of each key in the file must survive."""
    lines = [f"k{(i * 7919) % 500},{i}" for i in range(20_000)]
    path = tmp_path / "t.csv"
    path.write_text("key,at\n" + "\n".join(lines) + "\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        placed = with_file_position(read_csv(spark, str(path)))
        assert placed.rdd.getNumPartitions() > 4
        got = bag(drop_duplicate_keys(placed, ["key"], FILE_POSITION), "key", "at")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first = {}
    for line in lines:
        key, at = line.split(",")
        first.setdefault(key, at)
    assert got == sorted(first.items())


def test_query_over_named_tables(spark):
    got = run_query(spark, "SELECT count(*) AS n FROM three_rows;", {"three_rows": spark.range(3)})
    assert got.first().n == 3


class Recorder:
    """Stands in for a session's reader and keeps the options it is given."""

    def __init__(self):
        self.read = self
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.seen


def test_jdbc_read_options():
    options = read_jdbc(Recorder(), "jdbc:x", "SELECT 1;", {"user": "u"}, ("id", 0, 100, 8))
    assert options == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "(SELECT 1) q",
        "user": "u",
        "partitionColumn": "id",
        "lowerBound": "0",
        "upperBound": "100",
        "numPartitions": "8",
    }


def test_files_of_one_folder_are_told_by_their_names(spark, tmp_path):
    for name in ("t/b", "t/a", "u/x/b", "u/y/a"):
        path = tmp_path / f"{name}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"key,at\nk,{name}\n" if name[0] == "t" else f"{'key,at' if 'x' in name else 'at,key'}\nk,k\n")
    flat = read_csv(spark, str(tmp_path / "t"), file_position=True, rejects=REJECTED)
    assert {r._file for r in flat.collect()} == {"a.csv", "b.csv"}
    assert drop_duplicate_keys(flat, ["key"], FILE_POSITION).first()["at"] == "t/a"
    deep = read_csv(spark, [str(tmp_path / "u/x"), str(tmp_path / "u/y")], file_position=True)
    assert sorted(r._file.rsplit("/u/")[-1] for r in deep.collect()) == ["x/b.csv", "y/a.csv"]


def test_columns_are_matched_by_name_in_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seller_id,seller_city,seller_state\ns1,Lima,PE\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("seller_state, Seller ID \nBR,s2\n", encoding="utf-8")
    got = read_csv(spark, str(tmp_path), TABLES["sellers"].schema)
    assert got.columns == ["seller_id", "seller_city", "seller_state"]
    assert bag(got) == [("s1", "Lima", "PE"), ("s2", None, "BR")]


def test_fields_that_do_not_fit_are_null_and_named(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(
        "order_id,order_item_id,price,freight_value\no1,1.0,12.30,1\no2,1.5,12.345,x\no3,NA,1e2,\n",
        encoding="utf-8",
    )
    rows = read_csv(spark, str(path), TABLES["order_items"].schema, rejects="lost").collect()
    assert [tuple(r) for r in rows] == [
        ("o1", 1, Decimal("12.30"), Decimal("1.00"), []),
        ("o2", None, None, None, ["order_item_id", "price", "freight_value"]),
        ("o3", None, Decimal("100.00"), None, []),
    ]


def test_inference_looks_past_missing_words(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("n,zip,big,flag,mixed\n1,01310,5000000000,true,1\nNA,4,1,False,a\n3,5,NA,NA,2\n", encoding="utf-8")
    typed = read_csv(spark, str(path), infer=True)
    assert [t for _, t in typed.dtypes] == ["int", "string", "bigint", "boolean", "string"]
    assert [r.n for r in typed.collect()] == [1, None, 3]


def test_a_taken_helper_name_is_an_error(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("_row,lost\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError):
        read_csv(spark, str(path), file_position=True)
    with pytest.raises(ValueError):
        read_csv(spark, str(path), rejects="lost")


def test_a_query_leaves_the_callers_views_alone(spark):
    spark.range(3).createOrReplaceTempView("mine")
    got = run_query(spark, "SELECT count(*) AS n, 'mine' AS mine_text FROM mine", {"mine": spark.range(7)})
    assert tuple(got.first()) == (7, "mine")
    assert spark.table("mine").count() == 3


class Master:
    """Stands in for a session on some master."""

    def __init__(self, master, folder=None):
        self.sparkContext = self
        self.conf = self
        self.master, self.folder, self.applicationId = master, folder, "app-1"

    def get(self, name, default):
        return self.folder or default


def test_scratch_data_needs_a_shared_folder_on_a_cluster():
    assert scratch_path(Master("yarn", "/shared/"), "t").startswith("/shared/cartledger-app-1/t-")
    assert scratch_path(Master("local[4]"), "t")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch_path(Master(master), "t")


def _count_jobs(spark, act):
    tracker, group = spark.sparkContext.statusTracker(), f"counted {uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        found = act()
        return found, len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_of_many_files_take_a_fixed_number_of_jobs(spark, tmp_path):
    jobs = {}
    for n in (120, 180):
        folder = tmp_path / f"many {n}%"
        folder.mkdir()
        for i in range(n):
            text = ("customer_id,customer_city\n{i},x\n", "\n Customer_City ,CUSTOMER_ID\nx,{i}\n", "")[i % 3]
            (folder / f"part {i}%.csv").write_text(text.format(i=i), encoding="utf-8")
        df, jobs[n] = _count_jobs(spark, lambda: read_csv(spark, str(folder), TABLES["customers"].schema))
        assert bag(df) == sorted((str(i), "x") for i in range(n) if i % 3 < 2)
    assert jobs[120] == jobs[180] < 10


def test_headers_with_open_quotes_comments_and_long_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('# note\n"two\nlines",b\n1,2\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text('b,"two\nlines"\n2,1\n' * 1 + "4,3\n" * 20_000, encoding="utf-8")
    df = read_csv(spark, str(tmp_path), multi_line=True, comment="#")
    assert df.columns == ["two\nlines", "b"]
    assert df.distinct().count() == 2 and df.count() == 20_002


def test_only_first_lines_of_a_file_reach_python(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("a,b\n" + "1,2\n" * 30_000, encoding="utf-8")
    (tmp_path / "b.csv").write_text("#\n" * 6_000 + "b,a\n" + "2,1\n" * 10, encoding="utf-8")
    sent, send = [], type(spark.range(1)).mapInArrow

    def counted(df, *args, **kwargs):
        sent.append(df.count())
        return send(df, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", counted)
    df = read_csv(spark, str(tmp_path), comment="#")
    # The header of the second file is not among its first lines, so that file is looked at again.
    assert sent == [2 * headers.LINES, 6_011]
    assert df.distinct().collect() == [("1", "2")] and df.count() == 30_010


def test_a_field_is_converted_once(spark, tmp_path):
    numbers = ["1", "+7", "1.0", "1.5", "1e3", "-0", " 8 ", "2147483648", "x"]
    amounts = ["1.50", "1.505", "7", "-.5", "1.E5", "5.E-2", "1e-3", "1e16", "0.100"]
    rows = "".join(f"{n},{n},{a}\n" for n, a in zip(numbers, amounts))
    (tmp_path / "i.csv").write_text("order_id,order_item_id,price\n" + rows, encoding="utf-8")
    schema = TABLES["order_items"].schema
    df = read_csv(spark, str(tmp_path / "i.csv"), schema, rejects="lost")
    got = [(r["order_item_id"], r["price"] if r["price"] is None else str(r["price"]), r["lost"]) for r in df.collect()]
    i, p = "order_item_id", "price"
    assert got == [
        (1, "1.50", []), (7, None, [p]), (1, "7.00", []), (None, "-0.50", [i]), (1000, "100000.00", []),
        (0, "0.05", []), (8, None, [p]), (None, None, [i, p]), (None, "0.10", [i]),
    ]
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    tried = lambda d: plan(d).count("decimal(38,10)")
    assert tried(df) == tried(read_csv(spark, str(tmp_path / "i.csv"), schema)) > 0


def test_plain_sql_sees_given_tables_and_leaves_views_alone(spark):
    spark.range(3).createOrReplaceTempView("mine")
    given = {"mine": spark.range(7), "orders": spark.range(2)}
    ask = lambda q: run_query(spark, q, given)
    assert [r.x for r in ask('select "orders" x from orders').collect()] == ["orders"] * 2
    assert ask("select count(*) as orders from orders").columns == ["orders"]
    assert ask("select orders.id from orders").count() == 2
    assert ask("select * from ORDERS join mine m on m.id = orders.id").count() == 2
    kept = ask("select * from mine")
    with pytest.raises(Exception):
        ask("select nothing from mine")
    assert kept.count() == 7 and spark.table("mine").count() == 3
    assert not spark.catalog.tableExists("orders")


def test_dates_by_column_of_a_file(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("order_id,order_purchase_timestamp\n1,05/01/2023\n2,30/01/2023 10:00 PM\n3,2023-01-06\n", encoding="utf-8")
    df = read_csv(spark, str(path), TABLES["orders"].schema, dates_by_column=True, rejects="bad")
    assert bag(df) == [
        ("1", dt.datetime(2023, 1, 5), []), ("2", dt.datetime(2023, 1, 30, 22), []), ("3", None, ["order_purchase_timestamp"]),
    ]
