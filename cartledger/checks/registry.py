"""Every operator and report as a query over the star-schema tables.

Inputs with nulls, copies, bad dates or untidy names are derived from the tables
themselves, whole. Decimals, and whole numbers that may be null, leave as doubles
so that results compare by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from cartledger.operators import aggregates, cleaning, copies, derive, frequent, joins
from cartledger.plans import etl, marts, quality, star_mapping as star
from cartledger.operators.skew import SkewPolicy
from cartledger.plans.audit import AuditLog
from cartledger.plans.incremental import PARTS, SalesByYear
from cartledger.plans.reports import REPORTS
from cartledger.plans.steps import Ledger
from cartledger.sources import (
    REJECTED,
    TABLES,
    read_catalog,
    read_csv,
    read_parquet,
    layouts,
    publish,
    run_query,
    scratch_path,
    sinks,
)
from cartledger.sources.together import together

Query = Callable[[SparkSession, str], DataFrame]


NULLABLE_DAYS = ("delivery_time_days", "delivery_delay_days")


def _doubles(df: DataFrame, *nullable: str) -> DataFrame:
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in [*decimals, *nullable]})


def _report(report) -> Query:
    return lambda spark, sf_dir: report(star.LoadedTables(spark, sf_dir))


def _mapped(build: Callable[..., DataFrame], *tables: str, nullable: Sequence[str] = ()) -> Query:
    """``build`` applied to mapped tables, in the order given."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        mapped = [getattr(star, name)(spark, sf_dir) for name in tables]
        return _doubles(build(*mapped), *nullable)

    return query


# --- sources and sinks: write, read back ------------------------------------------


def _src_csv(spark, sf_dir):
    customers = star.customers(spark, sf_dir)
    path = scratch_path(spark, "src_csv")
    sinks.write_csv(customers, path)
    return read_csv(spark, path, customers.schema)


def _src_parquet(spark, sf_dir):
    path = scratch_path(spark, "src_parquet")
    sinks.write_parquet(star.order_items(spark, sf_dir), path)
    return _doubles(read_parquet(spark, path))


#: Source files lie on the disk until the run ends, so they are compressed, which takes no longer if
#: it is done lightly; and as one task reads such a file, none is long.
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 300_000}


def _write_sources(spark, sf_dir) -> str:
    """The mapped tables as source files, named as the catalogue expects them."""
    root = scratch_path(spark, "sources")
    raw = star.raw_tables(spark, sf_dir)
    together(spark, lambda name: sinks.write_csv(raw[name], f"{root}/{TABLES[name].stem}.csv", **_PACKED), raw)
    return root


def _src_catalog(spark, sf_dir):
    return quality.run_summary(read_catalog(spark, _write_sources(spark, sf_dir)).tables)


def _src_query(spark, sf_dir):
    return _doubles(
        run_query(
            spark,
            """SELECT Payments.payment_type, COUNT(*) AS payments, SUM(payments.payment_value) AS total,
                      'payments' AS source
               FROM PAYMENTS GROUP BY payments.payment_type""",
            {"payments": star.payments(spark, sf_dir)},
        )
    )


def _snk_parquet(spark, sf_dir):
    payments = star.payments(spark, sf_dir)
    path = scratch_path(spark, "snk_parquet")
    sinks.write_parquet(payments, path)
    sinks.write_parquet(payments, path, "append")
    return _doubles(read_parquet(spark, path))


def _snk_csv(spark, sf_dir):
    summary = star.LoadedTables(spark, sf_dir)["sales_summary"]
    path = scratch_path(spark, "snk_csv")
    sinks.write_csv(summary, path)
    return _doubles(read_csv(spark, path, summary.schema), "total_items")


def _snk_bundle(spark, sf_dir):
    loaded = star.LoadedTables(spark, sf_dir)
    chosen = {name: loaded[name] for name in ("orders", "products", "customers")}
    manifest = sinks.write_bundle(spark, chosen, scratch_path(spark, "snk_bundle"))
    # Customers are read back through the manifest, each beside the rows it states.
    entry = manifest.filter(F.col("table") == "customers").first()
    return read_parquet(spark, entry["path"]).withColumn("rows", F.lit(entry["rows"]))


def _snk_bundle_versioned(spark, sf_dir):
    """Customers of the last whole version: the next one fails at its third table."""
    path = scratch_path(spark, "snk_bundle_versioned")
    customers, sellers = star.customers(spark, sf_dir), star.sellers(spark, sf_dir)
    publish.publish_bundle(spark, {"customers": customers.limit(0), "sellers": sellers}, path)
    publish.publish_bundle(spark, {"customers": customers, "sellers": sellers}, path)
    broken = customers.withColumn("customer_city", F.col("customer_city").cast("int"))
    try:
        publish.publish_bundle(spark, {"customers": customers.limit(0), "sellers": sellers, "broken": broken}, path)
        raise AssertionError("the third table cannot be written")
    except PySparkException:
        pass
    found = publish.versions(spark, path)
    n = found.agg(F.count_distinct("version")).scalar()
    return publish.read_published(spark, path)["customers"].withColumn("versions", n)


def _target(spark, label) -> sinks.CatalogTarget:
    return sinks.CatalogTarget(scratch_path(spark, label))


def _unique(name: str, target: sinks.CatalogTarget) -> str:
    return f"{name}_{target.location.rsplit('-', 1)[1]}"


def _snk_table(spark, sf_dir):
    target = _target(spark, "snk_table")
    table = _unique("sellers", target)
    sellers = star.sellers(spark, sf_dir)
    sinks.load_table(sellers, target, table, "fail")
    sinks.load_table(sellers, target, table, "replace")
    return target.read(spark, table)


def _snk_table_many(spark, sf_dir):
    """Three loads of which the middle one cannot succeed: its rows raise when read."""
    target = _target(spark, "snk_table_many")
    customers = star.customers(spark, sf_dir)
    tables = {
        "customers": customers,
        "broken": customers.withColumn("customer_city", F.col("customer_city").cast("int")),
        "sellers": star.sellers(spark, sf_dir),
    }
    named = {_unique(name, target): df for name, df in tables.items()}
    done = sinks.load_tables(spark, named, target)
    named = done.select(F.substring_index("table", "_", 1).alias("table"), "ok", "rows")
    return _doubles(named, "rows")


def _cat_table_exists(spark, sf_dir):
    target = _target(spark, "cat_table_exists")
    table = _unique("sellers", target)
    sinks.load_table(star.sellers(spark, sf_dir), target, table)
    found = [
        ("sellers", sinks.table_exists(spark, target, table)),
        ("no_such_table", sinks.table_exists(spark, target, _unique("none", target))),
    ]
    return spark.createDataFrame(found, "table string, present boolean")


def _cat_row_count(spark, sf_dir):
    target = _target(spark, "cat_row_count")
    table = _unique("items", target)
    sinks.load_table(star.order_items(spark, sf_dir), target, table)
    return sinks.row_count(spark, target, table)


def _src_csv_mixed(spark, sf_dir):
    """Two kinds of files in one folder, with their columns in different order."""
    customers = star.customers(spark, sf_dir)
    path = scratch_path(spark, "src_csv_mixed")
    even = F.col("customer_id") % 2 == 0
    sinks.write_csv(customers.filter(even), path)
    turned = customers.filter(~even).select(*reversed(customers.columns))
    sinks.write_csv(turned.toDF(*[f" {c.upper()} " for c in turned.columns]), path, "append")
    return cleaning.clean_names(read_csv(spark, path, customers.schema))


def _src_csv_dirty(spark, sf_dir):
    """Dates in three forms, whole numbers with a decimal point, missing words, misfits."""
    orders = star.orders(spark, sf_dir)
    key, bought = F.col("order_id"), F.col("order_purchase_timestamp")
    written = (
        F.when(key % 97 == 0, "no date")
        .when(key % 3 == 0, F.date_format(bought, "MM/dd/yyyy HH:mm"))
        .when(key % 3 == 1, F.date_format(bought, "MMM d, yyyy HH:mm:ss"))
        .otherwise(bought.cast("string"))
    )
    customer = (
        F.when(key % 5 == 0, "NA")
        .when(key % 7 == 0, "1.5")
        .otherwise(F.col("customer_id").cast("string"))
    )
    dirty = orders.select(
        F.concat(key.cast("string"), F.lit(".0")).alias("order_id"),
        customer.alias("customer_id"),
        written.alias("order_purchase_timestamp"),
    )
    path = scratch_path(spark, "src_csv_dirty")
    sinks.write_csv(dirty, path)
    schema = orders.select("order_id", "customer_id", "order_purchase_timestamp").schema
    read = read_csv(spark, path, schema, rejects=REJECTED)
    fields = F.array_join(REJECTED, ",").alias("misfits")
    return read.select("order_id", F.col("customer_id").cast("double"), "order_purchase_timestamp", fields)


def _src_catalog_types(spark, sf_dir):
    """Types of the product file's columns, most of them not declared."""
    root = scratch_path(spark, "source_types")
    parts = star.read_star(spark, sf_dir, "part")
    sinks.write_csv(
        parts.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.col("p_size").alias("product_height_cm"),
            F.col("p_retailprice").alias("product_weight_g"),
            F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("product_code"),
            F.when(F.col("p_size") % 2 == 0, "NA").otherwise("7").alias("product_photos_qty"),
            (F.col("p_partkey") + (1 << 40)).alias("product_ean"),
        ),
        f"{root}/{TABLES['products'].stem}.csv",
    )
    products = read_catalog(spark, root, infer=True).tables["products"]
    kinds = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(k).alias("type")) for n, k in products.dtypes])
    return products.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(kinds))


# --- cleaning and derivation ------------------------------------------------------


def _cln_names(spark, sf_dir):
    orders = star.orders(spark, sf_dir)
    untidy = [f" {c.replace('_', ' ').title()} " for c in orders.columns]
    return cleaning.clean_names(orders.toDF(*untidy))


def _cln_dates(spark, sf_dir):
    orders = star.orders(spark, sf_dir)
    text = F.col("order_purchase_timestamp").cast("string")
    broken = orders.select(
        "order_id",
        F.when(F.col("order_id") % 97 == 0, "bad").otherwise(text).alias(
            "order_purchase_timestamp"
        ),
    )
    return cleaning.parse_dates(broken, ["order_purchase_timestamp", "no_such_column"])


def _cln_date_formats(spark, sf_dir):
    """A column with the day first and one with the month first and a twelve-hour clock, each
    with values that do not fit."""
    key = F.col("order_id")
    written = star.orders(spark, sf_dir).select(
        key,
        F.when(key % 97 == 0, "no date").when(key % 89 == 0, F.col("order_purchase_timestamp").cast("string"))
        .otherwise(F.date_format("order_purchase_timestamp", "dd/MM/yyyy HH:mm")).alias("bought"),
        F.when(key % 83 == 0, "Marble 5, 2023")
        .otherwise(F.date_format("order_estimated_delivery_date", "M/d/yyyy hh:mm:ss a")).alias("due"),
    )
    columns = ["bought", "due"]
    told = cleaning.date_formats(written, columns).agg(
        F.map_from_entries(F.collect_list(F.struct("column", F.struct("form", "misfits")))).alias("told")
    ).scalar()
    parsed = cleaning.parse_dates_by_column(written, columns).withColumn("told", told)
    figures = [F.col("told")[c][f].alias(f"{c}_{f}") for c in columns for f in ("form", "misfits")]
    return parsed.select("order_id", *columns, *figures)


def _gappy_parts(spark, sf_dir) -> DataFrame:
    key = F.col("p_partkey")
    return star.read_star(spark, sf_dir, "part").select(
        key,
        F.when(key % 10 != 0, F.col("p_size").cast("double")).alias("size"),
        F.when(key % 7 != 0, F.col("p_retailprice").cast("decimal(18,2)")).alias("price"),
        (key + (1 << 53)).alias("ean"),
        F.when(key % 10 != 0, F.col("p_brand")).alias("brand"),
    )


def _gappy(operator, *args) -> Query:
    return lambda spark, sf_dir: _doubles(operator(_gappy_parts(spark, sf_dir), *args))


def _repeated_orders(spark, sf_dir) -> DataFrame:
    orders = star.orders(spark, sf_dir)
    return orders.unionByName(orders)


def _cln_dedup_row(spark, sf_dir):
    return cleaning.drop_duplicate_rows(_repeated_orders(spark, sf_dir))


def _cln_dedup_row_two_pass(spark, sf_dir):
    """A third of all rows are one row."""
    orders = star.orders(spark, sf_dir)
    same = F.col("order_id") % 3 == 0
    alike = {c: F.when(~same, F.col(c)).alias(c) for c in orders.columns}
    path = scratch_path(spark, "dedup_two_pass")
    sinks.write_parquet(orders.withColumns(alike), path)
    return copies.drop_duplicate_rows_two_pass(read_parquet(spark, path))


def _cln_dedup_key(spark, sf_dir):
    items = star.order_items(spark, sf_dir)
    return _doubles(cleaning.drop_duplicate_keys(items, ["order_id", "order_item_id"]))


# --- joins, aggregates, marts, profiles -------------------------------------------


def _agg_by_category(spark, sf_dir):
    sold = joins.orders_items_products(
        star.orders(spark, sf_dir), star.order_items(spark, sf_dir), star.raw_products(spark, sf_dir)
    )
    return _doubles(aggregates.sales_by_category(sold))


def _untidy(df: DataFrame) -> DataFrame:
    return df.toDF(*[f" {c.replace('_', ' ').title()} " for c in df.columns])


def _with_copies(df: DataFrame, key: str, changes: dict[str, object]) -> DataFrame:
    """Every fifth key once more, with other values that sort after its own."""
    again = df.filter(F.col(key) % 5 == 0)
    other = {c: F.lit(v).cast(df.schema[c].dataType) for c, v in changes.items()}
    return df.unionByName(again.withColumns(other))


def _dates_as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates as text in two forms."""
    key = F.col(df.columns[0])
    return df.withColumns(
        {
            c: F.when(key % 3 == 0, F.date_format(c, "yyyy/MM/dd HH:mm:ss.SSSSSS")).otherwise(F.col(c).cast("string"))
            for c in columns
        }
    )


def _dirty_orders(spark, sf_dir):
    orders = _with_copies(star.orders(spark, sf_dir), "order_id", {"customer_id": 1 << 40})
    text = _dates_as_text(orders, *[c for c in derive.ORDER_DATES if c in orders.columns])
    bad = F.when(F.col("order_id") % 97 == 0, "bad").otherwise(F.col("order_purchase_timestamp"))
    return _untidy(text.withColumn("order_purchase_timestamp", bad))


def _mart_orders(spark, sf_dir):
    return _doubles(marts.orders(_dirty_orders(spark, sf_dir)), *NULLABLE_DAYS)


def _mart_customers(spark, sf_dir):
    dirty = _with_copies(star.customers(spark, sf_dir), "customer_id", {"customer_city": "zz"})
    return marts.customers(_untidy(dirty))


def _mart_sellers(spark, sf_dir):
    dirty = _with_copies(star.sellers(spark, sf_dir), "seller_id", {"seller_city": "zz"})
    return marts.sellers(_untidy(dirty))


def _mart_products(spark, sf_dir):
    dirty = _with_copies(
        star.raw_products(spark, sf_dir), "product_id", {"product_category_name": "zz"}
    )
    return marts.products(_untidy(dirty), _untidy(star.category_translation(spark, sf_dir)))


def _mart_order_items(spark, sf_dir):
    items = star.order_items(spark, sf_dir)
    copies = items.filter(F.col("order_id") % 5 == 0)
    return _doubles(marts.order_items(_untidy(items.unionByName(copies))))


def _mart_payments(spark, sf_dir):
    return _doubles(marts.payments(_untidy(star.payments(spark, sf_dir))))


def _mart_reviews(spark, sf_dir):
    dirty = _with_copies(star.reviews(spark, sf_dir), "review_id", {"review_score": 9})
    return _doubles(marts.reviews(_untidy(_dates_as_text(dirty, *marts.REVIEW_DATES))), "review_score")


def _mart_sales_summary(spark, sf_dir):
    return _doubles(
        marts.sales_summary(
            marts.orders(star.orders(spark, sf_dir)),
            marts.order_items(star.order_items(spark, sf_dir)),
            marts.payments(star.payments(spark, sf_dir)),
        ),
        *NULLABLE_DAYS,
        "total_items",
    )


def _bucketed(spark, sf_dir, rows_per_bucket: int = layouts.ROWS_PER_BUCKET):
    """Orders, items and payments in buckets by order, 8 at least."""
    parts = {name: getattr(star, name)(spark, sf_dir) for name in PARTS}
    buckets = layouts.buckets_for(parts.values(), 8, rows_per_bucket)
    return {
        name: layouts.write_bucketed(df, scratch_path(spark, f"bucketed_{name}"), "order_id", buckets)
        for name, df in parts.items()
    }


def _mart_sales_bucketed(spark, sf_dir):
    cleaned = marts.build_all(_bucketed(spark, sf_dir))
    return _doubles(marts.sales_summary(*(cleaned[t] for t in PARTS)), *NULLABLE_DAYS, "total_items")


def _etl_incremental(spark, sf_dir):
    """The mart after one year changed: at first it lacks the last items and payments of each order.

    The parts lie in buckets by order, so both runs clean, compare and join them where they lie.
    """
    return _refreshed_twice(spark, marts.build_all(_bucketed(spark, sf_dir)))


def _refreshed_twice(spark, tables):
    sales = SalesByYear(spark, scratch_path(spark, "incremental"))
    bought = F.year("order_purchase_timestamp")
    first = tables["orders"].agg(F.min(bought)).first()[0]
    old = tables["orders"].filter(bought == F.lit(first)).select("order_id", F.lit(True).alias("old"))
    kept = {"order_items": "order_item_id > 1", "payments": "payment_sequential > 2"}
    # No union of two parts, which would not lie in buckets any more.
    fewer = {
        name: tables[name].join(old, "order_id", "left").filter(f"old IS NULL OR {those}").drop("old")
        for name, those in kept.items()
    }
    sales.refresh({"orders": tables["orders"], **fewer})
    replaced = sales.refresh(tables)
    whole = _doubles(sales.read(), *NULLABLE_DAYS, "total_items")
    return whole.withColumn("replaced", F.lit(",".join(map(str, replaced))))


#: Small enough that a third of the rows is hot, is split, and no side is broadcast.
_EAGER = SkewPolicy(share=1 / 4, min_rows=100, rows_per_part=500, broadcast_rows=0)


def _skewed_items(spark, sf_dir, key: str):
    """A third of all items on one key."""
    value = F.when(F.col("order_item_id") % 3 == 0, F.lit(6).cast("bigint")).otherwise(F.col(key))
    return star.order_items(spark, sf_dir).withColumn(key, value)


def _jn_orders_items_skewed(spark, sf_dir):
    items = _skewed_items(spark, sf_dir, "order_id")
    return _doubles(joins.orders_with_items(star.orders(spark, sf_dir), items, policy=_EAGER))


def _jn_products_skewed(spark, sf_dir):
    items = _skewed_items(spark, sf_dir, "product_id")
    products = star.raw_products(spark, sf_dir)
    return _doubles(joins.orders_items_products(star.orders(spark, sf_dir), items, products, _EAGER))


def _prf_quality(spark, sf_dir):
    path = scratch_path(spark, "prf_quality")
    sinks.write_parquet(star.LoadedTables(spark, sf_dir)["sales_summary"], path)
    return quality.quality_report(read_parquet(spark, path))


def _prf_quality_lineitem(spark, sf_dir):
    return quality.quality_report(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


def _prf_quality_sketch(spark, sf_dir):
    """Sketches kept by ship year and merged, beside the exact counts of the whole table."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    year = F.year("l_shipdate")
    path = scratch_path(spark, "sketches")
    years = [r[0] for r in items.select(year).distinct().collect()]  # a few
    for y in years:
        sinks.write_parquet(quality.column_sketches(items.filter(year.eqNullSafe(F.lit(y)))), path, "append")
    told = quality.quality_report_from_sketches(read_parquet(spark, path))
    exact = quality.quality_report(items).select("Columna", F.col("Valores_Unicos").alias("exact"))
    near = F.abs(F.col("Valores_Unicos") - F.col("exact")) <= 0.05 * F.col("exact")
    return told.join(exact, "Columna").withColumn("near", near).drop("Valores_Unicos").withColumnRenamed(
        "exact", "Valores_Unicos"
    )


def _prf_table_info(spark, sf_dir):
    return quality.table_info(star.LoadedTables(spark, sf_dir)["sales_summary"], "sales_summary")


def _prf_run_summary(spark, sf_dir):
    return quality.run_summary(marts.build_all(star.raw_tables(spark, sf_dir)))


def _aud_counts(spark, sf_dir):
    audit = AuditLog()
    steps = [
        ("drop_duplicate_rows", "orders", _repeated_orders(spark, sf_dir),
         cleaning.drop_duplicate_rows),
        ("drop_duplicate_keys", "order_items", star.order_items(spark, sf_dir),
         lambda df: cleaning.drop_duplicate_keys(df, ["order_id", "order_item_id"])),
    ]
    for step, table, df, operator in steps:
        path = scratch_path(spark, f"aud_{table}")
        sinks.write_parquet(df, f"{path}/in")
        before = read_parquet(spark, f"{path}/in")
        sinks.write_parquet(operator(before), f"{path}/out")
        audit.record(step, table, before, read_parquet(spark, f"{path}/out"))
    return audit.counts().select("step", "table", "rows_in", "rows_out")


def _run(spark, sf_dir, export: str) -> etl.EtlResult:
    cfg = etl.EtlConfig(
        source=_write_sources(spark, sf_dir), output=scratch_path(spark, "etl"), export=export
    )
    return etl.run(spark, cfg)


def _etl_full(spark, sf_dir):
    """The sales mart of a whole run, read back from its output."""
    summary = _run(spark, sf_dir, "all").tables["sales_summary"]
    ids = {c: F.col(c).cast("bigint") for c in ("order_id", "customer_id")}
    return _doubles(summary.withColumns(ids), *NULLABLE_DAYS, "total_items")


def _etl_resumed(spark, sf_dir):
    """The sales mart of a run that stopped after the transformation and is started again."""
    cfg = etl.EtlConfig(
        source=_write_sources(spark, sf_dir), output=scratch_path(spark, "resumed"), export="bundle", resume=True
    )
    ledger, audit = Ledger(spark, f"{cfg.output}/ledger"), AuditLog()
    landed, _ = etl.extract(spark, cfg, audit, ledger)
    etl.transform(spark, cfg, landed, audit, ledger)
    result = etl.run(spark, cfg)
    steps = result.audit.filter("taken_over").groupBy("step").count()
    taken = steps.agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(" ", "step", "count"))), ",").alias("s"))
    summary = result.tables["sales_summary"]
    ids = {c: F.col(c).cast("bigint") for c in ("order_id", "customer_id")}
    whole = _doubles(summary.withColumns(ids), *NULLABLE_DAYS, "total_items")
    return whole.withColumn("taken_over", taken.scalar())


def _aud_run(spark, sf_dir):
    """Each phase of a run with the rows it took and gave."""
    audit = _run(spark, sf_dir, "parquet").audit
    return _doubles(audit.select("step", "table", "rows_in", "rows_out"), "rows_in")


def queries() -> dict[str, Query]:
    return {
        **{name: _report(report) for name, report in REPORTS.items()},
        "src_csv": _src_csv,
        "src_parquet": _src_parquet,
        "src_csv_mixed": _src_csv_mixed,
        "src_csv_dirty": _src_csv_dirty,
        "src_catalog": _src_catalog,
        "src_catalog_types": _src_catalog_types,
        "src_query": _src_query,
        "snk_parquet": _snk_parquet,
        "snk_csv": _snk_csv,
        "snk_bundle": _snk_bundle,
        "snk_bundle_versioned": _snk_bundle_versioned,
        "snk_table": _snk_table,
        "snk_table_many": _snk_table_many,
        "cat_table_exists": _cat_table_exists,
        "cat_row_count": _cat_row_count,
        "cln_names": _cln_names,
        "cln_dates": _cln_dates,
        "cln_date_formats": _cln_date_formats,
        "cln_null_drop": _gappy(cleaning.drop_nulls, ["size", "price", "brand"]),
        "cln_null_zero": _gappy(cleaning.fill_zero, ["size", "price", "brand"]),
        "cln_null_mean": _gappy(cleaning.fill_mean),
        "cln_null_mode": _gappy(cleaning.fill_mode, ["size", "brand"]),
        "cln_null_mode_summaries": _gappy(
            lambda df: frequent.fill_mode_from_summaries(df, ["size", "brand"], counters=4)
        ),
        "cln_dedup_row": _cln_dedup_row,
        "cln_dedup_row_two_pass": _cln_dedup_row_two_pass,
        "cln_dedup_key": _cln_dedup_key,
        "drv_orders": _mapped(derive.order_columns, "orders", nullable=NULLABLE_DAYS),
        "drv_delivery_days": _mapped(
            lambda df: derive.delivery_days(df).select("order_id", "delivery_time_days"),
            "orders",
            nullable=["delivery_time_days"],
        ),
        "drv_delay_days": _mapped(
            lambda df: derive.delay_days(df).select("order_id", "delivery_delay_days"),
            "orders",
            nullable=["delivery_delay_days"],
        ),
        "drv_calendar": _mapped(
            lambda df: derive.calendar_parts(df).select(
                "order_id", "purchase_year", "purchase_month", "purchase_day_of_week"
            ),
            "orders",
        ),
        "jn_orders_items": _mapped(joins.orders_with_items, "orders", "order_items"),
        "jn_orders_items_products": _mapped(
            joins.orders_items_products, "orders", "order_items", "raw_products"
        ),
        "jn_orders_items_skewed": _jn_orders_items_skewed,
        "jn_products_skewed": _jn_products_skewed,
        "jn_translate": _mapped(
            joins.translate_categories, "raw_products", "category_translation"
        ),
        "agg_items_per_order": _mapped(aggregates.items_per_order, "order_items"),
        "agg_payments_per_order": _mapped(aggregates.payments_per_order, "payments"),
        "agg_by_category": _agg_by_category,
        "mart_sales_summary": _mart_sales_summary,
        "mart_sales_bucketed": _mart_sales_bucketed,
        "mart_orders": _mart_orders,
        "mart_customers": _mart_customers,
        "mart_products": _mart_products,
        "mart_order_items": _mart_order_items,
        "mart_payments": _mart_payments,
        "mart_reviews": _mart_reviews,
        "mart_sellers": _mart_sellers,
        "prf_quality": _prf_quality,
        "prf_quality_lineitem": _prf_quality_lineitem,
        "prf_quality_sketch": _prf_quality_sketch,
        "prf_table_info": _prf_table_info,
        "prf_run_summary": _prf_run_summary,
        "aud_counts": _aud_counts,
        "aud_run": _aud_run,
        "etl_full": _etl_full,
        "etl_incremental": _etl_incremental,
        "etl_resumed": _etl_resumed,
    }
