"""The order model read off a TPC-H-like star schema.

Customers, orders, parts and suppliers keep their keys; what the star schema does
not hold (delivery dates, payments, reviews) is derived from what it does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartledger.functions import money
from cartledger.operators.joins import translate_categories
from cartledger.plans import marts


def _after_hours(ts: str, hours: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(F.lit(0), hours.cast("int"))


# Columns of the star-schema tables that the mapping reads. Stating
# them spares a job per table that would only look up the types.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "props string",
}


def read_star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .when(F.col("o_orderstatus") == "P", "processing")
    )
    arrived = (F.col("o_orderstatus") == "F") & (key % 33 != 0)
    return read_star(spark, sf_dir, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.when(arrived, _after_hours("o_orderdate", key * 7 % 960)).alias(
            "order_delivered_customer_date"
        ),
        _after_hours("o_orderdate", F.lit(600)).alias("order_estimated_delivery_date"),
    )


def _hundredths(c: str) -> Column:
    """A double holding a two-decimal figure, as a whole number of hundredths.

    Casting a double to a decimal goes through its text, row by row; this does not.
    """
    return F.rint(F.col(c) * 100).cast("bigint")


def _from_cents(cents: Column) -> Column:
    return money(cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)"))


def _percent_of_price(percent: Column) -> Column:
    """Cents, rounded half up."""
    return F.floor((_hundredths("l_extendedprice") * percent + 50) / 100)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_star(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        _from_cents(_hundredths("l_extendedprice")).alias("price"),
        _from_cents(_percent_of_price(_hundredths("l_tax"))).alias("freight_value"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = (
        F.when(F.col("l_returnflag") == "A", "credit_card")
        .when(F.col("l_returnflag") == "N", "boleto")
        .otherwise("voucher")
    )
    return read_star(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        method.alias("payment_type"),
        (F.col("l_linenumber") % 4 + 1).alias("payment_installments"),
        _from_cents(_percent_of_price(100 - _hundredths("l_discount"))).alias("payment_value"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_star(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("product_category_name"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased category names; one category has no translation."""
    return (
        read_star(spark, sf_dir, "part")
        .filter(F.col("p_type") != "SMALL")
        .select(
            F.col("p_type").alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )
        .distinct()
    )


def _place(df: DataFrame, nation: DataFrame, key: str, nation_key: str, kind: str) -> DataFrame:
    # Spark broadcasts the nations while their file is small, which takes no job to find out.
    named = df.join(nation.withColumnRenamed("n_nationkey", nation_key), nation_key)
    return named.select(
        F.col(key).alias(f"{kind}_id"),
        F.concat(F.lit("city_"), (F.col(key) % 40).cast("string")).alias(f"{kind}_city"),
        F.col("n_name").alias(f"{kind}_state"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_star(spark, sf_dir, "nation")
    return _place(read_star(spark, sf_dir, "customer"), nation, "c_custkey", "c_nationkey", "customer")


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_star(spark, sf_dir, "nation")
    return _place(read_star(spark, sf_dir, "supplier"), nation, "s_suppkey", "s_nationkey", "seller")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    comment = F.when(kind == "view", "").when(kind != "click", F.col("props"))
    return read_star(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        # Orders run half as far again as events at every scale; so do these ids.
        (F.floor(F.col("event_id") / 2).cast("bigint") * 3).alias("order_id"),
        F.when(kind != "error", 1 + F.col("user_id") % 5).cast("int").alias("review_score"),
        comment.alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        _after_hours("ts", F.col("event_id") % 72).alias("review_answer_timestamp"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The source tables as they come, before any cleaning."""
    return {
        "customers": customers(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "sellers": sellers(spark, sf_dir),
        "payments": payments(spark, sf_dir),
        "reviews": reviews(spark, sf_dir),
        "category_translation": category_translation(spark, sf_dir),
    }


class LoadedTables(dict):
    """Tables the reports read, each opened when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._open(name)
        return self[name]

    def _open(self, name: str) -> DataFrame:
        if name == "products":
            return translate_categories(
                raw_products(self._spark, self._sf_dir),
                category_translation(self._spark, self._sf_dir),
            )
        if name == "sales_summary":
            return marts.sales_summary(self["orders"], self["order_items"], self["payments"])
        return {
            "customers": customers,
            "orders": orders,
            "order_items": order_items,
            "sellers": sellers,
            "payments": payments,
            "reviews": reviews,
        }[name](self._spark, self._sf_dir)
