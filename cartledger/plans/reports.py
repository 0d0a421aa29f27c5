"""The twelve business reports.

Each report takes the loaded tables by name and returns one lazy DataFrame. A
table with many rows per key is reduced to its key before it is joined, so a key
that holds a large share of the rows reaches the shuffle as one row per task, and
rows that a join would repeat are counted by multiplication instead.

``sales_summary`` holds every column of ``orders``, one row per order, so joining
``orders`` to it on ``order_id`` is reading it once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from cartledger.functions import exact_mean, mean_days, money, month_start, r2

Tables = Mapping[str, DataFrame]

# The thresholds and list lengths that define the reports.
MIN_CATEGORY_REVENUE = 1000
TOP_CATEGORIES = 20
MIN_SELLER_ORDERS = 10
TOP_SELLERS = 10
MIN_STATE_ORDERS = 100
PRODUCTS_PER_CATEGORY = 3
SOLD_STATUSES = ("delivered", "shipped")
MIN_CUSTOMER_ORDERS = 2
TOP_CUSTOMERS = 20
MIN_FREIGHT_ORDERS = 50
COHORT_MONTHS = 4

_PURCHASED = "order_purchase_timestamp"
_DELIVERED_ON = "order_delivered_customer_date"
_ESTIMATED = "order_estimated_delivery_date"


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter((F.col("order_status") == "delivered") & F.col("order_id").isNotNull())


def _arrived(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("order_status") == "delivered") & F.col(_DELIVERED_ON).isNotNull()
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def _reviews_per_order(reviews: DataFrame) -> DataFrame:
    """How many rows an order's reviews turn into in a left join, and their scores."""
    return reviews.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"),
        F.count("review_score").alias("scores"),
        F.sum(F.col("review_score").cast("bigint")).alias("score_sum"),
    )


def _with_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with ``copies``, the rows each becomes when left-joined to reviews."""
    joined = orders.join(_reviews_per_order(reviews), "order_id", "left")
    return joined.withColumns(
        {
            "copies": F.coalesce("reviews", F.lit(1)),
            "scores": F.coalesce("scores", F.lit(0)),
            "score_sum": F.coalesce("score_sum", F.lit(0)),
        }
    )


def category_sales(t: Tables) -> DataFrame:
    """Sales by English category with revenue above 1000; the 20 largest."""
    named = t["products"].filter(F.col("product_category_name_english").isNotNull()).select(
        "product_id", F.col("product_category_name_english").alias("categoria")
    )
    totals = (
        t["order_items"].groupBy("product_id")
        .agg(
            F.count("order_item_id").alias("items"),
            F.sum(money("price")).alias("price"),
            F.count("price").alias("prices"),
            F.sum(money("freight_value")).alias("freight"),
        )
        .join(named, "product_id")
        .groupBy("categoria")
        .agg(
            F.sum("items").alias("total_items"),
            F.sum("price").alias("revenue"),
            F.sum("prices").alias("prices"),
            F.sum("freight").alias("freight"),
        )
        .filter(F.col("revenue") > MIN_CATEGORY_REVENUE)
    )
    # Only the ids travel for the distinct count; the sums went by product. Adaptive
    # execution broadcasts the names where they turn out small and splits a hot product.
    orders = (
        t["order_items"].select("product_id", "order_id").join(named, "product_id")
        .groupBy("categoria")
        .agg(F.count_distinct("order_id").alias("total_ordenes"))
    )
    per_category = totals.join(orders, "categoria")
    return (
        per_category.select(
            "categoria",
            "total_ordenes",
            "total_items",
            r2("revenue").alias("revenue_total"),
            r2(exact_mean("revenue", "prices")).alias("precio_promedio"),
            r2("freight").alias("costo_envio_total"),
        )
        .orderBy(F.desc_nulls_first("revenue_total"), "categoria")
        .limit(TOP_CATEGORIES)
    )


def top_sellers(t: Tables) -> DataFrame:
    """The 10 sellers with the most delivered revenue, from 10 orders on.

    An order with k reviews counts k times in revenue and units, as in the plain
    join of items to reviews.
    """
    orders = _with_reviews(_delivered(t["orders"]).select("order_id"), t["reviews"])
    sold = t["order_items"].groupBy("seller_id", "order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("order_item_id").alias("items"),
        F.sum(money("price")).alias("price"),
        F.count("price").alias("prices"),
    )
    per_seller = (
        sold.join(orders, "order_id")
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("ordenes_completadas"),
            F.sum(F.col("price") * F.col("copies")).alias("revenue"),
            F.sum(F.col("prices") * F.col("copies")).alias("prices"),
            F.sum(F.col("items") * F.col("copies")).alias("productos_vendidos"),
            F.sum(F.col("rows") * F.col("score_sum")).alias("score_sum"),
            F.sum(F.col("rows") * F.col("scores")).alias("scores"),
        )
        .filter(F.col("ordenes_completadas") >= MIN_SELLER_ORDERS)
    )
    sellers = t["sellers"].select("seller_id", "seller_city", "seller_state")
    return (
        per_seller.join(sellers, "seller_id")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            "ordenes_completadas",
            r2("revenue").alias("revenue_total"),
            r2(exact_mean("revenue", "prices")).alias("ticket_promedio"),
            "productos_vendidos",
            r2(exact_mean("score_sum", "scores")).alias("rating_promedio"),
        )
        .orderBy(F.desc_nulls_first("revenue_total"), "seller_id")
        .limit(TOP_SELLERS)
    )


def delivery_times(t: Tables) -> DataFrame:
    """Mean delivery time, mean earliness, and late deliveries."""
    arrived = _arrived(t["orders"]).filter(F.col(_PURCHASED).isNotNull())
    late = F.count_if(F.col(_DELIVERED_ON) > F.col(_ESTIMATED))
    return arrived.groupBy("order_status").agg(
        F.count("order_id").alias("total_ordenes"),
        r2(mean_days(_DELIVERED_ON, _PURCHASED)).alias("dias_entrega_promedio"),
        r2(mean_days(_ESTIMATED, _DELIVERED_ON)).alias("diferencia_estimado_real"),
        late.alias("entregas_tarde"),
        r2(_percent(late, F.count("order_id"))).alias("porcentaje_tarde"),
    )


def customers_by_state(t: Tables) -> DataFrame:
    """Customers, orders and revenue per state, from 100 delivered orders on."""
    per_customer = _delivered(t["sales_summary"]).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(money("total_payment")).alias("payment"),
        F.count("total_payment").alias("payments"),
    )
    per_state = (
        t["customers"].select("customer_id", "customer_state")
        .join(per_customer, "customer_id")
        .groupBy(F.col("customer_state").alias("estado"))
        .agg(
            F.count("customer_id").alias("total_clientes"),
            F.sum("orders").alias("total_ordenes"),
            F.sum("payment").alias("payment"),
            F.sum("payments").alias("payments"),
        )
        .filter(F.col("total_ordenes") >= MIN_STATE_ORDERS)
    )
    return per_state.select(
        "estado",
        "total_clientes",
        "total_ordenes",
        r2(exact_mean("payment", "payments")).alias("ticket_promedio"),
        r2("payment").alias("revenue_total"),
        r2(exact_mean("total_ordenes", "total_clientes")).alias("ordenes_por_cliente"),
    ).orderBy(F.desc_nulls_first("revenue_total"), "estado")


def top_products(t: Tables) -> DataFrame:
    """The 3 products of each category sold most often."""
    sold = t["order_items"].groupBy("product_id").agg(
        F.count("order_id").alias("veces_vendido"), F.sum(money("price")).alias("price")
    )
    named = t["products"].filter(F.col("product_category_name_english").isNotNull()).select(
        "product_id", F.col("product_category_name_english").alias("categoria")
    )
    best_first = Window.partitionBy("categoria").orderBy(F.desc("veces_vendido"), "product_id")
    return (
        named.join(sold, "product_id")
        .withColumn("ranking", F.row_number().over(best_first))
        .filter(F.col("ranking") <= PRODUCTS_PER_CATEGORY)
        .orderBy("categoria", "ranking")
        .select("categoria", "product_id", "veces_vendido", r2("price").alias("revenue"))
    )


def payment_methods(t: Tables) -> DataFrame:
    """Orders, payments, amounts and instalments per payment method."""
    payments = t["payments"].withColumnRenamed("payment_type", "metodo_pago")
    totals = payments.groupBy("metodo_pago").agg(
        F.count("payment_sequential").alias("numero_pagos"),
        F.sum(money("payment_value")).alias("value"),
        F.count("payment_value").alias("values"),
        F.sum(F.col("payment_installments").cast("bigint")).alias("instalments"),
        F.count("payment_installments").alias("with_instalments"),
    )
    orders = payments.groupBy(F.col("metodo_pago").alias("_method")).agg(
        F.count_distinct("order_id").alias("ordenes_totales")
    )
    per_method = totals.join(orders, F.col("metodo_pago").eqNullSafe(F.col("_method")))
    return per_method.select(
        "metodo_pago",
        "ordenes_totales",
        "numero_pagos",
        r2("value").alias("monto_total"),
        r2(exact_mean("value", "values")).alias("monto_promedio"),
        r2(exact_mean("instalments", "with_instalments")).alias("cuotas_promedio"),
    ).orderBy(F.desc_nulls_first("ordenes_totales"), "metodo_pago")


def monthly_sales(t: Tables) -> DataFrame:
    """Orders, customers and revenue per month of purchase, latest first."""
    sold = t["sales_summary"].filter(
        F.col("order_status").isin(*SOLD_STATUSES)
        & F.col(_PURCHASED).isNotNull()
        & F.col("order_id").isNotNull()
    )
    per_month = sold.groupBy(
        F.year(_PURCHASED).alias("año"), F.month(_PURCHASED).alias("mes")
    ).agg(
        F.count("order_id").alias("ordenes"),
        F.count_distinct("customer_id").alias("clientes_unicos"),
        F.sum(money("total_payment")).alias("payment"),
        F.count("total_payment").alias("payments"),
    )
    return per_month.select(
        "año",
        "mes",
        "ordenes",
        "clientes_unicos",
        r2("payment").alias("revenue_total"),
        r2(exact_mean("payment", "payments")).alias("ticket_promedio"),
    ).orderBy(F.desc("año"), F.desc("mes"))


def review_scores(t: Tables) -> DataFrame:
    """Share, comments and mean answer time per review score."""
    per_score = (
        t["reviews"].filter(F.col("review_score").isNotNull())
        .groupBy("review_score")
        .agg(
            F.count("review_id").alias("total_reviews"),
            F.count_if(F.length("review_comment_message") > 0).alias("reviews_con_comentario"),
            r2(mean_days("review_answer_timestamp", "review_creation_date")).alias(
                "dias_promedio_respuesta"
            ),
        )
    )
    # One row per score by now, so the window over everything is a handful of rows.
    everything = F.sum("total_reviews").over(Window.partitionBy())
    return per_score.select(
        "review_score",
        "total_reviews",
        r2(_percent(F.col("total_reviews"), everything)).alias("porcentaje"),
        "reviews_con_comentario",
        "dias_promedio_respuesta",
    ).orderBy(F.desc("review_score"))


def top_customers(t: Tables) -> DataFrame:
    """The 20 customers with the highest delivered value, from 2 orders on.

    As in ``top_sellers``, an order with k reviews counts k times in the value.
    """
    orders = _with_reviews(
        _delivered(t["sales_summary"]).select(
            "order_id", "customer_id", _PURCHASED, money("total_payment").alias("payment")
        ),
        t["reviews"],
    )
    per_customer = (
        orders.groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("total_ordenes"),
            F.sum(F.col("payment") * F.col("copies")).alias("value"),
            F.sum(F.when(F.col("payment").isNotNull(), F.col("copies"))).alias("values"),
            F.max(_PURCHASED).alias("ultima_compra"),
            F.sum("score_sum").alias("score_sum"),
            F.sum("scores").alias("scores"),
        )
        .filter(F.col("total_ordenes") >= MIN_CUSTOMER_ORDERS)
    )
    return (
        t["customers"].select("customer_id", "customer_city", "customer_state")
        .join(per_customer, "customer_id")
        .select(
            "customer_id",
            "customer_city",
            "customer_state",
            "total_ordenes",
            r2("value").alias("lifetime_value"),
            r2(exact_mean("value", "values")).alias("ticket_promedio"),
            "ultima_compra",
            r2(exact_mean("score_sum", "scores")).alias("satisfaccion_promedio"),
        )
        .orderBy(F.desc_nulls_first("lifetime_value"), "customer_id")
        .limit(TOP_CUSTOMERS)
    )


def freight_by_state(t: Tables) -> DataFrame:
    """Freight cost per state and as a share of price, from 50 delivered orders on."""
    freight = money("freight_value")
    # Decimals, so that the sum does not depend on the order of rows.
    ratio = F.try_divide(
        F.col("freight_value").cast("double"), F.col("price").cast("double")
    ).cast("decimal(20,12)")
    per_order = (
        t["order_items"].filter(F.col("freight_value") > 0)
        .groupBy("order_id")
        .agg(
            F.count("freight_value").alias("items"),
            F.min(freight).alias("least"),
            F.max(freight).alias("most"),
            F.sum(freight).alias("freight"),
            F.sum(ratio).alias("ratio_sum"),
            F.count(ratio).alias("ratios"),
        )
    )
    totals = [
        F.sum("items").alias("items"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.sum("freight").alias("freight"),
        F.sum("ratio_sum").alias("ratio_sum"),
        F.sum("ratios").alias("ratios"),
    ]
    per_customer = (
        _delivered(t["orders"]).select("order_id", "customer_id")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), *totals)
    )
    per_state = (
        t["customers"].select("customer_id", "customer_state")
        .join(per_customer, "customer_id")
        .groupBy(F.col("customer_state").alias("estado"))
        .agg(F.sum("orders").alias("ordenes"), *totals)
        .filter(F.col("ordenes") >= MIN_FREIGHT_ORDERS)
    )
    return per_state.select(
        "estado",
        "ordenes",
        r2(exact_mean("freight", "items")).alias("costo_envio_promedio"),
        r2("least").alias("costo_envio_minimo"),
        r2("most").alias("costo_envio_maximo"),
        r2("freight").alias("costo_envio_total"),
        r2(F.lit(100.0) * exact_mean("ratio_sum", "ratios")).alias("porcentaje_envio_vs_precio"),
    ).orderBy(F.desc_nulls_first("costo_envio_promedio"), "estado")


def cohort_retention(t: Tables) -> DataFrame:
    """Customers by month of first purchase who bought again 1, 2 and 3 months on.

    Orders are reduced to (customer, month) first. The window over a customer then
    sees at most one row per calendar month, and since those pairs are distinct,
    plain counts take the place of distinct ones.
    """
    active = (
        t["orders"].filter(
            (F.col("order_status") == "delivered") & F.col("customer_id").isNotNull()
        )
        .select("customer_id", month_start(_PURCHASED).alias("month"))
        .distinct()
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    placed = active.select("month", first.alias("cohort_mes"))

    def bought_after(months: int) -> Column:
        later = F.col("cohort_mes") + F.make_ym_interval(F.lit(0), F.lit(months))
        return F.count_if(F.col("month") == later).alias(f"mes_{months}")

    return (
        placed.groupBy("cohort_mes")
        .agg(*[bought_after(n) for n in range(COHORT_MONTHS)])
        .orderBy(F.asc_nulls_last("cohort_mes"))
    )


def _delivery_and_rating(t: Tables) -> tuple[DataFrame, DataFrame]:
    days = _arrived(t["orders"]).agg(
        r2(mean_days(_DELIVERED_ON, _PURCHASED)).alias("avg_delivery_days")
    )
    rating = t["reviews"].agg(
        r2(
            exact_mean(F.sum(F.col("review_score").cast("bigint")), F.count("review_score"))
        ).alias("avg_rating")
    )
    return days, rating


def _dashboard(t: Tables, payment: Column) -> DataFrame:
    """One row of key figures; ``payment`` is what an order adds to the revenue.

    Orders are reduced to customers on the way to the totals, so the distinct
    customers need no second count. The distinct products come from their own
    branch over the delivered orders' items.
    """
    items = t["order_items"].filter(F.col("order_id").isNotNull())
    delivered = _delivered(t["sales_summary"])
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    general = (
        delivered.select("order_id", "customer_id", money("total_payment").alias("payment"))
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(payment).alias("revenue"))
        .agg(
            F.coalesce(F.sum("orders"), F.lit(0)).alias("total_ordenes"),
            F.count("customer_id").alias("total_clientes"),
            r2(F.sum("revenue")).alias("revenue_total"),
        )
    )
    # Two thirds of the items go before anything is made distinct. Both sides of the join
    # come straight from a shuffle, so adaptive execution can split a hot order.
    products = (
        items.select("order_id", "product_id")
        .join(_delivered(t["orders"]).select("order_id"), "order_id", "left_semi")
        .agg(F.count_distinct("product_id").alias("total_productos"))
    )
    days, rating = _delivery_and_rating(t)
    return general.select(
        "total_ordenes",
        "total_clientes",
        products.scalar().alias("total_productos"),
        "revenue_total",
        r2(exact_mean("revenue_total", "total_ordenes")).alias("ticket_promedio"),
        days.scalar().alias("avg_delivery_days"),
        rating.scalar().alias("avg_rating"),
    )


def dashboard(t: Tables) -> DataFrame:
    """Key figures; an order's payment counts once per item of the order."""
    return _dashboard(t, F.col("payment") * F.col("items"))


def dashboard_no_fanout(t: Tables) -> DataFrame:
    """Key figures with each order's payment counted once."""
    return _dashboard(t, F.col("payment"))


REPORTS = {
    "q01_category_sales": category_sales,
    "q02_top_sellers": top_sellers,
    "q03_delivery_times": delivery_times,
    "q04_customers_by_state": customers_by_state,
    "q05_top_products": top_products,
    "q06_payment_methods": payment_methods,
    "q07_monthly_sales": monthly_sales,
    "q08_review_scores": review_scores,
    "q09_top_customers": top_customers,
    "q10_freight_by_state": freight_by_state,
    "q11_cohort_retention": cohort_retention,
    "q12_dashboard": dashboard,
    "q12b_dashboard_no_fanout": dashboard_no_fanout,
}
