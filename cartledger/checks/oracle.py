"""DuckDB SQL giving the expected result of every registered query.

The order model is spelled out as CTEs over the star-schema views; a query names
the CTEs it needs and gets them prepended. Written from the definitions of the
results, not from the Spark code.
"""

from __future__ import annotations

import re

_CTES = {
    "m_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                                  WHEN 'P' THEN 'processing' END AS order_status,
               o_orderdate AS order_purchase_timestamp,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 33 <> 0
                    THEN o_orderdate + to_hours(CAST((o_orderkey * 7) % 960 AS BIGINT))
               END AS order_delivered_customer_date,
               o_orderdate + to_hours(CAST(600 AS BIGINT)) AS order_estimated_delivery_date
        FROM orders""",
    "m_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
                    AS DECIMAL(18,2)) AS freight_value
        FROM lineitem""",
    "m_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
                                 ELSE 'voucher' END AS payment_type,
               CAST(1 + l_linenumber % 4 AS INTEGER) AS payment_installments,
               CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))
                          * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)
                    AS DECIMAL(18,2)) AS payment_value
        FROM lineitem""",
    "m_raw_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS product_category_name
        FROM part""",
    "m_translation": """
        SELECT DISTINCT p_type AS product_category_name,
               lower(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'SMALL'""",
    "m_products": """
        SELECT p.product_id, p.product_category_name, t.product_category_name_english
        FROM m_raw_products p LEFT JOIN m_translation t
          ON p.product_category_name = t.product_category_name""",
    "m_customers": """
        SELECT c_custkey AS customer_id, 'city_' || (c_custkey % 40) AS customer_city,
               n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "m_sellers": """
        SELECT s_suppkey AS seller_id, 'city_' || (s_suppkey % 40) AS seller_city,
               n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "m_reviews": """
        SELECT event_id AS review_id, (event_id // 2) * 3 AS order_id,
               CASE WHEN event_type = 'error' THEN NULL
                    ELSE CAST(1 + user_id % 5 AS INTEGER) END AS review_score,
               CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN NULL
                               ELSE props END AS review_comment_message,
               ts AS review_creation_date,
               ts + to_hours(CAST(event_id % 72 AS BIGINT)) AS review_answer_timestamp
        FROM events""",
    "m_item_totals": """
        SELECT order_id, COUNT(order_item_id) AS total_items,
               COALESCE(SUM(price), 0) AS total_price,
               COALESCE(SUM(freight_value), 0) AS total_freight
        FROM m_items WHERE order_id IS NOT NULL GROUP BY order_id""",
    "m_payment_totals": """
        SELECT order_id, COALESCE(SUM(payment_value), 0) AS total_payment
        FROM m_payments WHERE order_id IS NOT NULL GROUP BY order_id""",
    "m_sales_summary": """
        SELECT o.*, i.total_items, i.total_price, i.total_freight, p.total_payment
        FROM m_orders o
        LEFT JOIN m_item_totals i ON o.order_id = i.order_id
        LEFT JOIN m_payment_totals p ON o.order_id = p.order_id""",
    "m_derived_orders": """
        SELECT *,
               CAST(floor((epoch_us(order_delivered_customer_date)
                           - epoch_us(order_purchase_timestamp)) / 86400000000.0)
                    AS BIGINT) AS delivery_time_days,
               CAST(floor((epoch_us(order_delivered_customer_date)
                           - epoch_us(order_estimated_delivery_date)) / 86400000000.0)
                    AS BIGINT) AS delivery_delay_days,
               CAST(year(order_purchase_timestamp) AS INTEGER) AS purchase_year,
               CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
               CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_day_of_week
        FROM m_orders""",
}


def _with_ctes(sql: str, given: frozenset[str] = frozenset()) -> str:
    """Prepend the CTEs that ``sql`` refers to, directly or through other CTEs.

    Names in ``given`` are left to be resolved as tables.
    """
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in set(re.findall(r"\bm_\w+", text)) & set(_CTES) - needed - given:
            needed.add(name)
            todo.append(_CTES[name])
    ctes = [f"{name} AS ({_CTES[name].strip()})" for name in _CTES if name in needed]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _r2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def _mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def _micros(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier}))"


def _mean_days(micros: str) -> str:
    return f"(CAST(SUM({micros}) AS DOUBLE) / NULLIF(COUNT({micros}), 0) / 86400000000.0)"


_ARRIVAL = _micros("order_delivered_customer_date", "order_purchase_timestamp")
_EARLINESS = _micros("order_estimated_delivery_date", "order_delivered_customer_date")
_ANSWER = _micros("review_answer_timestamp", "review_creation_date")


def _share(part: str, whole: str) -> str:
    return f"100.0 * {part} / CAST({whole} AS DOUBLE)"


# The thresholds, list lengths and statuses in the reports define them.
_REPORTS = {
    "q01_category_sales": f"""
        WITH sales AS (
          SELECT i.*, product_category_name_english AS categoria
          FROM m_items i JOIN m_products USING (product_id)
          WHERE product_category_name_english IS NOT NULL)
        SELECT categoria,
               COUNT(DISTINCT order_id) AS total_ordenes,
               COUNT(order_item_id) AS total_items,
               {_r2('SUM(price)')} AS revenue_total,
               {_r2(_mean('price'))} AS precio_promedio,
               {_r2('SUM(freight_value)')} AS costo_envio_total
        FROM sales GROUP BY categoria HAVING SUM(price) > 1000
        ORDER BY revenue_total DESC NULLS FIRST, categoria LIMIT 20""",
    "q02_top_sellers": f"""
        WITH lines AS (
          SELECT i.*, review_score
          FROM (SELECT order_id FROM m_orders WHERE order_status = 'delivered') d
          JOIN m_items i USING (order_id)
          LEFT JOIN m_reviews r USING (order_id)),
        totals AS (
          SELECT seller_id,
                 COUNT(DISTINCT order_id) AS ordenes_completadas,
                 {_r2('SUM(price)')} AS revenue_total,
                 {_r2(_mean('price'))} AS ticket_promedio,
                 COUNT(order_item_id) AS productos_vendidos,
                 {_r2(_mean('review_score'))} AS rating_promedio
          FROM lines GROUP BY seller_id)
        SELECT totals.*, seller_city, seller_state
        FROM totals JOIN m_sellers USING (seller_id)
        WHERE ordenes_completadas >= 10
        ORDER BY revenue_total DESC NULLS FIRST, seller_id LIMIT 10""",
    "q03_delivery_times": f"""
        WITH arrivals AS (
          SELECT order_status, order_id, {_ARRIVAL} AS taken, {_EARLINESS} AS early
          FROM m_orders
          WHERE order_status = 'delivered'
            AND order_purchase_timestamp IS NOT NULL
            AND order_delivered_customer_date IS NOT NULL)
        SELECT order_status,
               COUNT(order_id) AS total_ordenes,
               {_r2(_mean_days('taken'))} AS dias_entrega_promedio,
               {_r2(_mean_days('early'))} AS diferencia_estimado_real,
               COUNT(*) FILTER (WHERE early < 0) AS entregas_tarde,
               {_r2(_share('COUNT(*) FILTER (WHERE early < 0)', 'COUNT(order_id)'))}
                 AS porcentaje_tarde
        FROM arrivals GROUP BY order_status""",
    "q04_customers_by_state": f"""
        WITH paid AS (
          SELECT customer_state AS estado, customer_id, order_id, total_payment
          FROM m_sales_summary JOIN m_customers USING (customer_id)
          WHERE order_status = 'delivered')
        SELECT estado, total_clientes, total_ordenes, ticket_promedio, revenue_total,
               {_r2('CAST(total_ordenes AS DOUBLE) / total_clientes')} AS ordenes_por_cliente
        FROM (SELECT estado,
                     COUNT(DISTINCT customer_id) AS total_clientes,
                     COUNT(DISTINCT order_id) AS total_ordenes,
                     {_r2(_mean('total_payment'))} AS ticket_promedio,
                     {_r2('SUM(total_payment)')} AS revenue_total
              FROM paid GROUP BY estado)
        WHERE total_ordenes >= 100
        ORDER BY revenue_total DESC NULLS FIRST, estado""",
    "q05_top_products": f"""
        SELECT product_category_name_english AS categoria, product_id,
               COUNT(order_id) AS veces_vendido, {_r2('SUM(price)')} AS revenue
        FROM m_items JOIN m_products USING (product_id)
        WHERE categoria IS NOT NULL
        GROUP BY categoria, product_id
        QUALIFY ROW_NUMBER() OVER (
          PARTITION BY categoria ORDER BY veces_vendido DESC, product_id) <= 3
        ORDER BY categoria, veces_vendido DESC, product_id""",
    "q06_payment_methods": f"""
        SELECT payment_type AS metodo_pago,
               COUNT(DISTINCT order_id) AS ordenes_totales,
               COUNT(payment_sequential) AS numero_pagos,
               {_r2('SUM(payment_value)')} AS monto_total,
               {_r2(_mean('payment_value'))} AS monto_promedio,
               {_r2(_mean('payment_installments'))} AS cuotas_promedio
        FROM m_payments GROUP BY ALL
        ORDER BY ordenes_totales DESC, metodo_pago""",
    "q07_monthly_sales": f"""
        WITH sold AS (
          SELECT CAST(date_part('year', order_purchase_timestamp) AS INTEGER) AS "año",
                 CAST(date_part('month', order_purchase_timestamp) AS INTEGER) AS mes,
                 order_id, customer_id, total_payment
          FROM m_sales_summary
          WHERE order_status IN ('delivered', 'shipped'))
        SELECT "año", mes,
               COUNT(DISTINCT order_id) AS ordenes,
               COUNT(DISTINCT customer_id) AS clientes_unicos,
               {_r2('SUM(total_payment)')} AS revenue_total,
               {_r2(_mean('total_payment'))} AS ticket_promedio
        FROM sold WHERE mes IS NOT NULL GROUP BY "año", mes ORDER BY "año" DESC, mes DESC""",
    "q08_review_scores": f"""
        WITH scored AS (
          SELECT *, {_ANSWER} AS answered FROM m_reviews WHERE review_score IS NOT NULL)
        SELECT review_score,
               COUNT(review_id) AS total_reviews,
               {_r2(_share('COUNT(review_id)', '(SELECT COUNT(review_id) FROM scored)'))}
                 AS porcentaje,
               COUNT(*) FILTER (WHERE review_comment_message <> '') AS reviews_con_comentario,
               {_r2(_mean_days('answered'))} AS dias_promedio_respuesta
        FROM scored GROUP BY review_score ORDER BY review_score DESC""",
    "q09_top_customers": f"""
        WITH bought AS (
          SELECT s.customer_id, s.order_id, total_payment, order_purchase_timestamp, review_score
          FROM m_sales_summary s LEFT JOIN m_reviews r USING (order_id)
          WHERE order_status = 'delivered' AND s.order_id IS NOT NULL),
        totals AS (
          SELECT customer_id,
                 COUNT(DISTINCT order_id) AS total_ordenes,
                 {_r2('SUM(total_payment)')} AS lifetime_value,
                 {_r2(_mean('total_payment'))} AS ticket_promedio,
                 MAX(order_purchase_timestamp) AS ultima_compra,
                 {_r2(_mean('review_score'))} AS satisfaccion_promedio
          FROM bought GROUP BY customer_id)
        SELECT totals.*, customer_city, customer_state
        FROM totals JOIN m_customers USING (customer_id)
        WHERE total_ordenes >= 2
        ORDER BY lifetime_value DESC NULLS FIRST, customer_id LIMIT 20""",
    "q10_freight_by_state": f"""
        WITH shipped AS (
          SELECT customer_state AS estado, order_id, freight_value,
                 CAST(CAST(freight_value AS DOUBLE) / NULLIF(CAST(price AS DOUBLE), 0)
                      AS DECIMAL(20,12)) AS part
          FROM m_items JOIN m_orders USING (order_id) JOIN m_customers USING (customer_id)
          WHERE freight_value > 0 AND order_status = 'delivered')
        SELECT estado,
               COUNT(DISTINCT order_id) AS ordenes,
               {_r2(_mean('freight_value'))} AS costo_envio_promedio,
               {_r2('MIN(freight_value)')} AS costo_envio_minimo,
               {_r2('MAX(freight_value)')} AS costo_envio_maximo,
               {_r2('SUM(freight_value)')} AS costo_envio_total,
               {_r2('100.0 * ' + _mean('part'))} AS porcentaje_envio_vs_precio
        FROM shipped GROUP BY estado HAVING COUNT(DISTINCT order_id) >= 50
        ORDER BY costo_envio_promedio DESC NULLS FIRST, estado""",
    "q11_cohort_retention": f"""
        WITH placed AS (
          SELECT customer_id, order_purchase_timestamp AS bought_at,
                 MIN(order_purchase_timestamp) OVER (PARTITION BY customer_id) AS first_at
          FROM m_orders WHERE order_status = 'delivered' AND customer_id IS NOT NULL),
        steps AS (
          SELECT customer_id, CAST(date_trunc('month', first_at) AS TIMESTAMP) AS cohort_mes,
                 date_diff('month', first_at, bought_at) AS step
          FROM placed)
        SELECT cohort_mes,
               {", ".join(
                   f"COUNT(DISTINCT customer_id) FILTER (WHERE step = {n}) AS mes_{n}"
                   for n in range(4))}
        FROM steps GROUP BY cohort_mes ORDER BY cohort_mes""",
}


def _dashboard(copies: str) -> str:
    """Key figures in which an order counts ``copies`` times in the revenue."""
    return f"""
        WITH sold AS (
          SELECT order_id, COUNT(*) AS items FROM m_items GROUP BY order_id),
        delivered AS (
          SELECT order_id, customer_id, total_payment, items
          FROM m_sales_summary JOIN sold USING (order_id) WHERE order_status = 'delivered'),
        figures AS (
          SELECT COUNT(DISTINCT order_id) AS total_ordenes,
                 COUNT(DISTINCT customer_id) AS total_clientes,
                 {_r2(f'SUM(total_payment * {copies})')} AS revenue_total
          FROM delivered)
        SELECT total_ordenes, total_clientes,
               (SELECT COUNT(DISTINCT product_id)
                FROM m_items SEMI JOIN delivered USING (order_id)) AS total_productos,
               revenue_total,
               {_r2('revenue_total / NULLIF(total_ordenes, 0)')} AS ticket_promedio,
               (SELECT {_r2(_mean_days(_ARRIVAL))} FROM m_orders
                WHERE order_status = 'delivered') AS avg_delivery_days,
               (SELECT {_r2(_mean('review_score'))} FROM m_reviews) AS avg_rating
        FROM figures"""


_REPORTS["q12_dashboard"] = _dashboard("items")
_REPORTS["q12b_dashboard_no_fanout"] = _dashboard("1")

_SUMMARY_COLUMNS = """order_id, customer_id, order_status, order_purchase_timestamp,
    order_delivered_customer_date, order_estimated_delivery_date,
    purchase_year, purchase_month, purchase_day_of_week"""
_DERIVED = """
    SELECT * REPLACE (CAST(delivery_time_days AS DOUBLE) AS delivery_time_days,
                      CAST(delivery_delay_days AS DOUBLE) AS delivery_delay_days)
    FROM m_derived_orders"""
_SUMMARY = f"""
    SELECT {', '.join('d.' + c.strip() for c in _SUMMARY_COLUMNS.split(','))},
           CAST(d.delivery_time_days AS DOUBLE) AS delivery_time_days,
           CAST(d.delivery_delay_days AS DOUBLE) AS delivery_delay_days,
           CAST(i.total_items AS DOUBLE) AS total_items, CAST(i.total_price AS DOUBLE) AS total_price,
           CAST(i.total_freight AS DOUBLE) AS total_freight,
           CAST(p.total_payment AS DOUBLE) AS total_payment
    FROM m_derived_orders d
    LEFT JOIN (SELECT order_id, COUNT(order_item_id) AS total_items, SUM(price) AS total_price,
                      SUM(freight_value) AS total_freight
               FROM (SELECT DISTINCT * FROM m_items) GROUP BY order_id) i
      ON d.order_id = i.order_id
    LEFT JOIN m_payment_totals p ON d.order_id = p.order_id"""


def _profile(table: str, columns: dict[str, str]) -> str:
    """Quality rows of ``table``; ``columns`` maps a name to its Spark type name."""
    rows = [
        f"""SELECT '{c}' AS "Columna", '{t}' AS "Tipo", COUNT({c}) AS "No_Nulos",
               COUNT(*) - COUNT({c}) AS "Nulos",
               {_r2(f'100.0 * (COUNT(*) - COUNT({c})) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE)')}
                 AS "Porcentaje_Nulos",
               COUNT(DISTINCT {c}) AS "Valores_Unicos" FROM {table}"""
        for c, t in columns.items()
    ]
    return "\nUNION ALL\n".join(rows)


_SUMMARY_TYPES = {
    "order_id": "bigint",
    "customer_id": "bigint",
    "order_status": "string",
    "order_purchase_timestamp": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
    "total_items": "bigint",
    "total_price": "decimal(28,2)",
    "total_freight": "decimal(28,2)",
    "total_payment": "decimal(28,2)",
}
_LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}


def _info(table: str, types: dict[str, str]) -> str:
    first = ", ".join(list(types)[:10])
    rows = [
        f"""SELECT '{table}' AS "table", COUNT(*) AS "rows",
               CAST({len(types)} AS INTEGER) AS "columns", '{first}' AS first_columns,
               CAST({i} AS INTEGER) AS "position", '{c}' AS "column", '{t}' AS "type",
               COUNT(*) - COUNT({c}) AS nulls FROM m_sales_summary"""
        for i, (c, t) in enumerate(types.items())
    ]
    return "\nUNION ALL\n".join(rows)


def _counts(tables: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS "table", COUNT(*) AS "rows" FROM {source}"""
        for name, source in tables.items()
    )


_ITEMS = """order_id, order_item_id, product_id, seller_id,
    CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value"""
_ORDERS = """order_id, customer_id, order_status, order_purchase_timestamp,
    order_delivered_customer_date, order_estimated_delivery_date"""
_SUMMARY_RAW = f"""SELECT {_ORDERS}, CAST(total_items AS DOUBLE) AS total_items,
    CAST(total_price AS DOUBLE) AS total_price,
    CAST(total_freight AS DOUBLE) AS total_freight,
    CAST(total_payment AS DOUBLE) AS total_payment FROM m_sales_summary"""
_DIRTY_PARTS = """
    SELECT p_partkey,
           CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS size,
           CASE WHEN p_partkey % 7 = 0 THEN NULL
                ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS price,
           p_partkey + 9007199254740992 AS ean,
           CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS brand
    FROM part"""



def _soiled(table: str, key: str, **changes: str) -> str:
    """The table, and every fifth key once more with other values."""
    key = key.split(",")[0]
    replaced = ", ".join(f"{value} AS {c}" for c, value in changes.items())
    return f"""SELECT * FROM {table} UNION ALL
        SELECT * REPLACE ({replaced}) FROM {table} WHERE {key} % 5 = 0"""


def _first(table: str, keys: str, columns: str) -> str:
    """The least row of each key, by the other columns in their order, nulls before all."""
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))
    return f"""SELECT * FROM {table}
        QUALIFY ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"""


_RUN = {
    "customers": ("m_customers", "m_customers"),
    "orders": ("m_orders", "m_orders"),
    "order_items": ("m_items", "(SELECT DISTINCT * FROM m_items)"),
    "products": ("m_raw_products", "m_products"),
    "sellers": ("m_sellers", "m_sellers"),
    "payments": ("m_payments", "m_payments"),
    "reviews": ("m_reviews", "m_reviews"),
}


def _phases() -> str:
    """Rows in and out of each phase of a run that exports Parquet."""
    n = "CAST((SELECT COUNT(*) FROM {}) AS {})".format
    rows = []
    for name, (raw, cleaned) in _RUN.items():
        rows += [
            f"SELECT 'extract' AS step, '{name}' AS \"table\", NULL AS rows_in, {n(raw, 'BIGINT')} AS rows_out",
            f"SELECT 'clean', '{name}', {n(raw, 'DOUBLE')}, {n(cleaned, 'BIGINT')}",
            f"SELECT 'export_parquet', '{name}', {n(cleaned, 'DOUBLE')}, {n(cleaned, 'BIGINT')}",
        ]
    rows += [
        f"SELECT 'extract', 'category_translation', NULL, {n('m_translation', 'BIGINT')}",
        f"SELECT 'summarise', 'sales_summary', {n('m_orders', 'DOUBLE')}, {n('m_orders', 'BIGINT')}",
        f"SELECT 'export_parquet', 'sales_summary', {n('m_orders', 'DOUBLE')}, {n('m_orders', 'BIGINT')}",
    ]
    return "\nUNION ALL\n".join(rows)


_MODES = f"""WITH d AS ({_DIRTY_PARTS}),
        top AS (SELECT brand FROM d WHERE brand IS NOT NULL GROUP BY brand
                ORDER BY COUNT(*) DESC, brand LIMIT 1),
        top_size AS (SELECT size FROM d WHERE size IS NOT NULL GROUP BY size
                     ORDER BY COUNT(*) DESC, size LIMIT 1)
        SELECT p_partkey, COALESCE(size, (SELECT size FROM top_size)) AS size,
               CAST(price AS DOUBLE) AS price, ean,
               COALESCE(brand, (SELECT brand FROM top)) AS brand
        FROM d"""

_OPERATORS = {
    "src_csv": "SELECT * FROM m_customers",
    "src_parquet": f"SELECT {_ITEMS} FROM m_items",
    "src_csv_mixed": "SELECT * FROM m_customers",
    "src_csv_dirty": """
        SELECT order_id,
               CASE WHEN order_id % 5 = 0 OR order_id % 7 = 0 THEN NULL
                    ELSE CAST(customer_id AS DOUBLE) END AS customer_id,
               CASE WHEN order_id % 97 <> 0 THEN order_purchase_timestamp END
                 AS order_purchase_timestamp,
               concat_ws(',', CASE WHEN order_id % 5 <> 0 AND order_id % 7 = 0
                                   THEN 'customer_id' END,
                              CASE WHEN order_id % 97 = 0 THEN 'order_purchase_timestamp' END)
                 AS misfits
        FROM m_orders""",
    "src_catalog_types": """
        SELECT (SELECT COUNT(*) FROM part) AS "rows", "column", "type"
        FROM (VALUES ('product_id', 'string'), ('product_category_name', 'string'),
                     ('product_height_cm', 'int'), ('product_weight_g', 'double'),
                     ('product_code', 'string'), ('product_photos_qty', 'int'),
                     ('product_ean', 'bigint')) t("column", "type")""",
    "src_catalog": _counts(
        {
            "customers": "m_customers",
            "orders": "m_orders",
            "order_items": "m_items",
            "products": "m_raw_products",
            "sellers": "m_sellers",
            "payments": "m_payments",
            "reviews": "m_reviews",
            "category_translation": "m_translation",
        }
    ),
    "src_query": """SELECT payment_type, COUNT(*) AS payments,
                      CAST(SUM(payment_value) AS DOUBLE) AS total, 'payments' AS source
                    FROM m_payments GROUP BY payment_type""",
    "snk_parquet": """SELECT order_id, payment_sequential, payment_type, payment_installments,
                        CAST(payment_value AS DOUBLE) AS payment_value
                      FROM m_payments UNION ALL
                      SELECT order_id, payment_sequential, payment_type, payment_installments,
                        CAST(payment_value AS DOUBLE) AS payment_value FROM m_payments""",
    "snk_csv": _SUMMARY_RAW,
    "snk_bundle": 'SELECT *, COUNT(*) OVER () AS "rows" FROM m_customers',
    "snk_bundle_versioned": "SELECT *, CAST(2 AS BIGINT) AS versions FROM m_customers",
    "snk_table": "SELECT * FROM m_sellers",
    "snk_table_many": """SELECT 'customers' AS "table", TRUE AS ok,
                                CAST(COUNT(*) AS DOUBLE) AS "rows" FROM m_customers UNION ALL
                         SELECT 'broken', FALSE, NULL UNION ALL
                         SELECT 'sellers', TRUE, COUNT(*) FROM m_sellers""",
    "cat_table_exists": """SELECT 'sellers' AS "table", COUNT(*) > 0 AS present FROM m_sellers
                           UNION ALL SELECT 'no_such_table', FALSE""",
    "cat_row_count": 'SELECT COUNT(*) AS "rows" FROM m_items',
    "cln_names": f"SELECT {_ORDERS} FROM m_orders",
    "cln_dates": """SELECT o_orderkey AS order_id,
                      CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END
                        AS order_purchase_timestamp
                    FROM orders""",
    "cln_date_formats": """
        SELECT order_id,
               CASE WHEN order_id % 97 <> 0 AND order_id % 89 <> 0
                    THEN date_trunc('minute', order_purchase_timestamp) END AS bought,
               CASE WHEN order_id % 83 <> 0 THEN date_trunc('second', order_estimated_delivery_date) END AS due,
               'day_first' AS bought_form, 'month_first' AS due_form,
               COUNT(*) FILTER (order_id % 97 = 0 OR order_id % 89 = 0) OVER () AS bought_misfits,
               COUNT(*) FILTER (order_id % 83 = 0) OVER () AS due_misfits
        FROM m_orders""",
    "cln_null_drop": f"""SELECT p_partkey, size, CAST(price AS DOUBLE) AS price, ean, brand
        FROM ({_DIRTY_PARTS}) WHERE size IS NOT NULL AND price IS NOT NULL
          AND brand IS NOT NULL""",
    "cln_null_zero": f"""SELECT p_partkey, COALESCE(size, 0) AS size,
          CAST(COALESCE(price, 0) AS DOUBLE) AS price, ean, brand FROM ({_DIRTY_PARTS})""",
    "cln_null_mean": f"""WITH d AS ({_DIRTY_PARTS})
        SELECT p_partkey,
               COALESCE(size, (SELECT SUM(size) / COUNT(size) FROM d)) AS size,
               COALESCE(CAST(price AS DOUBLE),
                        (SELECT CAST(CAST(CAST(SUM(price) AS DOUBLE) / COUNT(price)
                                          AS DECIMAL(38,8)) AS DOUBLE) FROM d)) AS price,
               ean, brand
        FROM d""",
    "cln_null_mode": _MODES,
    "cln_null_mode_summaries": _MODES,
    "cln_dedup_row": f"SELECT {_ORDERS} FROM m_orders",
    "cln_dedup_row_two_pass": f"""SELECT DISTINCT {', '.join(
        f'CASE WHEN order_id % 3 <> 0 THEN {c.strip()} END AS {c.strip()}' for c in _ORDERS.split(','))}
        FROM m_orders""",
    "cln_dedup_key": """
        SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
               CAST(freight_value AS DOUBLE) AS freight_value
        FROM (SELECT *, ROW_NUMBER() OVER (
                PARTITION BY order_id, order_item_id
                ORDER BY product_id, seller_id, price, freight_value) AS copy FROM m_items)
        WHERE copy = 1""",
    "drv_orders": _DERIVED,
    "drv_delivery_days": """SELECT order_id,
        CAST(delivery_time_days AS DOUBLE) AS delivery_time_days FROM m_derived_orders""",
    "drv_delay_days": """SELECT order_id,
        CAST(delivery_delay_days AS DOUBLE) AS delivery_delay_days FROM m_derived_orders""",
    "drv_calendar": """SELECT order_id, purchase_year, purchase_month, purchase_day_of_week
                       FROM m_derived_orders""",
    "jn_orders_items": """
        SELECT o.order_id, customer_id, order_status, order_purchase_timestamp,
               order_delivered_customer_date, order_estimated_delivery_date, order_item_id,
               product_id, seller_id, CAST(price AS DOUBLE) AS price,
               CAST(freight_value AS DOUBLE) AS freight_value
        FROM m_orders o JOIN m_items i ON o.order_id = i.order_id""",
    "jn_orders_items_products": """
        SELECT i.product_id, o.order_id, customer_id, order_status, order_purchase_timestamp,
               order_delivered_customer_date, order_estimated_delivery_date, order_item_id,
               seller_id, CAST(price AS DOUBLE) AS price,
               CAST(freight_value AS DOUBLE) AS freight_value, product_category_name
        FROM m_orders o JOIN m_items i ON o.order_id = i.order_id
        LEFT JOIN m_raw_products p ON i.product_id = p.product_id""",
    "jn_orders_items_skewed": f"""
        WITH skewed AS (
          SELECT * REPLACE (CASE WHEN order_item_id % 3 = 0 THEN 6 ELSE order_id END AS order_id)
          FROM m_items)
        SELECT {', '.join('o.' + c.strip() for c in _ORDERS.split(','))}, order_item_id, product_id, seller_id,
               CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
        FROM m_orders o JOIN skewed i ON o.order_id = i.order_id""",
    "jn_products_skewed": f"""
        WITH skewed AS (
          SELECT * REPLACE (CASE WHEN order_item_id % 3 = 0 THEN 6 ELSE product_id END AS product_id)
          FROM m_items)
        SELECT i.product_id, {', '.join('o.' + c.strip() for c in _ORDERS.split(','))}, order_item_id, seller_id,
               CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
               product_category_name
        FROM m_orders o JOIN skewed i ON o.order_id = i.order_id
        LEFT JOIN m_raw_products p ON i.product_id = p.product_id""",
    "jn_translate": """SELECT product_id, product_category_name, product_category_name_english
                       FROM m_products""",
    "agg_items_per_order": """SELECT order_id, total_items,
        CAST(total_price AS DOUBLE) AS total_price,
        CAST(total_freight AS DOUBLE) AS total_freight FROM m_item_totals""",
    "agg_payments_per_order": """SELECT order_id, CAST(total_payment AS DOUBLE) AS total_payment
                                 FROM m_payment_totals""",
    "agg_by_category": f"""
        SELECT product_category_name, COUNT(o.order_id) AS total_orders,
               CAST(SUM(price) AS DOUBLE) AS total_revenue, {_mean('price')} AS avg_price,
               CAST(SUM(freight_value) AS DOUBLE) AS total_freight
        FROM m_orders o JOIN m_items i ON o.order_id = i.order_id
        LEFT JOIN m_raw_products p ON i.product_id = p.product_id
        GROUP BY product_category_name""",
    "mart_sales_summary": _SUMMARY,
    "mart_orders": f"""WITH soiled AS ({_soiled('m_orders', 'order_id', customer_id='1099511627776')}),
        first AS ({_first('soiled', 'order_id', 'customer_id, order_status')}),
        cleaned AS (
          SELECT * REPLACE (CASE WHEN order_id % 97 <> 0 THEN order_purchase_timestamp END
                            AS order_purchase_timestamp) FROM first),
        derived AS ({_CTES['m_derived_orders'].replace('m_orders', 'cleaned')})
        SELECT * REPLACE (CAST(delivery_time_days AS DOUBLE) AS delivery_time_days,
                          CAST(delivery_delay_days AS DOUBLE) AS delivery_delay_days)
        FROM derived""",
    "mart_customers": f"""WITH soiled AS ({_soiled('m_customers', 'customer_id', customer_city="'zz'")})
        {_first('soiled', 'customer_id', 'customer_city, customer_state')}""",
    "mart_products": f"""
        WITH soiled AS ({_soiled('m_raw_products', 'product_id', product_category_name="'zz'")}),
        first AS ({_first('soiled', 'product_id', 'product_category_name')})
        SELECT first.*, product_category_name_english
        FROM first LEFT JOIN m_translation USING (product_category_name)""",
    "mart_order_items": f"""WITH twice AS (
          SELECT * FROM m_items UNION ALL SELECT * FROM m_items WHERE order_id % 5 = 0)
        SELECT {_ITEMS} FROM (SELECT DISTINCT * FROM twice)""",
    "mart_payments": """SELECT order_id, payment_sequential, payment_type, payment_installments,
                          CAST(payment_value AS DOUBLE) AS payment_value FROM m_payments""",
    "mart_reviews": f"""WITH soiled AS ({_soiled('m_reviews', 'review_id', review_score='9')}),
        first AS ({_first('soiled', 'review_id, order_id', 'review_score, review_comment_message')})
        SELECT * REPLACE (CAST(review_score AS DOUBLE) AS review_score) FROM first""",
    "mart_sellers": f"""WITH soiled AS ({_soiled('m_sellers', 'seller_id', seller_city="'zz'")})
        {_first('soiled', 'seller_id', 'seller_city, seller_state')}""",
    "prf_quality": _profile("m_sales_summary", _SUMMARY_TYPES),
    "prf_quality_lineitem": _profile("lineitem", _LINEITEM_TYPES),
    "prf_quality_sketch": f"SELECT *, TRUE AS near FROM ({_profile('lineitem', _LINEITEM_TYPES)})",
    "prf_table_info": _info("sales_summary", _SUMMARY_TYPES),
    "prf_run_summary": _counts(
        {
            "orders": "m_orders",
            "customers": "m_customers",
            "products": "m_products",
            "order_items": "(SELECT DISTINCT * FROM m_items)",
            "payments": "m_payments",
            "reviews": "m_reviews",
            "sellers": "m_sellers",
        }
    ),
    "aud_counts": """
        SELECT 'drop_duplicate_rows' AS step, 'orders' AS "table",
               2 * COUNT(*) AS rows_in, COUNT(*) AS rows_out FROM m_orders
        UNION ALL
        SELECT 'drop_duplicate_keys', 'order_items', COUNT(*),
               COUNT(DISTINCT (order_id, order_item_id)) FROM m_items""",
    "etl_full": _SUMMARY,
    "mart_sales_bucketed": _SUMMARY,
    "etl_resumed": f"SELECT *, 'clean 7,extract 8,summarise 1' AS taken_over FROM ({_SUMMARY})",
    "etl_incremental": f"""SELECT *, (SELECT CAST(MIN(year(order_purchase_timestamp)) AS VARCHAR) FROM m_orders) AS replaced
        FROM ({_SUMMARY})""",
    "aud_run": _phases(),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_ctes(sql) for name, sql in {**_REPORTS, **_OPERATORS}.items()}


def report_over_tables(name: str) -> str:
    """The SQL of a report over cleaned tables called m_orders, m_items and so on."""
    derived = {"m_item_totals", "m_payment_totals", "m_sales_summary"}
    return _with_ctes(_REPORTS[name], frozenset(set(_CTES) - derived))
