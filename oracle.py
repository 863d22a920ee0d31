"""Independent SQL for the registered queries, run by DuckDB over the same parquet tables."""

from __future__ import annotations


def as_decimal(value: str) -> str:
    """The shortest decimal text of a double, which is what Spark rounds."""
    return f"CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,16))"


def rounded(value: str, digits: int) -> str:
    """Half up on the decimal value, as Spark rounds a double."""
    return f"CAST(round({as_decimal(value)}, {digits}) AS DOUBLE)"


RAW = """
raw_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'
             WHEN o_orderpriority = '5-LOW' THEN 'canceled' ELSE 'processing' END AS order_status,
        o_orderdate AS order_purchase_ts,
        CAST(NULL AS TIMESTAMP) AS order_approved_ts,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(
            ((date_diff('day', CAST(o_orderdate AS DATE), CAST(last_ship AS DATE)) % 150) + 150) % 150
            - 10 AS INTEGER)) END AS order_delivered_ts,
        o_orderdate + to_days(20 + 10 * CAST(left(o_orderpriority, 1) AS INTEGER)) AS order_estimated_ts
    FROM orders LEFT JOIN (
        SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey
    ) ON o_orderkey = l_orderkey),
raw_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
        l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
        CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight_value
    FROM lineitem),
raw_payments AS (
    SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
        CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
             WHEN 'R' THEN 'voucher' END AS payment_type,
        l_linenumber AS payment_installments,
        CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS payment_value
    FROM lineitem),
raw_reviews AS (
    SELECT event_id AS review_id, user_id * 100 + event_id % 100 AS order_id,
        CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS review_score, ts AS created
    FROM events),
products_en AS (
    SELECT p_partkey AS product_id, p_type AS product_category_name,
        CASE WHEN p_type <> 'STANDARD' THEN lower(p_type) END AS product_category_name_english
    FROM part),
seller_states AS (
    SELECT s_suppkey AS seller_id, n_name AS seller_state
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
items_rich AS (
    SELECT i.*, product_category_name_english, seller_state
    FROM raw_items i LEFT JOIN products_en USING (product_id)
    LEFT JOIN seller_states USING (seller_id)),
items_agg AS (
    SELECT order_id, CAST(count(order_item_id) AS INTEGER) AS item_count,
        sum(price) AS total_items_value, sum(freight_value) AS total_freight,
        list_sort(coalesce(list(DISTINCT product_category_name_english)
            FILTER (WHERE product_category_name_english IS NOT NULL), [])) AS categories,
        list_sort(coalesce(list(DISTINCT seller_state)
            FILTER (WHERE seller_state IS NOT NULL), [])) AS seller_states
    FROM items_rich GROUP BY order_id),
payments_agg AS (
    SELECT order_id, first(payment_type ORDER BY payment_sequential, payment_type) AS payment_type,
        max(payment_installments) AS payment_installments, sum(payment_value) AS payment_value
    FROM raw_payments GROUP BY order_id),
payment_counts AS (
    SELECT order_id, payment_type, row_number() OVER (
        PARTITION BY order_id ORDER BY count(*) DESC, payment_type) AS rn
    FROM raw_payments GROUP BY order_id, payment_type),
payments_mode AS (
    SELECT p.order_id, c.payment_type, p.payment_installments, p.payment_value
    FROM payments_agg p JOIN payment_counts c ON p.order_id = c.order_id AND c.rn = 1),
reviews_latest AS (
    SELECT order_id, CAST(review_score AS DOUBLE) AS review_score FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY created DESC, review_id DESC) AS rn
        FROM raw_reviews) WHERE rn = 1),
enriched AS (
    SELECT o.*, 'batch_csv/orders' AS source, item_count, total_items_value, total_freight, categories,
        seller_states, payment_type, payment_installments, payment_value, review_score
    FROM raw_orders o LEFT JOIN items_agg USING (order_id) LEFT JOIN payments_agg USING (order_id)
    LEFT JOIN reviews_latest USING (order_id))"""

METRICS = """
    CAST(date_diff('day', CAST(order_purchase_ts AS DATE), CAST(order_delivered_ts AS DATE)) AS INTEGER)
        AS delivery_days_actual,
    CAST(date_diff('day', CAST(order_purchase_ts AS DATE), CAST(order_estimated_ts AS DATE)) AS INTEGER)
        AS delivery_days_estimated,
    CAST(date_diff('day', CAST(order_estimated_ts AS DATE), CAST(order_delivered_ts AS DATE)) AS INTEGER)
        AS delivery_delay_days,
    order_status = 'delivered' AS is_delivered,
    order_status = 'canceled' AS is_canceled,
    total_items_value + total_freight AS order_value_total,
    CASE WHEN total_items_value > 0
         THEN CAST(total_freight AS DOUBLE) / CAST(total_items_value AS DOUBLE) END AS freight_ratio"""

LATE = "coalesce(is_delivered AND delivery_delay_days > 0, false) AS is_late_delivery"

FLAGS = """concat_ws('|',
        CASE WHEN order_id IS NULL THEN 'NULL_ORDER_ID' END,
        CASE WHEN payment_value IS NULL OR payment_value <= 0 THEN 'INVALID_PAYMENT_VALUE' END,
        CASE WHEN item_count IS NULL OR item_count < 1 THEN 'INVALID_ITEM_COUNT' END,
        CASE WHEN delivery_days_actual < 0 THEN 'DELIVERY_BEFORE_PURCHASE' END,
        CASE WHEN review_score < 1 OR review_score > 5 THEN 'INVALID_REVIEW_SCORE' END,
        CASE WHEN delivery_days_actual > 120 THEN 'ANOMALOUS_DELIVERY_DAYS' END) AS dq_flags"""

SILVER = f"""{RAW},
metrics AS (SELECT *, {METRICS} FROM enriched),
flagged AS (SELECT *, {LATE}, {FLAGS} FROM metrics),
silver AS (SELECT *, dq_flags = '' AS dq_passed FROM flagged)"""

ORDERS = "CAST(count(order_id) AS BIGINT)"
DELIVERED = "CAST(sum(CAST(is_delivered AS INTEGER)) AS BIGINT)"
CANCELED = "CAST(sum(CAST(is_canceled AS INTEGER)) AS BIGINT)"
OTIF = rounded(
    "CAST(count(*) FILTER (WHERE is_delivered AND NOT is_late_delivery) AS DOUBLE)"
    " / nullif(CAST(count(*) FILTER (WHERE is_delivered) AS DOUBLE), 0) * 100",
    2,
)
REVENUE = rounded("sum(payment_value)", 2)
PAYMENT = rounded("CAST(sum(payment_value) AS DOUBLE) / nullif(count(payment_value), 0)", 2)
SCORE = rounded("avg(review_score)", 2)


def delivered_avg(column: str) -> str:
    return rounded(f"avg({column}) FILTER (WHERE is_delivered)", 1)


def gold(source: str = "silver") -> str:
    return f"""
kpi_global AS (
    SELECT {ORDERS} AS total_orders, {DELIVERED} AS total_delivered, {CANCELED} AS total_canceled,
        {OTIF} AS otif_rate_pct,
        {delivered_avg("delivery_days_actual")} AS avg_delivery_days_actual,
        {delivered_avg("delivery_days_estimated")} AS avg_delivery_days_estimated,
        {delivered_avg("delivery_delay_days")} AS avg_delay_days,
        {REVENUE} AS total_revenue_brl, {PAYMENT} AS avg_order_value_brl, {SCORE} AS avg_review_score,
        {rounded("avg(freight_ratio) * 100", 1)} AS avg_freight_ratio_pct
    FROM {source}),
kpi_monthly AS (
    SELECT strftime(order_purchase_ts, '%Y-%m') AS order_month, {ORDERS} AS orders,
        {DELIVERED} AS delivered, {CANCELED} AS canceled, {OTIF} AS otif_rate_pct,
        {delivered_avg("delivery_days_actual")} AS avg_delivery_days,
        {delivered_avg("delivery_delay_days")} AS avg_delay_days,
        {REVENUE} AS revenue_brl, {SCORE} AS avg_review_score,
        {rounded(f"CAST({CANCELED} AS DOUBLE) / {ORDERS} * 100", 2)} AS cancellation_rate_pct
    FROM {source} GROUP BY 1),
kpi_category AS (
    SELECT category, {ORDERS} AS orders, {REVENUE} AS revenue_brl, {PAYMENT} AS avg_order_value,
        {SCORE} AS avg_review_score, {OTIF} AS otif_rate_pct
    FROM (SELECT *, unnest(categories) AS category FROM {source}) GROUP BY category),
kpi_nps AS (
    SELECT CAST(review_score AS INTEGER) AS review_score_int, {ORDERS} AS orders,
        {PAYMENT} AS avg_payment_value, {rounded("avg(delivery_days_actual)", 1)} AS avg_delivery_days,
        {rounded("CAST(count(order_id) AS DOUBLE) / sum(count(*)) OVER () * 100", 2)} AS pct_of_total
    FROM {source} WHERE review_score IS NOT NULL GROUP BY 1),
kpi_seller_state AS (
    SELECT seller_state, {ORDERS} AS orders,
        {rounded("avg(delivery_days_actual)", 1)} AS avg_delivery_days,
        {rounded("avg(delivery_delay_days)", 1)} AS avg_delay_days,
        {rounded("CAST(count(*) FILTER (WHERE NOT is_late_delivery) AS DOUBLE) / count(order_id) * 100", 2)}
            AS otif_rate_pct,
        {REVENUE} AS revenue_brl, {SCORE} AS avg_review_score
    FROM (SELECT * EXCLUDE (seller_states), unnest(seller_states) AS seller_state
          FROM {source} WHERE is_delivered) GROUP BY seller_state)"""


GOLD = f"{SILVER},{gold()}"


def _over(ctes: str, select: str) -> str:
    return f"WITH {ctes}{select}" if select.startswith(",") else f"WITH {ctes}\n{select}"


TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

ENRICHED_COLUMNS = """order_id, customer_id, order_status, order_purchase_ts, order_approved_ts,
    order_delivered_ts, order_estimated_ts, source, item_count,
    CAST(total_items_value AS DOUBLE) AS total_items_value, CAST(total_freight AS DOUBLE) AS total_freight,
    array_to_string(categories, '|') AS categories,
    array_to_string(seller_states, '|') AS seller_states,
    payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value, review_score"""

EVENTS = f"""{RAW},
payload AS (
    SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
        order_status, {TS.format("order_purchase_ts")} AS order_purchase_ts,
        CAST(NULL AS VARCHAR) AS order_approved_ts,
        {TS.format("order_delivered_ts")} AS order_delivered_ts,
        {TS.format("order_estimated_ts")} AS order_estimated_ts,
        coalesce(item_count, 0) AS item_count, coalesce(categories, []) AS categories,
        coalesce(i.seller_states, []) AS seller_states,
        coalesce(total_items_value, 0) AS total_items_value, coalesce(total_freight, 0) AS total_freight,
        payment_type, coalesce(payment_installments, 1) AS payment_installments,
        coalesce(payment_value, 0) AS payment_value, review_score
    FROM raw_orders o LEFT JOIN items_agg i USING (order_id) LEFT JOIN payments_mode USING (order_id)
    LEFT JOIN reviews_latest USING (order_id))"""

EVENT_CONTENT = """coalesce(order_id, '') || '|' || coalesce(customer_id, '') || '|' ||
    coalesce(order_status, '') || '|' || coalesce(order_purchase_ts, '') || '|' ||
    coalesce(order_approved_ts, '') || '|' || coalesce(order_delivered_ts, '') || '|' ||
    coalesce(order_estimated_ts, '') || '|' || CAST(item_count AS VARCHAR) || '|' ||
    coalesce(array_to_string(categories, ','), '') || '|' ||
    coalesce(array_to_string(seller_states, ','), '') || '|' ||
    CAST(CAST(total_items_value AS DECIMAL(22,2)) AS VARCHAR) || '|' ||
    CAST(CAST(total_freight AS DECIMAL(27,4)) AS VARCHAR) || '|' ||
    coalesce(payment_type, '') || '|' || CAST(payment_installments AS VARCHAR) || '|' ||
    CAST(CAST(payment_value AS DECIMAL(28,4)) AS VARCHAR) || '|' ||
    coalesce(CAST(review_score AS VARCHAR), '')"""

EVENT_COLUMNS = """order_id, customer_id, order_status, order_purchase_ts, order_approved_ts,
    order_delivered_ts, order_estimated_ts, item_count,
    coalesce(array_to_string(categories, '|'), '') AS categories,
    coalesce(array_to_string(seller_states, '|'), '') AS seller_states,
    CAST(total_items_value AS DOUBLE) AS total_items_value, CAST(total_freight AS DOUBLE) AS total_freight,
    payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value, review_score,
    order_purchase_ts AS ingested_at, 'order_events_v1' AS source"""

STREAM_FINAL = f"""{EVENTS},
final_text AS (
    SELECT * REPLACE (
        CASE WHEN order_status = 'shipped' THEN 'delivered' ELSE order_status END AS order_status,
        CASE WHEN order_status = 'shipped' THEN order_estimated_ts ELSE order_delivered_ts END
            AS order_delivered_ts)
    FROM payload),
final_typed AS (
    SELECT * REPLACE (CAST(order_purchase_ts AS TIMESTAMP) AS order_purchase_ts,
        CAST(order_delivered_ts AS TIMESTAMP) AS order_delivered_ts,
        CAST(order_estimated_ts AS TIMESTAMP) AS order_estimated_ts) FROM final_text),
metrics AS (SELECT *, {METRICS} FROM final_typed),
flagged AS (SELECT *, {LATE}, {FLAGS} FROM metrics)"""


def compact_money(amount: str) -> str:
    def text(value: str, digits: int) -> str:
        number = f"round({as_decimal(value)}, {digits})"
        return f"'R$' || CAST(CAST({number} AS DECIMAL(38,{digits})) AS VARCHAR)"

    return f"""CASE WHEN {amount} >= 1e6 THEN {text(f"{amount} / 1e6", 1)} || 'M'
        WHEN {amount} >= 1e3 THEN {text(f"{amount} / 1e3", 0)} || 'K'
        ELSE {text(amount, 0)} END"""


UPDATES = """
updates AS (
    SELECT o_orderkey AS order_id, 'delivered' AS order_status,
        o_orderdate AS order_purchase_timestamp, o_orderpriority AS priority
    FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT -o_orderkey - 1, 'created', o_orderdate + to_days(1), o_orderpriority
    FROM orders WHERE o_orderpriority = '1-URGENT')"""

# Orders after two batches of changes: moved and delivered, then canceled or removed.
CHANGED_SILVER = SILVER.replace("raw_orders AS (", "first_orders AS (", 1).replace(
    ",\nraw_items AS (",
    """,
raw_orders AS (
    SELECT * REPLACE (
        CASE WHEN order_id % 13 = 0 THEN 'canceled' WHEN order_id % 7 = 0 THEN 'delivered' ELSE order_status END
            AS order_status,
        CASE WHEN order_id % 13 <> 0 AND order_id % 7 = 0 THEN order_purchase_ts + to_days(40) ELSE order_purchase_ts END
            AS order_purchase_ts)
    FROM first_orders WHERE order_id % 11 <> 0 AND strftime(order_purchase_ts, '%Y-%m') <>
        (SELECT strftime(min(order_purchase_ts), '%Y-%m') FROM first_orders)),
raw_items AS (""",
    1,
)

# Exported tables: what names a row, and its figures.
SERVED = {
    "kpi_global": (
        "'all'",
        "total_orders total_delivered total_canceled otif_rate_pct avg_delivery_days_actual "
        "avg_delivery_days_estimated avg_delay_days total_revenue_brl avg_order_value_brl avg_review_score "
        "avg_freight_ratio_pct",
    ),
    "kpi_monthly": (
        "order_month",
        "orders delivered canceled otif_rate_pct avg_delivery_days avg_delay_days revenue_brl avg_review_score "
        "cancellation_rate_pct",
    ),
    "kpi_nps": (
        "CAST(review_score_int AS VARCHAR)",
        "orders avg_payment_value avg_delivery_days pct_of_total",
    ),
    "kpi_category": ("category", "orders revenue_brl avg_order_value avg_review_score otif_rate_pct"),
    "kpi_seller_state": (
        "seller_state",
        "orders avg_delivery_days avg_delay_days otif_rate_pct revenue_brl avg_review_score",
    ),
}

ORACLE = {
    # sources and sinks
    "bronze_stamp": _over(
        RAW, "SELECT order_id, order_status, 'batch_csv/orders' AS _source FROM raw_orders"
    ),
    "row_counts": """
        SELECT 'orders' AS table_name, count(*) AS rows FROM orders
        UNION ALL SELECT 'order_items', count(*) FROM lineitem
        UNION ALL SELECT 'order_payments', count(*) FROM lineitem
        UNION ALL SELECT 'order_reviews', count(*) FROM events
        UNION ALL SELECT 'customers', count(*) FROM customer
        UNION ALL SELECT 'sellers', count(*) FROM supplier
        UNION ALL SELECT 'products', count(*) FROM part
        UNION ALL SELECT 'category_translation', count(DISTINCT p_type) FROM part
            WHERE p_type <> 'STANDARD'""",
    "ingest_report": """
        SELECT 'orders' AS table_name, count(*) AS rows, CAST(0 AS BIGINT) AS rejected,
            CAST(NULL AS VARCHAR) AS error FROM orders
        UNION ALL SELECT 'order_payments', count(*), 0, NULL FROM lineitem
        UNION ALL SELECT 'order_reviews', count(*), 0, NULL FROM events
        UNION ALL SELECT 'products', count(*), 0, NULL FROM part""",
    "ingest_rejects": _over(
        RAW,
        """SELECT '' AS reason, count(*) AS n_rows, CAST(sum(payment_value) AS DOUBLE) AS revenue FROM raw_payments
        WHERE order_id % 97 <> 3 AND order_id % 89 <> 5 AND order_id % 83 <> 7
        UNION ALL SELECT CASE WHEN order_id % 83 = 7 THEN 'number of cells' ELSE 'payment_value' END, count(*),
            CAST(NULL AS DOUBLE) FROM raw_payments
        WHERE order_id % 97 = 3 OR order_id % 89 = 5 OR order_id % 83 = 7 GROUP BY 1""",
    ),
    "csv_payments": _over(
        RAW,
        """SELECT CAST(order_id AS VARCHAR) AS order_id, payment_sequential, payment_type,
            payment_installments, CAST(payment_value AS DOUBLE) AS payment_value,
            'batch_csv/order_payments' AS _source FROM raw_payments""",
    ),
    "csv_reviews": _over(
        RAW,
        """SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(order_id AS VARCHAR) AS order_id,
            CASE WHEN review_id % 101 <> 7 THEN review_score END AS review_score,
            CASE WHEN review_id % 101 = 7 THEN NULL
                 WHEN review_id % 3 = 0 THEN 'first "line",' || chr(10) || 'second' || chr(10) || chr(10) || review_id
                 WHEN review_id % 3 = 1 THEN 'said "hi", left' END AS review_comment_message,
            CASE WHEN review_id % 101 = 7 THEN 'number of cells' ELSE '' END AS reason
        FROM raw_reviews""",
    ),
    "serving_export": _over(
        GOLD,
        " UNION ALL ".join(
            f"""SELECT '{table}' AS table_name, {item} AS item, unnest({[c for c in columns.split()]}) AS measure,
                unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in columns.split())}]) AS amount FROM {table}"""
            for table, (item, columns) in SERVED.items()
        ),
    ),
    "layer_report": _over(
        GOLD,
        """SELECT 'gold' AS layer, 'kpi_global' AS table_name, count(*) AS rows FROM kpi_global
        UNION ALL SELECT 'gold', 'kpi_monthly', count(*) FROM kpi_monthly
        UNION ALL SELECT 'gold', 'kpi_category', count(*) FROM kpi_category
        UNION ALL SELECT 'gold', 'kpi_nps', count(*) FROM kpi_nps
        UNION ALL SELECT 'gold', 'kpi_seller_state', count(*) FROM kpi_seller_state""",
    ),
    "upsert_orders": _over(
        f"{RAW},{UPDATES}",
        """SELECT u.order_id, o.customer_id, u.order_status, u.order_purchase_timestamp, u.priority
        FROM updates u LEFT JOIN raw_orders o ON u.order_id = o.order_id
        UNION ALL
        SELECT order_id, customer_id, order_status, order_purchase_ts, NULL FROM raw_orders
        WHERE order_id NOT IN (SELECT order_id FROM updates)""",
    ),
    "table_history": _over(
        UPDATES.lstrip(),
        """SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, count(*) AS rows FROM orders
        UNION ALL SELECT 1, 'merge', (SELECT count(*) FROM orders) +
            (SELECT count(*) FROM updates WHERE order_id NOT IN (SELECT o_orderkey FROM orders))""",
    ),
    "order_events": _over(
        EVENTS,
        f"SELECT order_id || '_' || sha256({EVENT_CONTENT}) AS event_id, {EVENT_COLUMNS} FROM payload",
    ),
    # streaming
    "stream_ingest": _over(
        EVENTS,
        f"""SELECT order_id || '_' || sha256({EVENT_CONTENT}) AS event_id, {EVENT_COLUMNS},
            'orders' AS kafka_topic, CAST(CAST(order_id AS BIGINT) % 3 AS INTEGER) AS kafka_partition,
            CAST(order_id AS BIGINT) AS kafka_offset,
            CAST(order_purchase_ts AS TIMESTAMP) AS kafka_timestamp
        FROM payload""",
    ),
    "stream_dedup": _over(
        EVENTS,
        f"""SELECT order_id || '_' || sha256({EVENT_CONTENT}) AS event_id, {EVENT_COLUMNS},
            'orders' AS kafka_topic, CAST(CAST(order_id AS BIGINT) % 3 AS INTEGER) AS kafka_partition,
            CAST(order_id AS BIGINT) AS kafka_offset,
            TIMESTAMP '2026-01-01' + to_seconds(CAST(order_id AS BIGINT) % 3600) AS kafka_timestamp
        FROM payload""",
    ),
    "stream_schema_merge": _over(
        EVENTS,
        f"""SELECT order_id || '_' || sha256({EVENT_CONTENT}) AS event_id, order_id,
            CAST(item_count + CASE WHEN CAST(order_id AS BIGINT) % 10 = 0 THEN 3000000000 ELSE 0 END AS BIGINT)
                AS item_count,
            CASE WHEN CAST(order_id AS BIGINT) % 6 = 0 THEN 'web' WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'shop' END
                AS channel,
            CASE WHEN CAST(order_id AS BIGINT) % 4 = 0 THEN 'C' || order_id END AS coupon_code,
            CASE WHEN CAST(order_id AS BIGINT) % 4 = 0 THEN CAST(CAST(order_id AS BIGINT) % 100 AS DOUBLE) END AS coupon_pct
        FROM payload""",
    ),
    "stream_progress": """
        SELECT o_orderkey % 3 AS batch_id, count(*) AS rows_in,
            count(*) FILTER (WHERE o_orderkey % 17 = 0) AS unreadable,
            count(*) FILTER (WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 = 0) AS without_id,
            count(*) FILTER (WHERE o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0) AS stored
        FROM orders GROUP BY 1""",
    "stream_upsert": _over(
        STREAM_FINAL,
        """SELECT order_id, order_status, order_purchase_ts, order_delivered_ts, item_count,
            CAST(payment_value AS DOUBLE) AS payment_value, delivery_delay_days, is_late_delivery,
            dq_flags
        FROM flagged""",
    ),
    "stream_batch_mixed": _over(
        RAW,
        """SELECT CAST(order_id AS VARCHAR) AS order_id, CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN 'delivered'
            WHEN CAST(order_id AS BIGINT) % 5 = 0 THEN 'canceled'
            WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 'shipped' ELSE order_status END AS order_status
        FROM raw_orders""",
    ),
    # rows and joins
    "orders_renamed": _over(
        RAW,
        """SELECT order_id, customer_id, order_status, order_purchase_ts, order_approved_ts,
            order_delivered_ts, order_estimated_ts, 'batch_csv/orders' AS source FROM raw_orders""",
    ),
    "orders_preview": _over(
        SILVER,
        """SELECT order_id, order_status, order_purchase_ts, item_count,
            CAST(payment_value AS DOUBLE) AS payment_value, review_score
        FROM silver ORDER BY order_id LIMIT 10""",
    ),
    "dedup_latest": """
        SELECT user_id, day, event_id, event_type, value FROM (
            SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_id, event_type, value,
                row_number() OVER (PARTITION BY user_id
                    ORDER BY date_trunc('day', ts) DESC, event_id DESC) AS rn
            FROM events) WHERE rn = 1""",
    "products_translated": _over(
        RAW,
        "SELECT product_id, product_category_name, product_category_name_english FROM products_en",
    ),
    "items_enriched": _over(
        RAW,
        """SELECT order_id, order_item_id, product_id, seller_id, CAST(price AS DOUBLE) AS price,
            CAST(freight_value AS DOUBLE) AS freight_value, product_category_name_english, seller_state
        FROM items_rich""",
    ),
    **dict.fromkeys(("items_agg", "items_agg_shuffled"), _over(
        RAW,
        """SELECT order_id, item_count, CAST(total_items_value AS DOUBLE) AS total_items_value,
            CAST(total_freight AS DOUBLE) AS total_freight,
            array_to_string(categories, '|') AS categories,
            array_to_string(seller_states, '|') AS seller_states FROM items_agg""",
    )),
    "payments_agg": _over(
        RAW,
        """SELECT order_id, payment_type, payment_installments,
            CAST(payment_value AS DOUBLE) AS payment_value FROM payments_agg""",
    ),
    "payment_mode": _over(
        RAW,
        """SELECT order_id, payment_type, payment_installments,
            CAST(payment_value AS DOUBLE) AS payment_value FROM payments_mode""",
    ),
    "reviews_latest": _over(RAW, "SELECT order_id, review_score FROM reviews_latest"),
    "orders_enriched": _over(RAW, f"SELECT {ENRICHED_COLUMNS} FROM enriched"),
    "orders_enriched_bucketed": _over(RAW, f"SELECT {ENRICHED_COLUMNS} FROM enriched"),
    "silver_metrics": _over(
        SILVER,
        """SELECT order_id, delivery_days_actual, delivery_days_estimated, delivery_delay_days,
            is_delivered, is_canceled, is_late_delivery,
            CAST(order_value_total AS DOUBLE) AS order_value_total, freight_ratio FROM silver""",
    ),
    # quality
    "dq_flags": _over(SILVER, "SELECT order_id, dq_flags, dq_passed FROM silver"),
    "dq_flags_basic": _over(
        SILVER,
        """SELECT order_id, flags AS dq_flags, flags = '' AS dq_passed FROM (
            SELECT order_id, concat_ws('|',
                CASE WHEN order_id IS NULL THEN 'NULL_ORDER_ID' END,
                CASE WHEN payment_value <= 0 THEN 'ZERO_PAYMENT' END,
                CASE WHEN item_count IS NULL OR item_count < 1 THEN 'INVALID_ITEM_COUNT' END,
                CASE WHEN order_delivered_ts < order_purchase_ts THEN 'DELIVERY_BEFORE_PURCHASE' END,
                CASE WHEN review_score > 5 THEN 'INVALID_REVIEW_SCORE' END) AS flags
            FROM silver)""",
    ),
    "dq_rule_counts": _over(
        SILVER,
        """SELECT rule, count(*) AS orders FROM (
            SELECT unnest(string_split(dq_flags, '|')) AS rule FROM silver WHERE dq_flags <> '')
        GROUP BY rule""",
    ),
    "dq_summary": _over(
        SILVER,
        f"""SELECT count(*) AS total, count(*) FILTER (WHERE dq_passed) AS passed,
            count(*) FILTER (WHERE NOT dq_passed) AS failed,
            {rounded("CAST(count(*) FILTER (WHERE dq_passed) AS DOUBLE) / count(*) * 100", 1)} AS passed_pct,
            {rounded("CAST(count(*) FILTER (WHERE NOT dq_passed) AS DOUBLE) / count(*) * 100", 1)} AS failed_pct
        FROM silver""",
    ),
    "dq_before_dedup": _over(
        SILVER,
        """, rows_in AS (
            SELECT CASE WHEN CAST(order_id AS BIGINT) % 17 <> 0 THEN order_id END AS order_id,
                dq_passed AND CAST(order_id AS BIGINT) % 17 <> 0 AS dq_passed,
                unnest(range(CASE WHEN CAST(order_id AS BIGINT) % 10 = 0 THEN 2 ELSE 1 END)) AS copy
            FROM silver)
        SELECT count(*) AS rows_before, count(*) FILTER (WHERE dq_passed) AS passed,
            count(*) FILTER (WHERE NOT dq_passed) AS failed,
            count(DISTINCT order_id) + max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END) AS rows_after,
            count(*) FILTER (WHERE order_id IS NULL) AS without_key
        FROM rows_in""",
    ),
    "dq_flag_distribution": _over(
        SILVER,
        "SELECT dq_flags, count(*) AS orders FROM silver WHERE NOT dq_passed GROUP BY dq_flags",
    ),
    "status_distribution": _over(
        RAW, "SELECT order_status, count(*) AS orders FROM raw_orders GROUP BY order_status"
    ),
    # KPIs
    **{
        name: _over(GOLD, f"SELECT * FROM {name}")
        for name in ("kpi_global", "kpi_monthly", "kpi_category", "kpi_nps", "kpi_seller_state")
    },
    **{
        f"{table}_incremental": _over(f"{CHANGED_SILVER},{gold()}", f"SELECT * FROM {table}")
        for table in ("kpi_monthly", "kpi_category", "kpi_seller_state")
    },
    "kpi_monthly_passed": _over(
        f"{SILVER},passed AS (SELECT * FROM silver WHERE dq_passed),{gold('passed')}",
        "SELECT * FROM kpi_monthly",
    ),
    "silver_preview": _over(
        SILVER,
        f"""SELECT {rounded("avg(delivery_days_actual)", 1)} AS avg_delivery_days,
            {rounded("avg(delivery_days_estimated)", 1)} AS avg_estimated_days,
            {rounded("avg(delivery_delay_days)", 1)} AS avg_delay_days,
            {rounded("avg(CAST(is_late_delivery AS INTEGER)) * 100", 1)} AS pct_late,
            {PAYMENT} AS avg_payment_value, {SCORE} AS avg_review_score
        FROM silver WHERE is_delivered""",
    ),
    # reports over the KPI tables
    "monthly_active": _over(
        GOLD,
        "SELECT * FROM kpi_monthly WHERE orders > 100 AND order_month LIKE '1997%'",
    ),
    "year_kpis": _over(
        GOLD,
        """SELECT left(order_month, 4) AS year, CAST(sum(orders) AS BIGINT) AS orders,
            round(sum(revenue_brl), 2) AS revenue_brl,
            round(coalesce(sum(coalesce(otif_rate_pct, 0) * orders) / nullif(sum(orders), 0), 0), 6)
                AS otif_rate_pct,
            round(coalesce(sum(coalesce(avg_review_score, 0) * orders) / nullif(sum(orders), 0), 0), 6)
                AS avg_review_score
        FROM kpi_monthly WHERE orders > 100 GROUP BY 1""",
    ),
    "category_card": _over(
        GOLD,
        """SELECT category, category AS label, orders, revenue_brl, otif_rate_pct, avg_review_score
        FROM kpi_category WHERE category = 'promo'""",
    ),
    "top_categories": _over(
        GOLD,
        "SELECT category, revenue_brl FROM kpi_category ORDER BY revenue_brl DESC, category LIMIT 10",
    ),
    "state_coverage": _over(
        GOLD,
        """SELECT n_name AS seller_state, orders, avg_delivery_days, avg_delay_days, otif_rate_pct,
            revenue_brl, avg_review_score
        FROM nation LEFT JOIN kpi_seller_state ON n_name = seller_state""",
    ),
    **{
        name: _over(
            GOLD,
            f"""SELECT n_name AS seller_state, {column} AS value,
                CASE WHEN {column} IS NOT NULL THEN CAST(least(4, floor(
                    ({column} - min({column}) OVER ()) / coalesce(nullif(
                        max({column}) OVER () - min({column}) OVER (), 0), 1.0) * 5)) AS INTEGER) END
                AS bin
            FROM nation LEFT JOIN kpi_seller_state ON n_name = seller_state""",
        )
        for name, column in (
            ("state_metric_bins", "otif_rate_pct"),
            ("state_metric_bins_delivery", "avg_delivery_days"),
            ("state_metric_bins_score", "avg_review_score"),
        )
    },
    "state_metric_range": _over(
        GOLD,
        """SELECT min(otif_rate_pct) AS min_value, max(otif_rate_pct) AS max_value
        FROM kpi_seller_state""",
    ),
    "month_labels": _over(
        GOLD,
        """SELECT order_month, ['Ene','Feb','Mar','Abr','May','Jun','Jul','Ago','Sep','Oct','Nov','Dic']
            [CAST(right(order_month, 2) AS INTEGER)] || '-' || substr(order_month, 3, 2) AS label, orders
        FROM kpi_monthly""",
    ),
    "revenue_labels": _over(
        GOLD,
        f"""SELECT order_month, {compact_money("revenue_brl")} AS revenue_label
        FROM kpi_monthly""",
    ),
    "order_value_labels": _over(
        SILVER,
        f"""SELECT order_id, {compact_money("CAST(payment_value AS DOUBLE)")} AS revenue_label
        FROM silver""",
    ),
    "category_labels": _over(
        GOLD, "SELECT category, category AS label FROM kpi_category"
    ),
    # questions
    "ask_top_category": _over(
        GOLD, "SELECT category, revenue_brl FROM kpi_category ORDER BY 2 DESC, 1 LIMIT 1"
    ),
    "ask_otif_by_year": _over(
        GOLD,
        f"""SELECT CAST(left(order_month, 4) AS INTEGER) AS year,
            {rounded("avg(otif_rate_pct)", 2)} AS avg_otif_pct
        FROM kpi_monthly GROUP BY 1 ORDER BY 1 LIMIT 20""",
    ),
    "ask_best_state": _over(
        GOLD,
        "SELECT seller_state, avg_review_score FROM kpi_seller_state ORDER BY 2 DESC, 1 LIMIT 1",
    ),
    "ask_top_months": _over(
        GOLD, "SELECT order_month, orders FROM kpi_monthly ORDER BY 2 DESC, 1 LIMIT 5"
    ),
    "ask_worst_month": _over(
        GOLD, "SELECT order_month, canceled FROM kpi_monthly ORDER BY 2 DESC, 1 LIMIT 1"
    ),
    "ask_late_orders": _over(
        GOLD,
        """SELECT CAST(round(total_delivered * (1 - otif_rate_pct / 100)) AS BIGINT) AS late_orders
        FROM kpi_global""",
    ),
}
