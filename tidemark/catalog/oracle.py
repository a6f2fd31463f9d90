"""The registered queries as SQL over the same tables, to check results against.

Written apart from the Spark jobs: plain joins, distinct counts and row numbers
over the whole tables, whatever route the job takes to the same rows.
"""

from __future__ import annotations

from tidemark.catalog.queries import (
    INGEST_DAY,
    KEEP_FROM,
    LATE_OFFSET,
    LOAD_DAYS,
    MARK,
    PRICE_CUT,
)

# The shop's tables and change log; money in whole cents ---------------------------

_SHOP = """
shop_products AS (
    SELECT p_partkey, 'PROD-' || p_partkey AS product_id, p_name AS product_name, price,
           (price * 7 + 5) // 10 AS cost_price,
           TIMESTAMP '1995-01-01' + to_days(p_size) AS listed
    FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS price FROM part)
),
shop_orders AS (
    SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS order_id,
           CAST(o_custkey AS VARCHAR) AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending'
                              WHEN 'P' THEN 'Cancelled' END AS status,
           CAST(round(o_totalprice * 100) AS BIGINT) AS total_amount,
           o_orderdate AS created_at, o_orderdate + to_days(1) AS updated_at
    FROM orders
),
shop_items AS (
    SELECT l_orderkey,
           l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
               || strftime(l_shipdate, '%Y%m%d') AS order_item_id,
           CAST(l_orderkey AS VARCHAR) AS order_id, product_id,
           CAST(l_quantity AS BIGINT) AS quantity, price, cost_price,
           l_shipdate AS created_at, l_shipdate AS updated_at,
           l_shipdate + to_hours(l_linenumber) + to_milliseconds(l_orderkey % 4 * 250) AS kafka_ts
    FROM lineitem JOIN shop_products ON l_partkey = p_partkey
),
order_log AS (
    SELECT v AS version, CASE v WHEN 1 THEN 'c' WHEN 4 THEN 'd' ELSE 'u' END AS op, order_id,
           CASE WHEN v < 4 THEN customer_id END AS customer_id,
           CASE WHEN v = 1 THEN 'Pending' WHEN v < 4 THEN status END AS status,
           CASE WHEN v < 4 THEN total_amount END AS total_amount,
           CASE WHEN v < 4 THEN created_at END AS created_at,
           CASE WHEN v < 4 THEN created_at + to_days(v - 1) END AS updated_at,
           created_at + to_days(v - 1) AS event_ts,
           o_orderkey * 4 + v AS "offset"
    FROM shop_orders, (VALUES (1), (2), (3), (4)) AS versions(v)
    WHERE v <= 2 OR (v = 3 AND o_orderkey % 10 = 0) OR (v = 4 AND o_orderkey % 97 = 0)
),
item_log AS (
    SELECT v AS version, CASE v WHEN 1 THEN 'c' ELSE 'u' END AS op, order_item_id, order_id,
           product_id, quantity + v - 1 AS quantity, price, cost_price, created_at,
           created_at + to_days(v - 1) AS updated_at,
           kafka_ts + to_days(v - 1) AS event_ts, kafka_ts + to_days(v - 1) AS kafka_ts,
           l_orderkey * 4 + v AS "offset"
    FROM shop_items, (VALUES (1), (2)) AS versions(v)
    WHERE v = 1 OR l_orderkey % 13 = 0
),
product_log AS (
    SELECT v AS version, CASE v WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op, product_id,
           CASE WHEN v < 3 THEN product_name END AS product_name,
           CASE v WHEN 1 THEN price WHEN 2 THEN price + 1000 END AS price,
           CASE WHEN v < 3 THEN cost_price END AS cost_price,
           CASE WHEN v < 3 THEN listed END AS created_at,
           CASE WHEN v < 3 THEN listed + to_days(v - 1) END AS updated_at,
           listed + to_days(v - 1) AS event_ts, p_partkey * 4 + v AS "offset"
    FROM shop_products, (VALUES (1), (2), (3)) AS versions(v)
    WHERE v = 1 OR (v = 2 AND p_partkey % 5 = 0) OR (v = 3 AND p_partkey % 23 = 0)
),
live_orders AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_ts DESC, "offset" DESC) AS rn
        FROM order_log)
    WHERE rn = 1 AND op <> 'd'
),
live_items AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY event_ts DESC, "offset" DESC) AS rn
        FROM item_log)
    WHERE rn = 1 AND op <> 'd'
)
"""


def _sql(body: str, ctes: str = "") -> str:
    return f"WITH {_SHOP}{',' + ctes if ctes else ''}\n{body}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


def _money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def _columns(*, plain: str = "", money: str = "", stamps: str = "", alias: str = "") -> str:
    prefix = f"{alias}." if alias else ""
    parts = [f'{prefix}"{c}" AS "{c}"' for c in plain.split()]
    parts += [f"{_money(prefix + c)} AS {c}" for c in money.split()]
    parts += [f"{_ts(prefix + c)} AS {c}" for c in stamps.split()]
    return ", ".join(parts)


_ORDER_ROW = dict(plain="order_id customer_id status", money="total_amount", stamps="created_at updated_at")
_ITEM_ROW = dict(
    plain="order_item_id order_id product_id quantity", money="price cost_price",
    stamps="created_at updated_at",
)
_LOGGED_PRODUCT = dict(
    plain="product_id product_name", money="price cost_price", stamps="created_at updated_at",
)
_PRODUCT_ROW = """product_id, product_name, CAST(price AS DOUBLE) / 100 AS price,
    CAST(cost_price AS DOUBLE) / 100 AS cost_price, {listed} AS created_at, {listed} AS updated_at
""".format(listed=_ts("listed"))


# Metrics --------------------------------------------------------------------------

_MEASURES = """
    COUNT(DISTINCT i.order_id) AS total_orders,
    CAST(SUM(i.quantity) AS BIGINT) AS total_items_sold,
    CAST(SUM(i.price * i.quantity) AS DOUBLE) / 100 AS total_revenue,
    CAST(SUM(i.cost_price * i.quantity) AS DOUBLE) / 100 AS total_cost,
    CAST(SUM(i.price * i.quantity) - SUM(i.cost_price * i.quantity) AS DOUBLE) / 100 AS total_profit,
    CAST(CAST(SUM(i.price * i.quantity) AS BIGINT) // COUNT(DISTINCT i.order_id) AS DOUBLE) / 100
        AS average_order_value
"""
_LAST = f"{_ts('MAX(i.kafka_ts)')} AS last_processed_ts,"


def _per_period(unit: str, name: str) -> str:
    return f"""
SELECT strftime(date_trunc('{unit}', i.kafka_ts), '%Y-%m-%d') AS {name}, {_MEASURES}
FROM shop_items AS i JOIN shop_orders AS o ON i.order_id = o.order_id
WHERE o.status = 'Completed' GROUP BY 1"""


def _daily(items: str, orders: str, where: str = "", last: str = _LAST, join: str = "") -> str:
    return f"""
SELECT strftime(CAST(i.kafka_ts AS DATE), '%Y-%m-%d') AS sale_date, {last} {_MEASURES}
FROM {items} AS i JOIN {orders} AS o ON i.order_id = o.order_id {join}
WHERE o.status = 'Completed' {where}
GROUP BY CAST(i.kafka_ts AS DATE)"""


_BY_TS = f"""
SELECT {{key}} AS ts, {_MEASURES}
FROM {{items}} AS i JOIN {{orders}} AS o ON i.order_id = o.order_id
WHERE o.status = 'Completed'
GROUP BY i.kafka_ts"""

_SUMS = """COUNT(DISTINCT i.order_id) AS orders, CAST(SUM(i.quantity) AS BIGINT) AS items,
    CAST(SUM(i.price * i.quantity) AS BIGINT) AS revenue,
    CAST(SUM(i.cost_price * i.quantity) AS BIGINT) AS cost"""


def _latest(log: str, key: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY {key} ORDER BY event_ts DESC, "offset" DESC) AS rn FROM {log})
    WHERE rn = 1 AND op <> 'd')"""


# What the days are when the first part of the feed has been read, and in the end.
_CLOSING = f"""
first_orders AS (SELECT * FROM order_log WHERE event_ts < TIMESTAMP '{MARK}'),
first_items AS (
    SELECT * FROM item_log WHERE event_ts < TIMESTAMP '{MARK}' AND "offset" % 17 <> {LATE_OFFSET}),
marks AS (
    SELECT (SELECT least((SELECT max(event_ts) FROM first_orders), (SELECT max(event_ts) FROM first_items)))
               - INTERVAL 10 SECOND AS first_mark,
           (SELECT least((SELECT max(event_ts) FROM order_log), (SELECT max(event_ts) FROM item_log)))
               - INTERVAL 10 SECOND AS last_mark
),
days_then AS (
    SELECT CAST(i.kafka_ts AS DATE) AS day, {_SUMS}
    FROM {_latest('first_items', 'order_item_id')} AS i
    JOIN {_latest('first_orders', 'order_id')} AS o ON i.order_id = o.order_id
    WHERE o.status = 'Completed' GROUP BY 1
),
days_now AS (
    SELECT CAST(i.kafka_ts AS DATE) AS day, {_SUMS}
    FROM live_items AS i JOIN live_orders AS o ON i.order_id = o.order_id
    WHERE o.status = 'Completed' GROUP BY 1
),
sent AS (
    SELECT 'final' AS kind, days_then.* FROM days_then, marks WHERE day + INTERVAL 1 DAY <= first_mark
    UNION ALL
    SELECT 'final', days_now.* FROM days_now, marks
    WHERE day + INTERVAL 1 DAY > first_mark AND day + INTERVAL 1 DAY <= last_mark
    UNION ALL
    SELECT 'late', day, coalesce(n.orders, 0) - coalesce(t.orders, 0),
        coalesce(n.items, 0) - coalesce(t.items, 0), coalesce(n.revenue, 0) - coalesce(t.revenue, 0),
        coalesce(n.cost, 0) - coalesce(t.cost, 0)
    FROM days_then AS t FULL JOIN days_now AS n USING (day), marks
    WHERE day + INTERVAL 1 DAY <= first_mark
)"""

# Upserts --------------------------------------------------------------------------


_EMPTY_AMOUNTS = """CASE WHEN n.order_id IS NULL THEN k.total_amount
    WHEN CAST(n.order_id AS BIGINT) % 11 = 0 THEN 0 ELSE n.total_amount END"""


def _upserted_orders(
    customer: str, incoming: str, amount: str = "coalesce(n.total_amount, k.total_amount)"
) -> str:
    """Known orders keep customer and creation time; the last update sets the rest."""
    return f"""
SELECT coalesce(k.order_id, n.order_id) AS order_id,
       CASE WHEN k.order_id IS NOT NULL THEN k.customer_id ELSE {customer} END AS customer_id,
       coalesce(n.status, k.status) AS status,
       {_money(amount)} AS total_amount,
       {_ts('coalesce(k.created_at, n.created_at)')} AS created_at,
       {_ts('coalesce(n.updated_at, k.updated_at)')} AS updated_at
FROM (SELECT * FROM order_log WHERE op = 'c' AND created_at < TIMESTAMP '{MARK}') AS k
FULL JOIN (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS rn
        FROM order_log WHERE {incoming})
    WHERE rn = 1) AS n ON k.order_id = n.order_id"""


def _upserted_items(incoming: str) -> str:
    return f"""
SELECT coalesce(k.order_item_id, n.order_item_id) AS order_item_id,
       coalesce(k.order_id, n.order_id) AS order_id,
       coalesce(k.product_id, n.product_id) AS product_id,
       coalesce(n.quantity, k.quantity) AS quantity,
       {_money('coalesce(n.price, k.price)')} AS price,
       {_money('coalesce(n.cost_price, k.cost_price)')} AS cost_price,
       {_ts('coalesce(k.created_at, n.created_at)')} AS created_at,
       {_ts('coalesce(n.updated_at, k.updated_at)')} AS updated_at
FROM (SELECT * FROM item_log WHERE op = 'c' AND created_at < TIMESTAMP '{MARK}') AS k
FULL JOIN (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY updated_at DESC) AS rn
        FROM item_log WHERE {incoming})
    WHERE rn = 1) AS n ON k.order_item_id = n.order_item_id"""


_LOADED = "strftime(updated_at, '%Y-%m-%d') IN ({})".format(", ".join(f"'{d}'" for d in LOAD_DAYS))

_NULLS = " UNION ALL ".join(
    f"SELECT COUNT(*) AS n_rows, '{c}' AS column_name, "
    f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_nulls FROM order_log"
    for c in "order_id customer_id status total_amount created_at updated_at".split()
)

_LOAD_CHECKS = """
SELECT 'orders' AS "table", 'null customer_id' AS "check",
    COUNT(*) FILTER (WHERE customer_id IS NULL) AS n, false AS published FROM order_log
UNION ALL
SELECT 'orders', 'not allowed status', COUNT(*) FILTER (WHERE status IS NULL OR (
    CAST(order_id AS BIGINT) % 50 = 0)), false FROM order_log
UNION ALL
SELECT 'orders', 'repeated order_id', CAST(SUM(n) AS BIGINT), false FROM (
    SELECT COUNT(*) AS n FROM order_log GROUP BY order_id HAVING COUNT(*) > 1)
UNION ALL
SELECT 'items', 'rows', COUNT(*), true FROM shop_items
UNION ALL
SELECT 'items', 'null order_id', COUNT(*) FILTER (WHERE order_id IS NULL), true FROM shop_items
UNION ALL
SELECT 'items', 'null kafka_ts', COUNT(*) FILTER (WHERE kafka_ts IS NULL), true FROM shop_items
UNION ALL
SELECT 'items', 'repeated order_item_id', COUNT(*) - COUNT(DISTINCT order_item_id), true FROM shop_items
"""

_RECONCILED = ("customer_id", "status", "total_amount", "created_at", "updated_at")
_RECONCILE = (
    "SELECT * FROM (SELECT coalesce(a.order_id, b.order_id) AS order_id, "
    "CASE WHEN b.order_id IS NULL THEN 'only_left' WHEN a.order_id IS NULL THEN 'only_right' "
    "ELSE 'differs' END AS verdict, "
    "CASE WHEN a.order_id IS NULL OR b.order_id IS NULL THEN '' ELSE concat_ws(',', "
    + ", ".join(
        f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _RECONCILED
    )
    + ") END AS differing FROM shop_orders AS a "
    "FULL JOIN live_orders AS b ON a.order_id = b.order_id) "
    "WHERE verdict <> 'differs' OR differing <> ''"
)


def oracle_sql() -> dict[str, str]:
    month = "year({0}) * 100 + month({0})"
    return {
        "sales_daily": _sql(_daily("shop_items", "shop_orders")),
        "sales_by_ts": _sql(_BY_TS.format(key=_ts("i.kafka_ts"), items="shop_items", orders="shop_orders")),
        "sales_ts_to_day": _sql(_daily("shop_items", "shop_orders", last="")),
        "sales_daily_colocated": _sql(_daily("shop_items", "shop_orders")),
        "sales_weekly": _sql(_per_period("week", "sale_week")),
        "sales_monthly": _sql(_per_period("month", "sale_month_start")),
        "sales_stamps_to_day": _sql(_daily("shop_items", "shop_orders", last="")),
        "metrics_feed_to_day": _sql(
            _BY_TS.format(key=_day("i.kafka_ts"), items="shop_items", orders="shop_orders")
        ),
        "sales_daily_all_versions": _sql(_daily("item_log", "order_log")),
        "high_water_mark": _sql(
            f"SELECT {_ts('MAX(i.kafka_ts)')} AS last_processed_ts FROM shop_items AS i "
            "JOIN shop_orders AS o ON i.order_id = o.order_id WHERE o.status = 'Completed'"
        ),
        "sales_daily_incremental": _sql(
            _daily("shop_items", "shop_orders", f"AND i.kafka_ts > TIMESTAMP '{MARK}'")
        ),
        "daily_summary_merge": _sql(_daily("live_items", "live_orders")),
        "cdc_flatten_orders": _sql(
            f'SELECT op, "offset", {_ts("event_ts")} AS event_ts, {_columns(**_ORDER_ROW)} FROM order_log'
        ),
        "cdc_flatten_order_items": _sql(
            f'SELECT op, "offset", {_ts("event_ts")} AS event_ts, {_columns(**_ITEM_ROW)} FROM item_log'
        ),
        "cdc_flatten_products": _sql(
            f'SELECT op, "offset", {_ts("event_ts")} AS event_ts, {_columns(**_LOGGED_PRODUCT)} '
            "FROM product_log"
        ),
        "cdc_table_filter": _sql(
            "SELECT 'demo_db_master.demo.orders' AS topic, COUNT(*) AS n_records FROM order_log "
            "UNION ALL SELECT 'demo_db_master.demo.order_items', COUNT(*) FROM item_log"
        ),
        "cdc_latest_orders": _sql(
            f"SELECT {_columns(**_ORDER_ROW)}, {_ts('event_ts')} AS event_ts FROM live_orders"
        ),
        "cdc_latest_order_items": _sql(
            f"SELECT {_columns(**_ITEM_ROW)}, {_ts('event_ts')} AS event_ts FROM live_items"
        ),
        "cdc_latest_products": _sql(
            f"SELECT {_columns(**_LOGGED_PRODUCT)}, {_ts('event_ts')} AS event_ts FROM ("
            "SELECT *, row_number() OVER (PARTITION BY product_id "
            'ORDER BY event_ts DESC, "offset" DESC) AS rn FROM product_log) '
            "WHERE rn = 1 AND op <> 'd'"
        ),
        "ingest_day_filter": _sql(
            f"SELECT {_columns(**_ORDER_ROW)} FROM shop_orders "
            f"WHERE CAST(updated_at AS DATE) = DATE '{INGEST_DAY}'"
        ),
        "upsert_orders": _sql(
            _upserted_orders("'moved-' || n.customer_id", "op = 'u'", _EMPTY_AMOUNTS)
        ),
        "upsert_order_items": _sql(_upserted_items("true")),
        "insert_if_absent": _sql(
            f"SELECT {_PRODUCT_ROW} FROM shop_products WHERE price < {PRICE_CUT}00 UNION ALL "
            f"SELECT {_PRODUCT_ROW.replace('product_name,', 'upper(product_name) AS product_name,')} "
            f"FROM shop_products WHERE NOT EXISTS (SELECT 1 FROM shop_products AS known "
            f"WHERE known.price < {PRICE_CUT}00 AND known.product_id = shop_products.product_id)"
        ),
        "csv_ingest_orders": _sql(_upserted_orders("n.customer_id", f"op <> 'd' AND {_LOADED}")),
        "csv_ingest_order_items": _sql(_upserted_items(_LOADED)),
        "csv_products": _sql(f"SELECT {_PRODUCT_ROW} FROM shop_products"),
        "pk_duplicates": _sql(
            "SELECT order_item_id, COUNT(*) AS n_rows FROM item_log GROUP BY order_item_id "
            "HAVING COUNT(*) > 1"
        ),
        "output_key_check": _sql(
            f"SELECT {_day('ts')} AS ts, COUNT(*) AS n_rows FROM (SELECT DISTINCT i.kafka_ts AS ts "
            "FROM shop_items AS i JOIN shop_orders AS o ON i.order_id = o.order_id "
            "WHERE o.status = 'Completed') GROUP BY 1 HAVING COUNT(*) > 1"
        ),
        "not_null_counts": _sql(_NULLS),
        "fk_orphans": _sql(
            "SELECT i.order_item_id, i.order_id FROM shop_items AS i "
            "LEFT JOIN live_orders AS o ON i.order_id = o.order_id WHERE o.order_id IS NULL"
        ),
        "fk_cascade_delete": _sql(
            "SELECT order_item_id, order_id FROM shop_items "
            "WHERE order_id NOT IN (SELECT order_id FROM order_log WHERE op = 'd')"
        ),
        "fk_restrict_violations": _sql(
            "SELECT p.product_id, COUNT(*) AS n_references FROM shop_products AS p "
            "JOIN shop_items AS i ON i.product_id = p.product_id "
            f"WHERE p.price >= {PRICE_CUT}00 GROUP BY p.product_id"
        ),
        "status_enum_violations": _sql(
            "SELECT status, COUNT(*) AS n_rows FROM (SELECT CASE WHEN CAST(order_id AS BIGINT) % 50 = 0 "
            "THEN upper(status) ELSE status END AS status FROM order_log) WHERE status IS NULL "
            "OR status NOT IN ('Pending', 'Completed', 'Cancelled') GROUP BY status"
        ),
        "reconcile": _sql(_RECONCILE),
        "reconcile_digests": _sql(_RECONCILE),
        "store_products": _sql(f"SELECT {_PRODUCT_ROW}, true AS stamped FROM shop_products"),
        "store_orders": _sql(
            f"SELECT {_columns(**_ORDER_ROW)}, true AS stamped, "
            f"CAST({month.format('created_at')} AS INTEGER) AS created_month FROM shop_orders"
        ),
        "store_order_items": _sql(
            f"SELECT {_columns(**_ITEM_ROW)}, {_ts('kafka_ts')} AS kafka_ts, "
            f"CAST({month.format('created_at')} AS INTEGER) AS created_month FROM shop_items"
        ),
        "store_items_by_day_and_order": _sql(
            f"SELECT {_day('CAST(kafka_ts AS DATE)')} AS day, COUNT(*) AS n_items, "
            "CAST(SUM(quantity) AS BIGINT) AS quantity, MIN(order_id) AS first_order "
            "FROM shop_items GROUP BY CAST(kafka_ts AS DATE)"
        ),
        "load_checks": _sql(_LOAD_CHECKS),
        "sales_monthly_partitions": _sql(
            f"SELECT *, CAST(replace(sale_date[1:7], '-', '') AS INTEGER) AS sale_month FROM ("
            f"{_daily('shop_items', 'shop_orders')}) WHERE sale_date[1:4] = '1998'"
        ),
        "ttl_retention": _sql(
            f"SELECT CAST({month.format('kafka_ts')} AS INTEGER) AS sale_month, COUNT(*) AS n_items, "
            "CAST(SUM(quantity) AS BIGINT) AS quantity FROM shop_items "
            f"WHERE kafka_ts >= TIMESTAMP '{KEEP_FROM}' GROUP BY 1"
        ),
        "stream_sales_daily": _sql(_daily("live_items", "live_orders", last="")),
        "stream_sales_ts": _sql(
            _BY_TS.format(key=_ts("i.kafka_ts"), items="live_items", orders="live_orders")
        ),
        "stream_sales_append": _sql(_daily("live_items", "live_orders", last="")),
        "stream_closing_days": _sql(
            "SELECT kind, strftime(day, '%Y-%m-%d') AS sale_date, orders AS total_orders, "
            "items AS total_items_sold, CAST(revenue AS DOUBLE) / 100 AS total_revenue, "
            "CAST(cost AS DOUBLE) / 100 AS total_cost FROM sent "
            "WHERE orders <> 0 OR items <> 0 OR revenue <> 0 OR cost <> 0", _CLOSING
        ),
        "stream_metrics_days": _sql(_daily("live_items", "live_orders", last="")),
        "stream_cdc_flatten_items": _sql(f"SELECT {_columns(**_ITEM_ROW)} FROM item_log"),
        "stream_cdc_flatten_products": _sql(
            f"SELECT {_columns(**_LOGGED_PRODUCT)} FROM product_log WHERE op <> 'd'"
        ),
        "stream_set_aside": _sql(
            "SELECT order_id, CASE WHEN NOT bad THEN CAST(total_amount AS DOUBLE) / 100 END AS "
            "total_amount, CASE WHEN bad THEN 'aside' ELSE 'stored' END AS verdict FROM ("
            'SELECT *, "offset" % 29 = 0 OR ("offset" % 31 = 0 AND op <> \'d\') AS bad FROM order_log) '
            "WHERE bad OR op <> 'd'"
        ),
        "stream_cdc_flatten": _sql(f"SELECT {_columns(**_ORDER_ROW)} FROM order_log WHERE op <> 'd'"),
    }
