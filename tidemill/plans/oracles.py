"""The queries as ANSI SQL over the test tables, for comparison on another engine."""

from __future__ import annotations

# -- building blocks ---------------------------------------------------------------------------

CUSTOMERS = """
customers AS (
    SELECT c_custkey AS customer_id,
           split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           CAST('2024-01-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS DATE) AS created_at
    FROM customer
)"""

ORDERS = """
stg AS (
    SELECT o_orderkey AS order_id,
           o_custkey AS customer_id,
           CAST(o_orderdate AS DATE) AS order_date,
           CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
           CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'cancelled' WHEN 'P' THEN 'pending' END AS status
    FROM orders
    WHERE {where}
)"""
ALL_ORDERS = ORDERS.format(where="TRUE")
URGENT_ORDERS = ORDERS.format(where="o_orderpriority = '1-URGENT'")

PRODUCTS = """
products AS (
    SELECT p_partkey AS product_id,
           p_name AS name,
           p_type AS category,
           CAST(p_retailprice AS DECIMAL(10,2)) AS price,
           CAST('2024-' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '-01' AS DATE) AS created_at
    FROM part
)"""

ITEMS = """
items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS amount
    FROM lineitem
)"""


def _mart(name: str = "mart", orders: str = "stg") -> str:
    return f"""
{name}_figures AS (
    SELECT c.customer_id, c.first_name, c.last_name, c.email,
           COUNT(o.order_id) AS total_orders,
           CAST(COALESCE(SUM(o.amount) FILTER (WHERE o.status = 'completed'), 0) AS DECIMAL(18,2)) AS total_revenue,
           MIN(o.order_date) AS first_order_date,
           MAX(o.order_date) AS last_order_date
    FROM customers c LEFT JOIN {orders} o ON c.customer_id = o.customer_id
    GROUP BY c.customer_id, c.first_name, c.last_name, c.email
),
{name} AS (
    SELECT *, CASE WHEN total_orders >= 3 THEN 'high' WHEN total_orders >= 2 THEN 'medium' ELSE 'low' END AS customer_tier
    FROM {name}_figures
)"""


MART = f"WITH {CUSTOMERS},{ALL_ORDERS},{_mart()}"
SPARSE = f"WITH {CUSTOMERS},{URGENT_ORDERS},{_mart()}"
STAGED = f"WITH {CUSTOMERS},{ALL_ORDERS}"

# Mean of cents, half-up, in whole numbers: a division would be a binary fraction here.
MEAN = (
    "CAST(CAST(sign({total}) * ((2 * abs(CAST({total} * 100 AS HUGEINT)) + {n}) // (2 * {n})) AS DECIMAL(18,2)) * 0.01 "
    "AS DECIMAL(18,2))"
)

TIER = """
SELECT customer_tier,
       COUNT(*) AS customer_count,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue,
       {mean} AS avg_revenue
FROM {source}
GROUP BY customer_tier"""
TIER_MEAN = MEAN.format(total="SUM(total_revenue)", n="COUNT(total_revenue)")


def _report(rows: list[tuple[str, str, str, str]]) -> str:
    """Rows of a test report: model, column, test, and the SQL that counts failures."""
    parts = [
        f"SELECT '{m}' AS model, '{c}' AS column_name, '{t}' AS test, CAST(({sql}) AS BIGINT) AS failures"
        for m, c, t, sql in rows
    ]
    union = "\nUNION ALL\n".join(parts)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n{union}\n) AS r"


def _twice(table: str, *columns: str) -> str:
    names = ", ".join(columns)
    present = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return (
        f"SELECT COUNT(*) FROM (SELECT {names} FROM {table} WHERE {present} GROUP BY {names} HAVING COUNT(*) > 1) AS d"
    )


def _nulls(table: str, column: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {column} IS NULL"


def _orphans(child: str, column: str, parent: str, field: str) -> str:
    return (
        f"SELECT COUNT(*) FROM {child} AS c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{field} = c.{column})"
    )


def _unaccepted(table: str, column: str, accepted: str) -> str:
    return f"SELECT COUNT(DISTINCT {column}) FROM {table} WHERE {column} NOT IN ({accepted})"


SOME_CUSTOMERS = "some_customers AS (SELECT c_custkey AS customer_id FROM customer WHERE c_mktsegment <> 'MACHINERY')"
EVENT_TYPES = "'view', 'signup', 'error', 'click', 'purchase'"
PART_TYPES = "'ECONOMY', 'MEDIUM', 'PROMO', 'LARGE', 'SMALL', 'STANDARD'"
EVENT_TYPES_BUT_ERROR = "'view', 'signup', 'click', 'purchase'"

STAGING_REPORT = [
    ("stg_customers", "customer_id", "unique", _twice("customers", "customer_id")),
    ("stg_customers", "customer_id", "not_null", _nulls("customers", "customer_id")),
    ("stg_orders", "order_id", "unique", _twice("stg", "order_id")),
    ("stg_orders", "order_id", "not_null", _nulls("stg", "order_id")),
    ("stg_orders", "customer_id", "not_null", _nulls("stg", "customer_id")),
    ("stg_orders", "customer_id", "relationships", _orphans("stg", "customer_id", "customers", "customer_id")),
]

ALTERED = """
altered AS (
    SELECT order_id, customer_id, order_date, amount,
           CASE WHEN status = 'pending' AND amount >= 400000 THEN 'completed' ELSE status END AS status
    FROM stg WHERE NOT (status = 'cancelled' AND amount < 5000)
    UNION ALL
    SELECT -order_id - 1, customer_id, order_date, amount, status FROM stg WHERE amount >= 495000
    UNION ALL
    SELECT order_id, customer_id, order_date, amount, status FROM stg WHERE status = 'completed' AND amount < 3000
)"""

COMPARED = """
sides AS (
    SELECT COALESCE(l.order_id, r.order_id) AS order_id, COALESCE(l.n, 0) AS nl, COALESCE(r.n, 0) AS nr
    FROM (SELECT order_id, COUNT(*) AS n FROM stg GROUP BY order_id) AS l
    FULL OUTER JOIN (SELECT order_id, COUNT(*) AS n FROM altered GROUP BY order_id) AS r ON l.order_id = r.order_id
),
changes AS (
    SELECT l.order_id,
           concat_ws(',',
               CASE WHEN l.customer_id IS DISTINCT FROM r.customer_id THEN 'customer_id' END,
               CASE WHEN l.order_date IS DISTINCT FROM r.order_date THEN 'order_date' END,
               CASE WHEN l.amount IS DISTINCT FROM r.amount THEN 'amount' END,
               CASE WHEN l.status IS DISTINCT FROM r.status THEN 'status' END) AS changed_columns
    FROM stg AS l JOIN altered AS r ON l.order_id = r.order_id
    JOIN sides AS s ON s.order_id = l.order_id AND s.nl = 1 AND s.nr = 1
),
compared AS (
    SELECT s.order_id,
           CASE WHEN nl > 1 OR nr > 1 THEN 'duplicate'
                WHEN nr = 0 THEN 'left_only'
                WHEN nl = 0 THEN 'right_only'
                WHEN c.changed_columns <> '' THEN 'changed'
                ELSE 'matched' END AS status,
           COALESCE(c.changed_columns, '') AS changed_columns
    FROM sides AS s LEFT JOIN changes AS c ON s.order_id = c.order_id
)"""

DAYS = """
days AS (
    SELECT *, CAST(ts AS DATE) AS day FROM events
),
weekly AS (
    SELECT *, CAST(date_diff('day', (SELECT MIN(day) FROM days), day) // 7 + 1 AS BIGINT) AS batch_id FROM days
)"""

DIRTY = """
dirty AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
           CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN '2024-13-01'
                ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS amount,
           o_orderstatus AS status,
           CASE o_orderstatus WHEN 'F' THEN 'orders_20240101.csv' WHEN 'O' THEN 'orders_20240102.csv'
                ELSE 'orders_20240103.csv' END AS file_name,
           concat_ws('; ',
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'bad date in order_date' END,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'bad decimal(10,2) in amount' END,
               CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN 'missing customer_id' END) AS reasons
    FROM orders
)"""

CLEAN = """
SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
       CAST(order_date AS DATE) AS order_date, CAST(amount AS DECIMAL(10,2)) AS amount, status
FROM dirty WHERE reasons = ''"""

# The mart by another way: figures first, then the join.
SECOND = """
second AS (
    SELECT c.customer_id, c.first_name, c.last_name, c.email,
           COALESCE(f.n, 0) AS total_orders, CAST(COALESCE(f.revenue, 0) AS DECIMAL(18,2)) AS total_revenue,
           f.first_order_date, f.last_order_date,
           CASE WHEN f.n >= 3 THEN 'high' WHEN f.n >= 2 THEN 'medium' ELSE 'low' END AS customer_tier
    FROM customers c LEFT JOIN (
        SELECT customer_id, COUNT(order_id) AS n, SUM(CASE WHEN status = 'completed' THEN amount END) AS revenue,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
        FROM stg GROUP BY customer_id
    ) AS f ON f.customer_id = c.customer_id
)"""

# A report on two frames, computed from both.
COMPARISON = """
SELECT '{left}' AS left_name, '{right}' AS right_name,
       COUNT(*) FILTER (WHERE l.customer_id IS NULL OR r.customer_id IS NULL OR {differs}) = 0 AS identical,
       COUNT(*) FILTER (WHERE l.customer_id = r.customer_id AND NOT ({differs})) AS matched,
       COUNT(*) FILTER (WHERE l.customer_id = r.customer_id AND ({differs})) AS changed,
       COUNT(*) FILTER (WHERE r.customer_id IS NULL) AS left_only, COUNT(*) FILTER (WHERE l.customer_id IS NULL) AS right_only,
       CAST(COUNT(*) - COUNT(DISTINCT COALESCE(l.customer_id, r.customer_id)) AS BIGINT) AS duplicate_keys,
       '' AS changed_columns, '' AS left_only_columns, '' AS right_only_columns, '' AS retyped_columns
FROM {a} AS l FULL OUTER JOIN {b} AS r ON l.customer_id = r.customer_id"""

MULTISET = """
SELECT {columns}, CASE WHEN net > 0 THEN '{left_side}' ELSE '{right_side}' END AS side, CAST(ABS(net) AS BIGINT) AS copies
FROM (
    SELECT {columns}, SUM(copies) AS net
    FROM (SELECT {columns}, 1 AS copies FROM {left} UNION ALL SELECT {columns}, -1 AS copies FROM {right}) AS u
    GROUP BY {columns}
) AS n
WHERE net <> 0"""

ORDER_COLUMNS = "order_id, customer_id, order_date, amount, status"
MART_COLUMNS = (
    "customer_id, first_name, last_name, email, total_orders, total_revenue, "
    "first_order_date, last_order_date, customer_tier"
)

DIFFERS = " OR ".join(f"l.{c.strip()} IS DISTINCT FROM r.{c.strip()}" for c in MART_COLUMNS.split(","))

PROFILE_COLUMNS = [
    ("order_id", "bigint"),
    ("customer_id", "bigint"),
    ("order_date", "date"),
    ("amount", "decimal(10,2)"),
    ("status", "string"),
]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Number of columns of each table.
COLUMN_COUNTS = {
    "region": 2,
    "nation": 3,
    "customer": 5,
    "supplier": 4,
    "part": 6,
    "orders": 6,
    "lineitem": 11,
    "events": 6,
    "documents": 5,
    "embeddings": 3,
    "pages": 3,
    "benchmark": 2,
    "labels": 3,
    "conversations": 4,
}

MART_REPORT = [
    ("customer_orders", "customer_id", "unique", _twice("mart", "customer_id")),
    ("customer_orders", "customer_id", "not_null", _nulls("mart", "customer_id")),
    ("customer_orders", "customer_id", "relationships", _orphans("mart", "customer_id", "customers", "customer_id")),
    ("customer_orders", "customer_tier", "accepted_values", _unaccepted("mart", "customer_tier", "'high', 'medium', 'low'")),
]

PRODUCT_REPORT = [
    ("stg_products", "product_id", "unique", _twice("products", "product_id")),
    ("stg_products", "product_id", "not_null", _nulls("products", "product_id")),
    ("stg_products", "price", "not_null", _nulls("products", "price")),
    ("stg_products", "category", "not_null", _nulls("products", "category")),
    ("stg_products", "category", "accepted_values", _unaccepted("products", "category", PART_TYPES)),
]

LINE_REPORT = [
    ("order_products", "order_id", "not_null", _nulls("items", "order_id")),
    ("order_products", "order_id", "relationships", _orphans("items", "order_id", "stg", "order_id")),
    (
        "order_products", "product_name", "not_null",
        "SELECT COUNT(*) FROM items AS i LEFT JOIN products AS p ON i.product_id = p.product_id WHERE p.name IS NULL",
    ),
]

# -- queries -----------------------------------------------------------------------------------

ORACLES: dict[str, str] = {
    "stg_customers": f"WITH {CUSTOMERS} SELECT * FROM customers",
    "stg_orders": f"WITH {ALL_ORDERS} SELECT * FROM stg",
    "stg_products": f"WITH {PRODUCTS} SELECT * FROM products",
    "customer_orders": f"{MART} SELECT * FROM mart",
    "customer_orders_sparse": f"{SPARSE} SELECT * FROM mart",
    "order_products": f"""
WITH {ALL_ORDERS},{ITEMS},{PRODUCTS}
SELECT i.order_id, i.line_number, o.customer_id, o.order_date, p.name AS product_name, p.category, i.amount, o.status
FROM items i LEFT JOIN stg o ON i.order_id = o.order_id LEFT JOIN products p ON i.product_id = p.product_id""",
    "scan_full": "SELECT * FROM orders",
    "pruned_scan": f"""{MART}
SELECT customer_id, first_name, last_name, total_orders, total_revenue, customer_tier FROM mart WHERE total_orders >= 2""",
    "mart_filter_orders": f"{MART} SELECT * FROM mart WHERE total_orders >= 2",
    "mart_filter_tier": f"{MART} SELECT * FROM mart WHERE customer_tier = 'high'",
    "mart_by_revenue": f"{MART} SELECT * FROM mart ORDER BY total_revenue DESC, customer_id",
    "filter_not_in": "SELECT * FROM events WHERE event_type NOT IN ('view', 'click')",
    "sorted_multi": f"{MART} SELECT * FROM mart ORDER BY customer_tier, first_order_date, customer_id",
    "templated_sql": f"""{MART}
SELECT customer_tier, COUNT(*) AS customer_count, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(total_revenue) AS DECIMAL(18,2)) AS total_revenue
FROM mart GROUP BY customer_tier""",
    "tier_summary": f"{MART} {TIER.format(source='mart', mean=TIER_MEAN)}",
    "tier_summary_nonnull": f"{MART} {TIER.format(source='(SELECT * FROM mart WHERE total_orders > 0) AS m', mean=TIER_MEAN)}",
    "tier_counts": f"{MART} SELECT customer_tier, COUNT(*) AS n FROM mart GROUP BY customer_tier",
    "full_name": f"WITH {CUSTOMERS} SELECT customer_id, first_name || ' ' || last_name AS full_name FROM customers",
    "order_list_per_customer": f"""
WITH {ALL_ORDERS}
SELECT customer_id, order_id // 1000 AS id_block, COUNT(*) AS orders_in_block,
       COALESCE(string_agg(CAST(order_id AS VARCHAR), ',' ORDER BY order_id) FILTER (WHERE status = 'completed'), '') AS completed_ids
FROM stg GROUP BY customer_id, order_id // 1000""",
    "revenue_rank": f"""{MART}
SELECT customer_id, first_name || ' ' || last_name AS full_name, total_orders, total_revenue,
       RANK() OVER (ORDER BY total_revenue DESC) AS revenue_rank
FROM mart""",
    "rank_within_tier": f"""{MART}
SELECT customer_tier, customer_id, total_revenue,
       ROW_NUMBER() OVER (PARTITION BY customer_tier ORDER BY total_revenue DESC, customer_id) AS row_number,
       RANK() OVER (PARTITION BY customer_tier ORDER BY total_revenue DESC) AS rank,
       DENSE_RANK() OVER (PARTITION BY customer_tier ORDER BY total_revenue DESC) AS dense_rank,
       CAST(SUM(total_revenue) OVER (PARTITION BY customer_tier ORDER BY total_revenue DESC, customer_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS running_revenue
FROM mart""",
    "running_revenue": f"""
WITH {ALL_ORDERS},
daily AS (
    SELECT order_date,
           CAST(COALESCE(SUM(amount) FILTER (WHERE status = 'completed'), 0) AS DECIMAL(18,2)) AS revenue
    FROM stg GROUP BY order_date
)
SELECT order_date, revenue,
       LAG(revenue) OVER (ORDER BY order_date) AS previous_revenue,
       CAST(SUM(revenue) OVER (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS week_revenue,
       CAST(SUM(revenue) OVER (ORDER BY order_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
           AS running_revenue
FROM daily""",
    "test_unique_pass": f"WITH {ALL_ORDERS} {_report([STAGING_REPORT[2]])}",
    "test_unique_fail": f"""
WITH {ITEMS} {_report([("order_items", "order_id, line_number", "unique", _twice("items", "order_id", "line_number"))])}""",
    "test_not_null_pass": f"WITH {ALL_ORDERS} {_report(STAGING_REPORT[3:5])}",
    "test_not_null_fail": SPARSE
    + _report(
        [
            ("customer_orders", "customer_id", "not_null", _nulls("mart", "customer_id")),
            ("customer_orders", "first_order_date", "not_null", _nulls("mart", "first_order_date")),
        ]
    ),
    "test_relationships_pass": f"{STAGED} {_report([STAGING_REPORT[5]])}",
    "test_relationships_fail": f"WITH {ALL_ORDERS}, {SOME_CUSTOMERS} "
    + _report([("stg_orders", "customer_id", "relationships", _orphans("stg", "customer_id", "some_customers", "customer_id"))]),
    "accepted_values_pass": _report(
        [("events", "event_type", "accepted_values", _unaccepted("events", "event_type", EVENT_TYPES))]
    ),
    "accepted_values_fail": f"""
SELECT event_type, COUNT(*) AS n_records FROM events WHERE event_type NOT IN ({EVENT_TYPES_BUT_ERROR}) GROUP BY event_type""",
    "test_report": f"{STAGED},{ITEMS} "
    + _report(
        [
            *STAGING_REPORT,
            ("order_items", "order_id, line_number", "unique", _twice("items", "order_id", "line_number")),
            ("order_items", "order_id", "relationships", _orphans("items", "order_id", "stg", "order_id")),
            ("events", "event_type", "not_null", _nulls("events", "event_type")),
            ("events", "event_type", "accepted_values", _unaccepted("events", "event_type", EVENT_TYPES_BUT_ERROR)),
        ]
    ),
    "failing_rows_relationships": f"""
WITH {ALL_ORDERS}, {SOME_CUSTOMERS}
SELECT * FROM stg WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM some_customers)""",
    "failing_rows_unique": f"""
WITH {ITEMS}
SELECT i.* FROM items i
JOIN (SELECT order_id, line_number FROM items GROUP BY order_id, line_number HAVING COUNT(*) > 1) AS d
  ON i.order_id = d.order_id AND i.line_number = d.line_number""",
    "compare_equal": f"{MART},{SECOND} " + COMPARISON.format(left="computed", right="stored", a="mart", b="second", differs=DIFFERS),
    "compare_diff": f"""
WITH {ALL_ORDERS},{ALTERED},{COMPARED}
SELECT 'orders' AS left_name, 'altered' AS right_name, FALSE AS identical,
       COUNT(*) FILTER (WHERE status = 'matched') AS matched,
       COUNT(*) FILTER (WHERE status = 'changed') AS changed,
       COUNT(*) FILTER (WHERE status = 'left_only') AS left_only,
       COUNT(*) FILTER (WHERE status = 'right_only') AS right_only,
       COUNT(*) FILTER (WHERE status = 'duplicate') AS duplicate_keys,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'changed') > 0 THEN 'status' ELSE '' END AS changed_columns,
       '' AS left_only_columns, 'note' AS right_only_columns, '' AS retyped_columns
FROM compared""",
    "compare_diff_rows": f"WITH {ALL_ORDERS},{ALTERED},{COMPARED} SELECT * FROM compared WHERE status <> 'matched'",
    "compare_pairs": f"{MART},{SECOND} "
    + " UNION ALL ".join(
        COMPARISON.format(left=left, right=right, a=a, b=b, differs=DIFFERS)
        for left, right, a, b in (("computed", "stored", "mart", "second"), ("computed", "sql", "mart", "second"), ("stored", "sql", "second", "mart"))
    ),
    "except_all_diff": f"WITH {ALL_ORDERS},{ALTERED} "
    + MULTISET.format(columns=ORDER_COLUMNS, left="stg", right="altered", left_side="left", right_side="right"),
    "csv_scan": f"WITH {PRODUCTS} SELECT * FROM products",
    "external_scan": f"WITH {PRODUCTS} SELECT * FROM products",
    "seed_load": f"""
WITH {PRODUCTS}
SELECT product_id, name, category, CAST(price AS DECIMAL(12,3)) AS price, created_at FROM products""",
    "feed_routing": """
WITH daily AS (
    SELECT event_type, strftime(CAST(ts AS DATE), '%Y%m%d') AS digits, COUNT(*) AS n FROM events GROUP BY 1, 2
),
files AS (
    SELECT event_type || '_' || digits || '.csv' AS file_name, n FROM daily
    UNION ALL SELECT 'daily_' || event_type || '_' || digits || '.csv', n FROM daily
    UNION ALL SELECT event_type || '_1.csv', n FROM daily
    UNION ALL SELECT event_type || '.csv', n FROM daily
)
SELECT file_name,
       regexp_replace(file_name, '(_[0-9]{8})?[.]csv$', '') AS feed,
       CAST(try_strptime(nullif(regexp_extract(file_name, '_([0-9]{8})[.]csv$', 1), ''), '%Y%m%d') AS DATE) AS feed_date,
       CAST(SUM(n) AS BIGINT) AS n
FROM files GROUP BY file_name""",
    "archive_name": """
SELECT event_type || '_' || strftime(day, '%Y%m%d') || '.csv' AS file_name, loaded_at,
       event_type || '_' || strftime(day, '%Y%m%d') || '_' || strftime(loaded_at, '%Y%m%d_%H%M%S') || '.csv' AS archived_as
FROM (SELECT event_type, CAST(ts AS DATE) AS day, MAX(ts) AS loaded_at FROM events GROUP BY 1, 2) AS f""",
    "quarantine": f"WITH {DIRTY} SELECT order_id, reasons FROM dirty",
    "landing_ingest": f"WITH {DIRTY} {CLEAN}",
    "landing_quarantine": f"""
WITH {DIRTY}
SELECT order_id, customer_id, order_date, amount, status, file_name, reasons FROM dirty WHERE reasons <> ''""",
    "landing_ledger": f"""
WITH {DIRTY}
SELECT 'orders' AS feed, file_name, 'loaded' AS status,
       COUNT(*) FILTER (WHERE reasons = '') AS rows, COUNT(*) FILTER (WHERE reasons <> '') AS quarantined
FROM dirty GROUP BY file_name""",
    "landing_stream": f"WITH {DIRTY} {CLEAN}",
    "landing_mixed": f"WITH {DIRTY} {CLEAN}",
    "stream_rebuild": f"WITH {CUSTOMERS},{DIRTY},first AS ({CLEAN} AND status = 'F'),{_mart('mart', 'first')} SELECT * FROM mart",
    "ingest_append": f"WITH {DAYS} SELECT event_id, ts, user_id, event_type, value, props, batch_id FROM weekly",
    "incremental_append": "SELECT * FROM events",
    "incremental_daily": f"""
SELECT day, event_type, n, total_value, min_value, max_value,
       {MEAN.format(total="total_value", n="nullif(n_values, 0)")} AS avg_value
FROM (
    SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n, COUNT(value) AS n_values,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_value,
           MIN(CAST(value AS DECIMAL(18,2))) AS min_value,
           MAX(CAST(value AS DECIMAL(18,2))) AS max_value
    FROM events GROUP BY 1, 2
) AS d""",
    "incremental_customer_orders": f"{MART} SELECT * FROM mart",
    "incremental_altered_orders": f"WITH {CUSTOMERS},{ALL_ORDERS},{ALTERED},{_mart('mart', 'altered')} SELECT * FROM mart",
    "read_as_of": f"""
WITH {DAYS} SELECT event_id, ts, user_id, event_type, value, props, batch_id FROM weekly WHERE batch_id <= 2""",
    "version_diff": f"WITH {CUSTOMERS},{ALL_ORDERS},{URGENT_ORDERS.replace('stg AS', 'urgent AS')},"
    f"{_mart('newer')},{_mart('older', 'urgent')} "
    + MULTISET.format(columns=MART_COLUMNS, left="older", right="newer", left_side="removed", right_side="added"),
    "version_diff_few": f"""
WITH {ALL_ORDERS},
newer AS (
    SELECT order_id, customer_id, order_date,
           CAST(CASE WHEN amount >= 499000 THEN amount + 1 ELSE amount END AS DECIMAL(10,2)) AS amount, status FROM stg
    UNION ALL SELECT order_id, customer_id, order_date, amount, status FROM stg WHERE amount < 1000
) """
    + MULTISET.format(columns=ORDER_COLUMNS, left="stg", right="newer", left_side="removed", right_side="added"),
    "published_mart": f"{MART} SELECT * FROM mart",
    "build_report": f"{MART},{ITEMS},{PRODUCTS} " + _report([*STAGING_REPORT, *PRODUCT_REPORT, *MART_REPORT, *LINE_REPORT]),
    "snapshots": f"""
WITH {DAYS}
SELECT batch_id AS snapshot_id, 'append' AS operation, COUNT(*) AS added_records FROM weekly GROUP BY batch_id""",
    "history": f"""
WITH {DAYS},
batches AS (SELECT batch_id, COUNT(*) AS n FROM weekly GROUP BY batch_id)
SELECT batch_id AS snapshot_id, 'append' AS operation, n AS added_records,
       CAST(SUM(n) OVER (ORDER BY batch_id) AS BIGINT) AS total_records
FROM batches""",
    "store_inventory": f"""
WITH {DAYS}
SELECT 'events' AS table_name, 'batch_id' AS kind, COUNT(DISTINCT batch_id) AS snapshot_count, MAX(batch_id) AS current_snapshot
FROM weekly
UNION ALL SELECT 'products', 'version', CAST(2 AS BIGINT), CAST(2 AS BIGINT)""",
    "store_formats": f"""
WITH {PRODUCTS} SELECT *, CAST(CASE WHEN price < 1200 THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM products""",
    "store_properties": "SELECT * FROM (VALUES ('format', 'parquet'), ('kind', 'version'), ('current_snapshot', '2')) AS v(key, value)",
    "data_files": f"""
WITH {DAYS} SELECT batch_id, COUNT(*) AS record_count, TRUE AS sized FROM weekly GROUP BY batch_id""",
    "arrow_profile": f"{MART} SELECT COUNT(*) AS rows, CAST(9 AS BIGINT) AS columns, TRUE AS measured FROM mart",
    "table_profile": f"WITH {ALL_ORDERS} "
    + "\nUNION ALL\n".join(
        f"""
SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, '{t}' AS data_type, COUNT(*) AS row_count,
       COUNT(*) - COUNT({c}) AS null_count, COUNT(DISTINCT {c}) AS distinct_count,
       CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value
FROM stg"""
        for i, (c, t) in enumerate(PROFILE_COLUMNS, start=1)
    ),
    "table_inventory": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST({COLUMN_COUNTS[t]} AS BIGINT) AS column_count FROM {t}"
        for t in TABLES
    ),
}
