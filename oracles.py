"""What each query must return, as SQL on the warehouse tables.

The SQL never sees a message: it derives the expected rows straight from the
tables, so a parsing mistake cannot cancel out.
"""

from __future__ import annotations

from cartstream.schemas import PRIMARY_KEYS, RELATIONAL_SCHEMAS, TOPICS

# The days that "today" stands for.
NEW_USERS_DAY = "2024-01-15"
REVENUE_DAY = "1998-10-03"


# The four landed tables as CTEs. A transaction is an order line; its number says
# how many products it lists.
TABLES = """
WITH users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name,
    lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    CASE WHEN c_custkey % 5 = 0 THEN n_name ELSE n_name || ', ' || r_name END AS location,
    TIMESTAMP '2024-01-01 10:00:00' + to_days(CAST(c_custkey % 30 AS INT)) AS registered_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
clickstream AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, 'SESS' || user_id || '_' || day(ts) AS session_id,
    CAST(date_trunc('second', ts) AS TIMESTAMP) AS "timestamp", '/' || event_type AS page,
    ['Android', 'iOS', 'Chrome', 'Safari'][event_id % 4 + 1] AS device,
    ['click', 'scroll', 'hover', 'navigate'][(event_id // 4) % 4 + 1] AS action
  FROM events
),
lines AS (
  SELECT *, 'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber AS transaction_id,
    CAST(l_linenumber % 4 AS INT) AS listed, 'PROD' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS product_id,
    CAST(l_quantity AS INT) AS ordered, p_retailprice AS unit_price, p_type AS product_category
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
),
with_products AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id,
    'SESS' || o_custkey || '_' || day(o_orderdate) AS session_id, transaction_id,
    CAST(o_orderdate AS TIMESTAMP) AS "timestamp", l_extendedprice AS transaction_amount,
    ['UPI', 'credit_card', 'paypal', 'debit_card'][o_orderkey % 4 + 1] AS payment_method,
    CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'successful' END AS payment_status,
    CAST(NULL AS VARCHAR) AS order_status,
    CASE WHEN listed > 0 THEN CAST(to_json(list_slice([
      {product_id: product_id, quantity: ordered, unit_price: unit_price, product_category: product_category},
      {product_id: product_id, quantity: ordered + 1, unit_price: unit_price, product_category: product_category},
      {product_id: product_id, quantity: ordered + 2, unit_price: unit_price, product_category: product_category}
    ], 1, listed)) AS VARCHAR) END AS products,
    CASE WHEN listed > 0 THEN round(list_sum(list_slice([
      ordered * unit_price, (ordered + 1) * unit_price, (ordered + 2) * unit_price
    ], 1, listed)), 2) END AS order_total
  FROM lines
),
transactions AS (SELECT * EXCLUDE (products, order_total) FROM with_products),
numbered_items AS (
  SELECT transaction_id, product_id, product_category, ordered + item_pos AS quantity, unit_price,
    (ordered + item_pos) * unit_price AS product_spend, CAST(o_orderdate AS TIMESTAMP) AS "timestamp",
    item_pos
  FROM (SELECT *, CAST(unnest(range(listed)) AS INT) AS item_pos FROM lines)
),
transaction_items AS (SELECT * EXCLUDE (item_pos) FROM numbered_items)
"""


# Registrations as `registration_messages` sends them: one per order.
REGISTRATIONS = """
WITH registrations AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS user_id FROM orders
),
stored AS (SELECT DISTINCT CAST(s_suppkey AS VARCHAR) AS user_id FROM supplier)
"""

# Messages as `damaged_messages` sends them.
DAMAGED = """
WITH damaged AS (
  SELECT o_orderkey % 8 AS kind, 'TXN' || o_orderkey AS id,
    '{"transaction_id":"TXN' || o_orderkey || '","payment_method":"UPI"' AS start FROM orders
),
routed AS (
  SELECT 'malformed' AS status, NULL AS transaction_id, CASE kind
      WHEN 0 THEN id WHEN 1 THEN 'null' WHEN 2 THEN '[' || start || '}]'
      WHEN 3 THEN start WHEN 4 THEN '' END AS message
  FROM damaged WHERE kind < 5
  UNION ALL
  SELECT 'malformed', id, start || ',"transaction_amount":"n/a"}' FROM damaged WHERE kind = 5
  UNION ALL
  SELECT 'ok', CASE WHEN kind <> 6 THEN id END, NULL FROM damaged WHERE kind >= 5
)
"""

PANEL_SQL = {
    "total_users": "SELECT count(*) AS total_users FROM kept_users",
    "new_users_today": f"""SELECT count(*) AS new_users_today FROM kept_users
      WHERE CAST(registered_at AS DATE) = DATE '{NEW_USERS_DAY}'""",
    "top_locations": """SELECT trim(split_part(location, ',', 2)) AS state, count(*) AS users_count
      FROM kept_users WHERE location LIKE '%,%' GROUP BY 1
      ORDER BY users_count DESC NULLS FIRST, state LIMIT 5""",
    "top_pages": """SELECT page, count(*) AS visits FROM clickstream GROUP BY page
      ORDER BY visits DESC NULLS FIRST, page LIMIT 5""",
    "revenue_today": f"""SELECT round(coalesce(sum(transaction_amount), 0) / 100000.0, 6)
        AS total_revenue_today_lakhs FROM kept_transactions
      WHERE CAST("timestamp" AS DATE) = DATE '{REVENUE_DAY}' AND payment_status = 'successful'""",
    "top_categories": """SELECT product_category, CAST(sum(quantity) AS BIGINT) AS total_sold
      FROM transaction_items GROUP BY 1
      ORDER BY total_sold DESC NULLS FIRST, product_category LIMIT 5""",
    "revenue_by_category": """SELECT product_category,
        round(sum(product_spend) / 100000.0, 6) AS revenue_in_lakhs
      FROM transaction_items GROUP BY 1 ORDER BY 2 DESC NULLS FIRST, 1""",
}

USERS_SQL = "SELECT * FROM users"
CLICKS_SQL = "SELECT * FROM clickstream"
TRANSACTIONS_SQL = "SELECT * FROM transactions"
WITH_PRODUCTS_SQL = "SELECT * EXCLUDE (order_total) FROM with_products"
ITEMS_SQL = "SELECT * FROM transaction_items"
NUMBERED_ITEMS_SQL = "SELECT * FROM numbered_items"
JOURNEY_FROM = """FROM clickstream c LEFT JOIN users u ON c.user_id = u.user_id
  LEFT JOIN with_products t ON c.session_id = t.session_id"""

ON_TABLES = {
    "parse_users": USERS_SQL,
    "parse_clickstream": CLICKS_SQL,
    "parse_transactions": WITH_PRODUCTS_SQL,
    "transaction_items": ITEMS_SQL,
    "products_json": "SELECT transaction_id, products FROM with_products",
    "order_total": "SELECT transaction_id, order_total FROM with_products",
    "publish_roundtrip": WITH_PRODUCTS_SQL,
    "journey": f"""SELECT c.user_id, c.session_id, c.page, t.transaction_amount, u.email
      {JOURNEY_FROM}""",
    "journey_count": f"SELECT count(*) AS total_records {JOURNEY_FROM}",
    "journey_wide": f"""SELECT c.*, u.name, u.email, u.location, u.registered_at,
        t.user_id AS txn_user_id, t.transaction_id, t."timestamp" AS txn_timestamp,
        t.transaction_amount, t.payment_method, t.payment_status, t.order_status, t.products
      {JOURNEY_FROM}""",
    **{f"panel_{name}": sql for name, sql in PANEL_SQL.items()},
    **{f"live_{name}": sql for name, sql in PANEL_SQL.items()},
    **{f"relational_{name}": sql for name, sql in PANEL_SQL.items()},
    **{f"stored_{name}": sql for name, sql in PANEL_SQL.items()},
    "stream_users": USERS_SQL,
    "stream_clickstream": CLICKS_SQL,
    "stream_transactions": WITH_PRODUCTS_SQL,
    "stream_items": NUMBERED_ITEMS_SQL,
    "stream_restart": NUMBERED_ITEMS_SQL,
    "compact_transactions": WITH_PRODUCTS_SQL,
    "compact_closed": WITH_PRODUCTS_SQL,
    "export_users": USERS_SQL,
    "export_clickstream": CLICKS_SQL,
    "export_transactions": """SELECT * EXCLUDE (order_total), CAST(NULL AS VARCHAR) AS product_category
      FROM with_products""",
    "export_items": ITEMS_SQL,
}

def one_per_key(sql: str, table: str) -> str:
    """What a keyed table holds: of each key the earliest row, then the smallest."""
    key = PRIMARY_KEYS[table]
    time = TOPICS[table].time_column
    order = ", ".join(f'"{name}" NULLS FIRST' for name in RELATIONAL_SCHEMAS[table].names)
    return f"""SELECT * FROM ({sql}) WHERE {key} IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY "{time}" NULLS LAST, {order}) = 1"""


def kept(users: str, transactions: str) -> str:
    """CTEs of the keyed tables that take in the rows of `users` and `transactions`."""
    rows = f"SELECT * EXCLUDE (order_total), CAST(NULL AS VARCHAR) AS product_category FROM {transactions}"
    return f"""
, kept_users AS ({one_per_key(f"SELECT * FROM {users}", "users")}),
kept_transactions AS ({one_per_key(rows, "transactions")})
"""


# Some messages come again as they were, some with another time and content.
REPEATED = """
, repeated_users AS (
  SELECT * FROM users
  UNION ALL SELECT * FROM users WHERE CAST(user_id AS INT) % 3 = 0
  UNION ALL SELECT user_id, name, email, 'Moved, Late', registered_at + INTERVAL 1 DAY
  FROM users WHERE CAST(user_id AS INT) % 7 = 0
  UNION ALL SELECT user_id, name, email, 'Moved, Early', registered_at - INTERVAL 2 DAY
  FROM users WHERE CAST(user_id AS INT) % 7 = 1
),
repeated_transactions AS (
  SELECT * FROM with_products
  UNION ALL SELECT * FROM with_products WHERE CAST(substr(transaction_id, 4, 12) AS BIGINT) % 3 = 0
  UNION ALL SELECT * REPLACE ('failed' AS payment_status, "timestamp" + INTERVAL 1 DAY AS "timestamp")
  FROM with_products WHERE CAST(substr(transaction_id, 4, 12) AS BIGINT) % 7 = 0
  UNION ALL SELECT * REPLACE ('failed' AS payment_status, "timestamp" - INTERVAL 2 DAY AS "timestamp")
  FROM with_products WHERE CAST(substr(transaction_id, 4, 12) AS BIGINT) % 7 = 1
)
"""

KEYED_PANELS = ("total_users", "new_users_today", "top_locations", "revenue_today")
KEYED_EXPORTS = {f"export_{table}": f"SELECT * FROM kept_{table}" for table in PRIMARY_KEYS}
ON_REPEATED = KEYED_EXPORTS | {
    f"{kind}_{name}": PANEL_SQL[name] for kind in ("panel", "live", "stored") for name in KEYED_PANELS
}
ON_TABLES |= KEYED_EXPORTS
ON_TABLES["export_replay"] = ITEMS_SQL

ON_REGISTRATIONS = {
    "pk_violations": """
SELECT user_id AS key, CASE WHEN user_id IS NULL THEN 'null key'
    WHEN user_id IN (SELECT user_id FROM stored) THEN 'key already stored'
    ELSE 'key repeated in batch' END AS reason,
  CASE WHEN user_id IS NULL OR user_id IN (SELECT user_id FROM stored) THEN count(*)
    ELSE count(*) - 1 END AS rows_rejected
FROM registrations GROUP BY user_id
HAVING count(*) > 1 OR user_id IS NULL OR user_id IN (SELECT user_id FROM stored)""",
    "pk_accepted": """
SELECT DISTINCT user_id FROM registrations
WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT user_id FROM stored)""",
}

ON_DAMAGED = {"quarantine": "SELECT * FROM routed"}


def oracle_sql() -> dict[str, str]:
    tables = TABLES + kept("users", "with_products")
    repeated = TABLES + REPEATED + kept("repeated_users", "repeated_transactions")
    return {
        **{name: tables + sql for name, sql in ON_TABLES.items()},
        **{f"keyed_{name}": repeated + sql for name, sql in ON_REPEATED.items()},
        **{name: REGISTRATIONS + sql for name, sql in ON_REGISTRATIONS.items()},
        **{name: DAMAGED + sql for name, sql in ON_DAMAGED.items()},
    }
