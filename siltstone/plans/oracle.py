"""ANSI SQL with the same answers as the registered queries, for an independent engine."""

from __future__ import annotations

_LINES = """
order_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS supplier_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
              ELSE o_custkey END AS customer_id,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice AS price, l_discount AS discount,
         CAST(l_extendedprice AS DECIMAL(12,2))
           * (CAST(0.06 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS profit
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_ALL_CUSTOMERS = """
all_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS country,
         c_mktsegment AS segment, c_acctbal AS balance
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

_CUSTOMERS = (
    _ALL_CUSTOMERS
    + """,
customers AS (
  SELECT customer_id, customer_name, country, segment FROM all_customers WHERE balance >= 0)"""
)

_ALL_PRODUCTS = """
all_products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS sub_category,
         p_name AS product_name, p_retailprice AS price_per_product, p_size AS size
  FROM part)"""

_PRODUCTS = (
    _ALL_PRODUCTS
    + """,
products AS (
  SELECT product_id, category, sub_category, product_name, price_per_product
  FROM all_products WHERE size <= 45)"""
)

_MODEL = f"WITH {_LINES},{_CUSTOMERS},{_PRODUCTS}"

_SILVER = (
    _MODEL
    + """,
silver AS (
  SELECT order_id, line_no, supplier_id, order_date, ship_date, customer_id, product_id, quantity,
         price, discount, ROUND(profit, 2) AS profit,
         customer_name, country, category, sub_category
  FROM order_lines JOIN customers USING (customer_id) JOIN products USING (product_id))"""
)

_LINE = (
    "order_id, line_no, supplier_id, order_date, ship_date, customer_id, product_id, quantity, "
    "price, discount, CAST(profit AS DOUBLE) AS profit"
)
_SILVER_LINE = f"{_LINE}, customer_name, country, category, sub_category"

_TOTAL = "CAST(ROUND(SUM(profit), 2) AS DOUBLE) AS total_profit"
_YEAR = "CAST(YEAR(order_date) AS INTEGER) AS year"

_GOLD = f"""{_SILVER}
SELECT {_YEAR}, category, sub_category, customer_name, {_TOTAL}
FROM silver GROUP BY ALL"""

_EVENTS = """
raw_events AS (
  SELECT event_id, ts, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,
         event_type, value, CAST(ts AS DATE) AS batch_day
  FROM events),
newest AS (SELECT MAX(batch_day) AS day FROM raw_events)"""


def _newest_per_user(rows: str) -> str:
    return f"""
  SELECT event_id, ts, user_id, event_type, value, batch_day FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                                 ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM ({rows}) AS r) AS ranked
  WHERE rn = 1"""


_TARGET = _newest_per_user("SELECT * FROM raw_events WHERE batch_day < (SELECT day FROM newest)")
_SOURCE = _newest_per_user("SELECT * FROM raw_events WHERE batch_day = (SELECT day FROM newest)")
_MERGE_INPUTS = f"WITH {_EVENTS}, target AS ({_TARGET}), source AS ({_SOURCE})"
_KEPT = """SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.user_id IS NOT DISTINCT FROM t.user_id)"""
_UPSERT = f"{_MERGE_INPUTS} {_KEPT} UNION ALL SELECT * FROM source"

_BOUGHT = _newest_per_user("SELECT * FROM raw_events WHERE event_type = 'purchase'")
_SEEN = _newest_per_user("SELECT * FROM raw_events WHERE event_type IN ('view', 'signup')")

_RULES = {
    "price_not_negative": "price < 0",
    "quantity_positive": "quantity <= 0",
    "no_loss": "profit < 0",
    "discount_within_margin": "discount > 0.08",
}
_LIMITS = {"no_loss": 1_000_000_000, "discount_within_margin": 10}


def _rule_rows(columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {columns.format(rule=rule, limit=_LIMITS.get(rule, 0))} FROM order_lines WHERE {broken}"
        for rule, broken in _RULES.items()
    )


def _null_rows(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS nulls FROM enriched WHERE {c} IS NULL" for c in columns
    )


_ENRICHED = (
    _MODEL
    + """,
enriched AS (
  SELECT l.*, c.customer_name, c.country, p.category, p.sub_category
  FROM order_lines l
  LEFT JOIN customers c ON l.customer_id = c.customer_id
  LEFT JOIN products p ON l.product_id = p.product_id)"""
)

_CLASSIFIED = (
    _MODEL
    + """,
classified AS (
  SELECT l.*,
         CASE WHEN NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = l.customer_id)
              THEN 'unknown customer_id'
              WHEN NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = l.product_id)
              THEN 'unknown product_id' END AS reject_reason
  FROM order_lines l)"""
)

_UNKNOWN_CUSTOMER = "NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = l.customer_id)"
_UNKNOWN_PRODUCT = "NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = l.product_id)"

_WRITTEN_DATES = """
written AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ''
              WHEN l_returnflag = 'N' THEN STRFTIME(l_shipdate, '%-m/%-d/%Y')
              ELSE STRFTIME(l_shipdate, '%-d/%-m/%Y') END AS written
  FROM lineitem),
parsed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, written,
         CAST(TRY_STRPTIME(written, '%d/%m/%Y') AS DATE) AS ship_date
  FROM written)"""

_AS_STORED = (
    "CAST(order_id AS VARCHAR) AS order_id, line_no AS row_id, CAST(product_id AS VARCHAR) AS product_id, "
    "CAST(supplier_id AS VARCHAR) AS ship_mode, quantity, price, order_date, ship_date"
)

_ORDERED = "CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS BIGINT) AS position"


def _with_position(totals: str, order: str) -> str:
    return f"{_SILVER} SELECT *, {_ORDERED.format(order=order)} FROM ({totals}) AS totals"


_PART_NAME = "p_type || ', \"' || p_name || '\"'"
_PART_PRICE = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)"
_RAW_PART = f"""CASE WHEN p_partkey % 10 = 7 THEN '' ELSE CAST(p_partkey AS VARCHAR) END
  || ',"' || p_type || ', ""' || p_name || '"\"",' || p_size
  || CASE p_partkey % 10 WHEN 3 THEN '' WHEN 0 THEN ',n/a' ELSE ',' || {_PART_PRICE} END
  || CASE WHEN p_partkey % 10 = 5 THEN ',more' ELSE '' END"""

_PRIORITY = """'{"' || o_orderpriority || '"}\\ ['"""
_RAW_ORDER = """'{"' || CASE WHEN o_orderkey % 11 = 6 THEN 'number' ELSE 'order_id' END || '":' || o_orderkey
  || ',"customer_id":' || CASE WHEN o_orderkey % 11 = 0 THEN '"none","was":' ELSE '' END || o_custkey
  || ',"status":"' || o_orderstatus || '","priority":"{\\"' || o_orderpriority || '\\"}\\\\ ["'
  || CASE WHEN o_orderkey % 11 = 4 THEN '' ELSE '}' END"""

ORACLE_SQL: dict[str, str] = {
    "running_gold": _GOLD,
    "quarantine_release": f"""{_CLASSIFIED}
SELECT {_AS_STORED}, CASE WHEN reject_reason IS NULL THEN customer_name END AS customer_name,
       CASE WHEN reject_reason IS NULL THEN category END AS category, reject_reason
FROM classified LEFT JOIN customers USING (customer_id) LEFT JOIN products USING (product_id)""",
    "ingest_run": f"""WITH {_LINES}
SELECT {_AS_STORED}, CAST(customer_id AS VARCHAR) AS customer_id, discount, CAST(profit AS DOUBLE) AS profit
FROM order_lines""",
    "csv_rejects": f"""
SELECT CASE WHEN good THEN p_partkey END AS part_id, CASE WHEN good THEN {_PART_NAME} END AS name,
       CASE WHEN good THEN p_size END AS size, CASE WHEN good THEN CAST({_PART_PRICE} AS DOUBLE) END AS price,
       CASE WHEN NOT good THEN {_RAW_PART} END AS raw,
       CASE p_partkey % 10 WHEN 0 THEN 'bad price' WHEN 3 THEN 'short line' WHEN 5 THEN 'long line'
         WHEN 7 THEN 'missing part_id' END AS reason
FROM (SELECT *, p_partkey % 10 NOT IN (0, 3, 5, 7) AS good FROM part) AS parts""",
    "json_rejects": f"""
SELECT CASE WHEN good THEN o_orderkey END AS order_id, CASE WHEN good THEN o_custkey END AS customer_id,
       CASE WHEN good THEN o_orderstatus END AS status, CASE WHEN good THEN {_PRIORITY} END AS priority,
       CASE WHEN NOT good THEN {_RAW_ORDER} END AS raw,
       CASE o_orderkey % 11 WHEN 0 THEN 'bad customer_id' WHEN 4 THEN 'no object'
         WHEN 6 THEN 'missing order_id' END AS reason
FROM (SELECT *, o_orderkey % 11 NOT IN (0, 4, 6) AS good FROM orders) AS sent""",
    "json_array_scan": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, {_PRIORITY} AS priority,
       CAST(NULL AS VARCHAR) AS raw, CAST(NULL AS VARCHAR) AS reason
FROM orders""",
    "ordered_profit_by_year": _with_position(f"SELECT {_YEAR}, {_TOTAL} FROM silver GROUP BY ALL", "year"),
    "ordered_profit_by_year_category": _with_position(
        f"SELECT {_YEAR}, category, {_TOTAL} FROM silver GROUP BY ALL", "year, category"
    ),
    "ordered_profit_by_customer": _with_position(
        f"SELECT customer_id, customer_name, {_TOTAL} FROM silver GROUP BY ALL", "total_profit DESC, customer_id"
    ),
    "ordered_profit_by_customer_year": _with_position(
        f"SELECT customer_id, customer_name, {_YEAR}, {_TOTAL} FROM silver GROUP BY ALL",
        "customer_id, customer_name, year, total_profit DESC",
    ),
    "gold_profit_summary": _GOLD,
    "incremental_gold": _GOLD,
    "view_gold_profit_summary": _GOLD,
    "retail_run": _GOLD,
    "enrich_left": f"""{_ENRICHED}
SELECT {_LINE.replace("CAST(profit", "CAST(ROUND(profit, 2)")}, customer_name, country, category, sub_category
FROM enriched""",
    "silver_order": f"{_SILVER} SELECT {_SILVER_LINE} FROM silver",
    "view_silver_order": f"{_SILVER} SELECT {_SILVER_LINE} FROM silver",
    "report_profit_by_year": f"{_SILVER} SELECT {_YEAR}, {_TOTAL} FROM silver GROUP BY ALL ORDER BY year",
    "report_profit_by_year_category": f"""{_SILVER}
SELECT {_YEAR}, category, {_TOTAL} FROM silver GROUP BY ALL ORDER BY year, category""",
    "report_profit_by_customer": f"""{_SILVER}
SELECT customer_id, customer_name, {_TOTAL} FROM silver GROUP BY ALL
ORDER BY total_profit DESC, customer_id""",
    "report_profit_by_customer_year": f"""{_SILVER}
SELECT customer_id, customer_name, {_YEAR}, {_TOTAL} FROM silver GROUP BY ALL
ORDER BY customer_id, customer_name, year, total_profit DESC""",
    "view_customer": f"WITH {_CUSTOMERS} SELECT * FROM customers",
    "view_product": f"WITH {_PRODUCTS} SELECT * FROM products",
    "latest_batch": f"""WITH {_EVENTS}
SELECT * FROM raw_events WHERE batch_day = (SELECT day FROM newest)""",
    "latest_per_key": f"WITH {_EVENTS} {_newest_per_user('SELECT * FROM raw_events')}",
    "dedupe_customer": f"""WITH {_ALL_CUSTOMERS},
copies AS (
  SELECT * FROM all_customers UNION ALL SELECT * REPLACE (LOWER(segment) AS segment) FROM all_customers)
SELECT customer_id, customer_name, country, segment, balance FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY customer_name DESC NULLS LAST,
    country DESC NULLS LAST, segment DESC NULLS LAST, balance DESC NULLS LAST) AS rn FROM copies) AS r
WHERE rn = 1""",
    "dedupe_product": f"""WITH {_ALL_PRODUCTS},
copies AS (
  SELECT * FROM all_products
  UNION ALL SELECT * REPLACE (price_per_product + 1 AS price_per_product) FROM all_products)
SELECT product_id, category, sub_category, product_name, price_per_product, size FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY category DESC NULLS LAST,
    sub_category DESC NULLS LAST, product_name DESC NULLS LAST,
    price_per_product DESC NULLS LAST, size DESC NULLS LAST) AS rn FROM copies) AS r
WHERE rn = 1""",
    "duplicate_keys": """SELECT l_orderkey AS order_id, l_linenumber AS line_no, COUNT(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "null_profile": _ENRICHED
    + _null_rows(["order_id", "customer_id", "customer_name", "country", "category"]),
    "rule_summary": f"WITH {_LINES} " + _rule_rows("'{rule}' AS rule, COUNT(*) AS violations"),
    "rule_violations": f"WITH {_LINES} "
    + _rule_rows("order_id, line_no, supplier_id, product_id, '{rule}' AS rule"),
    "quality_limits": f"WITH {_LINES} "
    + _rule_rows(
        "'{rule}' AS rule, COUNT(*) AS violations, CAST({limit} AS BIGINT) AS max_allowed, "
        "COUNT(*) <= {limit} AS passed"
    ),
    "orphans_customer": f"{_MODEL} SELECT {_LINE} FROM order_lines l WHERE {_UNKNOWN_CUSTOMER}",
    "orphans_product": f"{_MODEL} SELECT {_LINE} FROM order_lines l WHERE {_UNKNOWN_PRODUCT}",
    "orphan_count": f"""{_MODEL}
SELECT 'customer_id' AS check_name, COUNT(*) AS orphans FROM order_lines l WHERE {_UNKNOWN_CUSTOMER}
UNION ALL
SELECT 'product_id' AS check_name, COUNT(*) AS orphans FROM order_lines l WHERE {_UNKNOWN_PRODUCT}""",
    "known_orders": f"""{_MODEL}
SELECT {_LINE} FROM order_lines
WHERE customer_id IN (SELECT customer_id FROM customers)
  AND product_id IN (SELECT product_id FROM products)""",
    "quarantine": f"{_CLASSIFIED} SELECT {_LINE}, reject_reason FROM classified WHERE reject_reason IS NOT NULL",
    "stage_counts": f"""{_CLASSIFIED}
SELECT 'lines' AS stage, COUNT(*) AS "rows" FROM classified
UNION ALL SELECT 'accepted', COUNT(*) FROM classified WHERE reject_reason IS NULL
UNION ALL SELECT 'unknown customer_id', COUNT(*) FROM classified WHERE reject_reason = 'unknown customer_id'
UNION ALL SELECT 'unknown product_id', COUNT(*) FROM classified WHERE reject_reason = 'unknown product_id'""",
    "cleansed_customers": f"""WITH {_ALL_CUSTOMERS}
SELECT customer_id, customer_name, COALESCE(country, 'UNKNOWN') AS country,
       LOWER(TRIM(segment)) AS segment, GREATEST(balance, 0.0) AS balance
FROM all_customers""",
    "audit_stamp": """SELECT o_orderkey, o_orderdate, 'BATCH' AS load_type, 'first' AS batch_id
FROM orders""",
    "round_profit": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2))
    * (CAST(0.06 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))), 2) AS DOUBLE) AS profit
FROM lineitem""",
    "parse_dates": f"""WITH {_WRITTEN_DATES}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_date FROM parsed""",
    "date_failures": f"""WITH {_WRITTEN_DATES}
SELECT 'ship_date' AS column_name, COUNT(*) AS failures FROM parsed
WHERE written IS NOT NULL AND ship_date IS NULL""",
    "sanitize_headers": """SELECT l_orderkey AS order_id, l_linenumber AS line__no, l_partkey AS part_id,
  l_extendedprice AS prix__, l_discount AS discount_, l_returnflag AS return_flag FROM lineitem""",
    "upsert_update_insert": _UPSERT,
    "upsert_table_roundtrip": _UPSERT,
    "upsert_partitions_roundtrip": _UPSERT,
    "upsert_buckets_roundtrip": _UPSERT,
    "upsert_with_deletes": f"{_MERGE_INPUTS} {_KEPT} UNION ALL SELECT * FROM source WHERE event_type <> 'error'",
    "upsert_only_newer": f"""WITH {_EVENTS}, target AS ({_BOUGHT}), seen AS ({_SEEN}),
source AS (
  SELECT * FROM seen s WHERE NOT EXISTS (
    SELECT 1 FROM target t WHERE t.user_id IS NOT DISTINCT FROM s.user_id AND t.ts > s.ts))
{_KEPT} UNION ALL SELECT * FROM source""",
    "upsert_order_grain": f"""WITH {_LINES}
SELECT {_LINE} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY ship_date DESC, discount DESC,
    line_no DESC, product_id DESC, supplier_id DESC, quantity DESC, price DESC, order_date DESC) AS rn
  FROM order_lines) AS r
WHERE rn = 1""",
    "append_roundtrip": f"WITH {_EVENTS} SELECT * FROM raw_events",
    "overwrite_roundtrip": f"WITH {_EVENTS} SELECT * FROM raw_events WHERE event_type <> 'error'",
    "widened_roundtrip": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS l_extendedprice, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS l_shipdate,
  CASE WHEN YEAR(l_shipdate) <= 1999 THEN NULL ELSE l_tax END AS l_tax
FROM lineitem""",
    "parquet_roundtrip": "SELECT * FROM lineitem",
    "csv_roundtrip": f"WITH {_ALL_PRODUCTS} SELECT * FROM all_products",
    "json_roundtrip": f"WITH {_ALL_CUSTOMERS} SELECT * FROM all_customers",
    "xlsx_scan": "SELECT * FROM customer",
}
