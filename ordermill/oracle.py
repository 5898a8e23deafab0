"""Independent SQL (DuckDB dialect) for every registered query.

The driver registers the Parquet tables as views and runs these strings
next to the Spark plans. They restate the reference's SQL and pandas
semantics directly, sharing no code with the Spark side. Money is
DECIMAL until the output cast to DOUBLE; integer sums are cast to BIGINT
(DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

# --- shared CTE bodies: the pipeline's tables over the driver's ---------

ORDERS_ALL = """
orders_all AS (
  SELECT l.l_orderkey AS order_id,
         o.o_orderdate AS order_date,
         l.l_partkey AS product_id,
         CAST(l.l_quantity AS INTEGER) AS qty,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS unit_price,
         o.o_custkey AS user_id,
         CASE l.l_returnflag WHEN 'N' THEN 'completed'
                             WHEN 'R' THEN 'returned'
                             WHEN 'A' THEN 'cancelled' END AS order_status
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price
  FROM part
)"""

INVENTORY = """
inventory AS (
  SELECT p.p_partkey AS product_id, p.p_brand AS warehouse_id, p.p_size AS stock_on_hand,
         ls.last_restock_date
  FROM part p
  LEFT JOIN (SELECT l_partkey, MAX(CAST(l_shipdate AS DATE)) AS last_restock_date
             FROM lineitem GROUP BY l_partkey) ls
    ON p.p_partkey = ls.l_partkey
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


# --- reports ------------------------------------------------------------

# Net amount of each (day, product category); a cancelled line adds nothing.
DAY_CATEGORY = """
day_category AS (
  SELECT date_trunc('day', order_date)::DATE AS day, category,
         COALESCE(SUM(qty * unit_price) FILTER (WHERE order_status IS DISTINCT FROM 'cancelled'), 0) AS net
  FROM orders_all LEFT JOIN products USING (product_id)
  GROUP BY ALL
)"""

# The best category of each day beside the day's sum.
BEST_OF_DAY = """
best_of_day AS (
  SELECT day, category, net, SUM(net) OVER (PARTITION BY day) AS day_net
  FROM day_category
  QUALIFY ROW_NUMBER() OVER (PARTITION BY day ORDER BY net DESC, category NULLS FIRST) = 1
)"""

P4_DAILY_REVENUE = _with(ORDERS_ALL, PRODUCTS, DAY_CATEGORY, BEST_OF_DAY) + """
SELECT strftime(day, '%Y-%m-%d') AS date, ROUND(day_net, 2)::DOUBLE AS total_revenue,
       category AS top_category, ROUND(net, 2)::DOUBLE AS top_category_revenue
FROM best_of_day ORDER BY day
"""

N1_TOP_CATEGORY = _with(ORDERS_ALL, PRODUCTS, DAY_CATEGORY, BEST_OF_DAY) + """
SELECT strftime(day, '%Y-%m-%d') AS date, category AS top_category, ROUND(net, 2)::DOUBLE AS top_category_revenue
FROM best_of_day
"""


def _status_columns() -> str:
    """Units and amount of completed and returned lines, by FILTER."""
    return ",\n         ".join(
        f"COALESCE(SUM({value}) FILTER (WHERE order_status = '{status}'), 0) AS {name}_{status}"
        for name, value in (("units", "qty"), ("amount", "qty * unit_price")) for status in ("completed", "returned"))


def _rate(part: str, whole: str) -> str:
    """Percent with two decimals, half up in integers; 0 of nothing."""
    return (f"CASE {whole} WHEN 0 THEN 0.0::DOUBLE "
            f"ELSE ((20000 * {part} + {whole}) // (2 * {whole}))::DOUBLE / 100 END")


P5_PRODUCT_PERFORMANCE = _with(ORDERS_ALL, PRODUCTS, """
sold AS (
  SELECT p.product_id, p.product_name, p.category,
         """ + _status_columns() + """
  FROM orders_all o LEFT JOIN products p USING (product_id)
  GROUP BY ALL
)""") + """
SELECT product_id, product_name, category, (units_completed + units_returned)::BIGINT AS total_units_transacted,
       units_completed::BIGINT AS units_sold, units_returned::BIGINT AS units_returned,
       ROUND(amount_completed, 2)::DOUBLE AS revenue_completed, ROUND(amount_returned, 2)::DOUBLE AS revenue_returned,
       """ + _rate("units_returned", "(units_completed + units_returned)") + """ AS return_rate_percent
FROM sold ORDER BY amount_completed DESC, product_id NULLS FIRST
"""

A5_STATUS_SUMS = _with(ORDERS_ALL) + """
SELECT product_id, units_completed::BIGINT AS units_completed, units_returned::BIGINT AS units_returned,
       amount_completed::DOUBLE AS revenue_completed, amount_returned::DOUBLE AS revenue_returned
FROM (SELECT product_id, """ + _status_columns() + """ FROM orders_all GROUP BY ALL)
"""

P6_INVENTORY_ALERTS = _with(PRODUCTS, INVENTORY) + """
SELECT i.product_id, p.product_name, i.warehouse_id, i.stock_on_hand, i.last_restock_date
FROM inventory i LEFT JOIN products p ON i.product_id = p.product_id
WHERE i.stock_on_hand < 50
ORDER BY i.stock_on_hand ASC, i.product_id, i.warehouse_id
"""



# --- raw (all-string) tables with dirty cells ------------------------------

STATUS_SQL = """CASE l.l_returnflag WHEN 'N' THEN 'completed' WHEN 'R' THEN 'returned'
                              WHEN 'A' THEN 'cancelled' END"""

# The raw orders' other date forms, by key.
RAW_DATE_SQL = ("%Y/%m/%d", "%m/%d/%Y", "%Y/%m/%d %H:%M:%S", "%m/%d/%Y %H:%M", "%B %d, %Y", "%b %d, %Y", "%d-%b-%Y", "%Y.%m.%d",
                "%d %B %Y", "%m-%d-%Y", "%Y-%m-%d %I:%M %p", "%Y%m%d", "%Y-%m-%dT%H:%M:%S+02:00")

RAW_ORDERS = """
raw_orders AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CASE o.o_orderkey % 50 WHEN 0 THEN 'garbage' WHEN 1 THEN NULL
              """ + " ".join(f"WHEN {i} THEN strftime(o.o_orderdate, '{f}')" for i, f in enumerate(RAW_DATE_SQL, start=2)) + """
              ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS order_date,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         CASE o.o_orderkey % 40 WHEN 0 THEN '-1' WHEN 1 THEN 'abc' WHEN 2 THEN '2.5' WHEN 3 THEN '2.0' WHEN 4 THEN '5d'
              WHEN 5 THEN '3000000000' WHEN 6 THEN NULL WHEN 7 THEN '2.7' WHEN 8 THEN '1e2'
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS qty,
         CASE o.o_orderkey % 70
              WHEN 5 THEN '-' || CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)
              WHEN 6 THEN 'free' WHEN 7 THEN NULL
              ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
         CASE WHEN o.o_orderkey % 60 = 7 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o.o_orderkey % 60 = 8 THEN NULL ELSE """ + STATUS_SQL + """ END AS order_status,
         strftime(o.o_orderdate, '%Y-%m-%d') AS file_day
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

RAW_PRODUCTS = """
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CASE WHEN p_partkey % 25 = 3 THEN NULL ELSE p_type END AS category,
         CASE WHEN p_partkey % 10 = 0 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
              ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price
  FROM part
)"""

RAW_INVENTORY = INVENTORY + """,
raw_inventory AS (
  SELECT CAST(product_id AS VARCHAR) AS product_id, warehouse_id,
         CASE WHEN product_id % 30 = 0 THEN '-5' ELSE CAST(stock_on_hand AS VARCHAR) END AS stock_on_hand,
         CASE WHEN product_id % 45 = 1 THEN 'not a date'
              ELSE strftime(last_restock_date, '%Y-%m-%d') END AS last_restock_date
  FROM inventory
)"""


# The fallback date formats, in order, after the ISO forms.
FALLBACK_SQL = ("%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y", "%d %b %Y", "%Y%m%d", "%m-%d-%Y", "%d-%m-%Y", "%Y.%m.%d", "%d.%m.%Y",
                "%d %B %Y", "%d-%b-%Y", "%b %d, %Y", "%B %d, %Y", "%Y/%m/%d %H:%M:%S", "%Y/%m/%d %H:%M", "%m/%d/%Y %H:%M:%S",
                "%m/%d/%Y %H:%M", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%Y-%m-%d %I:%M %p", "%m/%d/%Y %I:%M %p")


def parse_sql(c: str) -> str:
    """Strict yyyy-M-d, then the fixed fallback list on the trimmed text,
    first hit wins; an ISO timestamp with an offset is read as UTC."""
    t = f"trim({c})"
    others = ", ".join(f"try_strptime({t}, '{f}')" for f in FALLBACK_SQL)
    return f"""COALESCE(
      try_strptime({c}, '%Y-%m-%d'),
      try_strptime({t}, '%Y-%m-%d'),
      CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}[ T][0-9:.]+\\s*([zZ]|[+-]\\d{{2}}:?\\d{{2}})$')
           THEN timezone('UTC', TRY_CAST({t} AS TIMESTAMPTZ))
           WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}[ T][0-9:.]+$') THEN TRY_CAST({t} AS TIMESTAMP) END,
      {others})"""


INT_RE = "'^\\s*[+-]?\\d+(\\.0*)?\\s*$'"
INT_PART_RE = "'^\\s*([+-]?\\d+)'"


def int_sql(c: str, typ: str = "BIGINT") -> str:
    return f"CASE WHEN regexp_matches({c}, {INT_RE}) THEN TRY_CAST(regexp_extract({c}, {INT_PART_RE}, 1) AS {typ}) END"


def num_ok_sql(c: str) -> str:
    d = f"TRY_CAST({c} AS DOUBLE)"
    return (f"({d} IS NOT NULL AND NOT isnan({d}) AND NOT isinf({d}) "
            f"AND TRY_CAST({c} AS DECIMAL(28,6)) IS NOT NULL)")


def msg_int(c: str, required: bool = True, ge: bool = False, typ: str = "BIGINT") -> str:
    head = f"WHEN {c} IS NULL THEN '{c}: field required'" if required else f"WHEN {c} IS NULL THEN NULL"
    out = f"CASE {head} WHEN {int_sql(c, typ)} IS NULL THEN '{c}: value is not a valid integer'"
    if ge:
        out += f" WHEN {int_sql(c, typ)} < 0 THEN '{c}: value must be >= 0'"
    return out + " END"


def msg_num(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN '{c}: field required' "
            f"WHEN NOT {num_ok_sql(c)} THEN '{c}: value is not a valid number' "
            f"WHEN TRY_CAST({c} AS DOUBLE) < 0 THEN '{c}: value must be >= 0' END")


def msg_str(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '{c}: field required' END"


TAGGED = """,
parsed_orders AS (
  SELECT *, """ + parse_sql("order_date") + """ AS ts,
         try_strptime(order_date, '%Y-%m-%d') AS ts_strict
  FROM raw_orders
),
tagged_orders AS (
  SELECT *,
    CASE WHEN ts IS NULL THEN 'Flexible parsing also failed' END AS _parse_error,
    CASE WHEN ts IS NOT NULL THEN concat_ws('; ',
      """ + msg_int("order_id") + """,
      """ + msg_int("product_id") + """,
      """ + msg_int("qty", ge=True, typ="BIGINT") + """,
      """ + msg_num("unit_price") + """,
      """ + msg_int("user_id", required=False) + """,
      CASE WHEN strftime(ts, '%Y-%m-%d') <> file_day THEN 'order_date: outside run date ' || file_day END)
    END AS _error,
    ts_strict IS NULL AND ts IS NOT NULL AS _date_recovered,
    file_day AS date
  FROM parsed_orders
),
flagged_orders AS (
  SELECT *, (ts IS NOT NULL AND _error = '') AS good,
         CASE WHEN ts IS NOT NULL AND _error = '' THEN
           ROUND(""" + int_sql("qty") + """ * TRY_CAST(unit_price AS DECIMAL(28,6)), 2) END AS total
  FROM tagged_orders
)"""

TAGGED_ORDERS = RAW_ORDERS + TAGGED

# The raw orders with every order dated on the first of its month.
RAW_MONTHLY = RAW_ORDERS.replace("o.o_orderdate", "date_trunc('month', o.o_orderdate)")

VALID_PRODUCTS = RAW_PRODUCTS + """,
products_checked AS (
  SELECT *, concat_ws('; ', """ + msg_int("product_id") + """, """ + msg_str("product_name") + """,
                       """ + msg_num("price") + """) AS _error
  FROM raw_products
),
valid_products AS (
  SELECT """ + int_sql("product_id") + """ AS product_id, product_name, category,
         TRY_CAST(price AS DECIMAL(28,6)) AS product_price
  FROM products_checked WHERE _error = ''
)"""

ENRICHED = """
enriched AS (
  SELECT o.order_id, o.order_date, o.product_id, o.qty, o.unit_price, o.order_status,
         ROUND(o.qty * CAST(o.unit_price AS DECIMAL(28,6)), 2) AS order_total,
         COALESCE(p.product_name, 'unknown_product') AS product_name,
         COALESCE(p.category, 'unknown_category') AS category,
         p.product_price
  FROM orders_all o LEFT JOIN valid_products p ON o.product_id = p.product_id
)"""

F1_ORDER_TOTAL = _with(ORDERS_ALL) + """
SELECT order_id, product_id, CAST(qty AS BIGINT) AS qty, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(ROUND(qty * CAST(unit_price AS DECIMAL(28,6)), 2) AS DOUBLE) AS order_total
FROM orders_all
"""

F2_ORDER_DATE_ISO = _with(ORDERS_ALL) + """
SELECT order_id, product_id, strftime(order_date, '%Y-%m-%d') AS order_date_iso FROM orders_all
"""

J1_ENRICH_LEFT = _with(ORDERS_ALL, VALID_PRODUCTS, ENRICHED) + """
SELECT order_id, product_id, product_name, category, CAST(product_price AS DOUBLE) AS product_price,
       CAST(order_total AS DOUBLE) AS order_total
FROM enriched
"""

J2_ENRICH_INNER = _with(ORDERS_ALL, VALID_PRODUCTS) + """
SELECT o.order_id, o.product_id, p.product_name, COALESCE(p.category, 'unknown_category') AS category,
       CAST(p.product_price AS DOUBLE) AS product_price,
       CAST(ROUND(o.qty * CAST(o.unit_price AS DECIMAL(28,6)), 2) AS DOUBLE) AS order_total
FROM orders_all o JOIN valid_products p ON o.product_id = p.product_id
"""

A1_DAILY_CATEGORY_REVENUE = _with(ORDERS_ALL, VALID_PRODUCTS, ENRICHED) + """
SELECT strftime(order_date, '%Y-%m-%d') AS order_date_iso, category,
       CAST(ROUND(SUM(order_total), 2) AS DOUBLE) AS total_revenue,
       CAST(SUM(qty) AS BIGINT) AS total_units
FROM enriched GROUP BY 1, 2 ORDER BY 1 NULLS LAST, 2 NULLS LAST
"""

T1_TOP_PRODUCTS = _with(ORDERS_ALL, VALID_PRODUCTS, ENRICHED, """
per_product AS (
  SELECT product_id, product_name, category, SUM(order_total) AS total_revenue,
         CAST(SUM(qty) AS BIGINT) AS total_units
  FROM enriched GROUP BY product_id, product_name, category
)""") + """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY total_revenue DESC, product_id NULLS LAST) AS INTEGER) AS rank,
       product_id, product_name, category, CAST(ROUND(total_revenue, 2) AS DOUBLE) AS total_revenue,
       total_units
FROM per_product ORDER BY total_revenue DESC, product_id NULLS LAST LIMIT 10
"""

U1_UNION_ALL = _with(ORDERS_ALL) + """
SELECT order_id, order_date, product_id, qty, CAST(unit_price AS DOUBLE) AS unit_price, user_id, order_status
FROM orders_all WHERE order_date < TIMESTAMP '1998-01-01 00:00:00'
UNION ALL
SELECT order_id, order_date, product_id, qty, CAST(unit_price AS DOUBLE) AS unit_price, user_id, order_status
FROM orders_all WHERE order_date >= TIMESTAMP '1998-01-01 00:00:00' OR order_date IS NULL
"""

C3_DATES_GOOD = _with(TAGGED_ORDERS) + """
SELECT order_id, product_id, ts AS order_date, _date_recovered FROM tagged_orders WHERE ts IS NOT NULL
"""

C3_DATES_BAD = _with(TAGGED_ORDERS) + """
SELECT order_id, product_id, order_date, _parse_error FROM tagged_orders WHERE ts IS NULL
"""

C6_NUMERIC_COERCE = _with(RAW_ORDERS, """
coerced AS (
  SELECT order_id, COALESCE(TRY_CAST(trunc(TRY_CAST(qty AS DOUBLE)) AS BIGINT), 0) AS qty,
         COALESCE(TRY_CAST(unit_price AS DECIMAL(28,6)), CAST(0 AS DECIMAL(28,6))) AS unit_price
  FROM raw_orders
)""") + """
SELECT order_id, qty, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(ROUND(qty * unit_price, 2) AS DOUBLE) AS order_total
FROM coerced
"""

V2_ORDERS_GOOD = _with(TAGGED_ORDERS) + """
SELECT """ + int_sql("order_id") + """ AS order_id, ts AS order_date,
       """ + int_sql("product_id") + """ AS product_id, """ + int_sql("qty") + """ AS qty,
       CAST(TRY_CAST(unit_price AS DECIMAL(28,6)) AS DOUBLE) AS unit_price,
       """ + int_sql("user_id") + """ AS user_id, order_status, _date_recovered
FROM tagged_orders WHERE ts IS NOT NULL AND _error = ''
"""

V2_ORDERS_BAD = _with(TAGGED_ORDERS) + """
SELECT order_id, order_date, product_id, qty, unit_price, user_id, order_status, date, _error
FROM tagged_orders WHERE ts IS NOT NULL AND _error <> ''
"""

V6_BAD_UNION = _with(TAGGED_ORDERS) + """
SELECT order_id, order_date, product_id, qty, unit_price, _parse_error, NULL AS _error
FROM tagged_orders WHERE ts IS NULL
UNION ALL
SELECT order_id, strftime(ts, '%Y-%m-%d') AS order_date, product_id, qty, unit_price, NULL AS _parse_error, _error
FROM tagged_orders WHERE ts IS NOT NULL AND _error <> ''
"""

V3_PRODUCTS_BAD = _with(VALID_PRODUCTS) + """
SELECT product_id, product_name, category, price, _error FROM products_checked WHERE _error <> ''
"""

V4_INVENTORY_BAD = _with(RAW_INVENTORY, """
inv_parsed AS (
  SELECT *, """ + parse_sql("last_restock_date") + """ AS ts FROM raw_inventory
),
inv_checked AS (
  SELECT *, concat_ws('; ', """ + msg_int("product_id") + """, """ + msg_str("warehouse_id") + """,
                       """ + msg_int("stock_on_hand", ge=True, typ="BIGINT") + """) AS rule_error
  FROM inv_parsed
)""") + """
SELECT product_id, warehouse_id, stock_on_hand, last_restock_date,
       'Flexible parsing also failed' AS _parse_error, NULL AS _error
FROM inv_checked WHERE ts IS NULL
UNION ALL
SELECT product_id, warehouse_id, stock_on_hand, strftime(ts, '%Y-%m-%d') AS last_restock_date,
       NULL AS _parse_error, rule_error AS _error
FROM inv_checked WHERE ts IS NOT NULL AND rule_error <> ''
"""

A6_RUN_SUMMARY = _with(TAGGED_ORDERS) + """
SELECT CAST(COUNT(*) FILTER (WHERE good) AS BIGINT) AS rows,
       CAST(ROUND(SUM(total), 2) AS DOUBLE) AS revenue,
       CAST(COUNT(*) FILTER (WHERE NOT good) AS BIGINT) AS bad_rows
FROM flagged_orders
"""

PER_DAY = """
per_day AS (
  SELECT date, COUNT(*) FILTER (WHERE good) AS rows,
         COALESCE(CAST(ROUND(SUM(total), 2) AS DOUBLE), 0.0) AS revenue,
         COUNT(*) FILTER (WHERE NOT good) AS bad_rows
  FROM flagged_orders GROUP BY date
),
spine AS (
  SELECT strftime(d, '%Y-%m-%d') AS date, strftime(d, '%Y%m%d') AS run_date
  FROM generate_series((SELECT date_trunc('day', MIN(o_orderdate)) FROM orders)::TIMESTAMP,
                       (SELECT MAX(o_orderdate) FROM orders)::TIMESTAMP, INTERVAL 1 DAY) t(d)
)"""

P3_BACKFILL = _with(TAGGED_ORDERS, PER_DAY) + """
SELECT s.date, s.run_date, CAST(p.rows AS BIGINT) AS rows, p.revenue, CAST(p.bad_rows AS BIGINT) AS bad_rows,
       CASE WHEN p.rows IS NULL THEN 'missing' WHEN p.rows = 0 THEN 'no_valid_rows' ELSE 'ok' END AS status,
       CASE WHEN p.rows IS NULL THEN 'No order file for date ' || s.run_date END AS error
FROM spine s LEFT JOIN per_day p ON s.date = p.date
"""

P3_BACKFILL_WRITTEN = _with(TAGGED_ORDERS, PER_DAY) + """
SELECT s.date, CAST(p.rows AS BIGINT) AS rows, p.revenue, CAST(p.bad_rows AS BIGINT) AS bad_rows,
       CASE WHEN p.rows IS NULL THEN 'missing' WHEN p.rows = 0 THEN 'no_valid_rows' ELSE 'ok' END AS status,
       CAST(CASE WHEN p.rows > 0 THEN p.rows END AS BIGINT) AS rows_held,
       CASE WHEN p.rows > 0 THEN p.revenue END AS revenue_held
FROM spine s LEFT JOIN per_day p ON s.date = p.date
"""

LAST_DAY = "(SELECT strftime(MAX(o_orderdate), '%Y-%m-%d') FROM orders)"

P1_RUN_DAY = _with(TAGGED_ORDERS, VALID_PRODUCTS, PER_DAY) + """
SELECT f.date, CAST(""" + int_sql("f.order_id") + """ AS VARCHAR) AS order_id, CAST(""" + int_sql("f.qty") + """ AS VARCHAR) AS qty,
       COALESCE(v.product_name, 'unknown_product') AS product_name, CAST(f.total AS DOUBLE) AS order_total,
       CAST(NULL AS VARCHAR) AS error, CAST(d.rows AS BIGINT) AS day_rows, d.revenue AS day_revenue
FROM flagged_orders f JOIN per_day d ON d.date = f.date
LEFT JOIN valid_products v ON v.product_id = """ + int_sql("f.product_id") + """
WHERE f.good AND f.date = """ + LAST_DAY + """
UNION ALL
SELECT f.date, f.order_id, f.qty, NULL, NULL, COALESCE(f._parse_error, f._error), CAST(d.rows AS BIGINT), d.revenue
FROM flagged_orders f JOIN per_day d ON d.date = f.date WHERE NOT f.good AND f.date = """ + LAST_DAY + """
"""

P2_NO_VALID_ROWS = _with(RAW_ORDERS) + """
SELECT file_day AS date, COUNT(*) AS bad_rows, CAST(0 AS BIGINT) AS rows, CAST(0 AS DOUBLE) AS revenue, FALSE AS processed
FROM raw_orders WHERE file_day = """ + LAST_DAY + """ GROUP BY file_day
"""

W4_BAD_ROWS_BY_DATE = _with(TAGGED_ORDERS) + """
SELECT date, order_id, qty, _parse_error, _error FROM flagged_orders WHERE NOT good
"""

C2_FORMATLESS_DATES = _with(TAGGED_ORDERS) + """
SELECT order_id, order_date, ts AS order_ts FROM tagged_orders
"""

C9_TEXT_DATES = _with(TAGGED_ORDERS) + """
SELECT order_id, strftime(ts, '%Y-%m-%d') AS order_date_iso FROM tagged_orders
"""

A9_EMPTINESS = _with(TAGGED_ORDERS) + """
SELECT COUNT(*) AS rows, COALESCE(CAST(ROUND(SUM(total), 2) AS DOUBLE), 0.0) AS revenue,
       COUNT(*) = 0 AS no_good, COUNT(*) FILTER (WHERE """ + int_sql("qty") + """ < 0) = 0 AS no_negative
FROM flagged_orders WHERE good
"""

T5_HEAD = _with(PRODUCTS) + """
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM products ORDER BY product_id LIMIT 5
"""

SHIFTED = """
shifted AS (
  SELECT order_id, 2 * product_id AS product_id, ROUND(qty * CAST(unit_price AS DECIMAL(28,6)), 2) AS order_total
  FROM orders_all
)"""


def _shifted(join: str) -> str:
    return _with(ORDERS_ALL, VALID_PRODUCTS, SHIFTED) + f"""
SELECT o.order_id, COALESCE(o.product_id, p.product_id) AS product_id, COALESCE(p.product_name, 'unknown_product') AS product_name,
       COALESCE(p.category, 'unknown_category') AS category, CAST(p.product_price AS DOUBLE) AS product_price,
       CAST(o.order_total AS DOUBLE) AS order_total
FROM shifted o {join} JOIN valid_products p ON o.product_id = p.product_id
"""


C7_TEXT_KEYS = _with(ORDERS_ALL, VALID_PRODUCTS, """
keyed AS (
  SELECT order_id, qty, CASE WHEN order_id % 8 IN (1, 2, 3) THEN NULL ELSE product_id END AS product_id FROM orders_all
)""") + """
SELECT k.order_id, k.qty, k.product_id, COALESCE(p.product_name, 'unknown_product') AS product_name
FROM keyed k LEFT JOIN valid_products p ON k.product_id = p.product_id
"""

S6_MALFORMED = _with(RAW_PRODUCTS) + """
SELECT product_id, CASE CAST(product_id AS BIGINT) % 20 WHEN 2 THEN '19" ' || product_name || ', black' ELSE product_name END AS product_name,
       concat_ws('; ', CASE WHEN CAST(product_id AS BIGINT) % 20 IN (5, 6) THEN 'row: malformed CSV line' END,
                 CASE WHEN CAST(product_id AS BIGINT) % 20 = 5 THEN 'price: field required'
                      WHEN price LIKE '-%' THEN 'price: value must be >= 0' END) AS _error
FROM raw_products
"""

W1_PARQUET_ROUNDTRIP = _with(TAGGED_ORDERS, VALID_PRODUCTS, """
good AS (
  SELECT """ + int_sql("order_id") + """ AS order_id, """ + int_sql("product_id") + """ AS product_id,
         """ + int_sql("qty") + """ AS qty, total, date
  FROM flagged_orders WHERE good
)""") + """
SELECT g.order_id, g.product_id, g.qty, CAST(g.total AS DOUBLE) AS order_total,
       COALESCE(p.product_name, 'unknown_product') AS product_name,
       COALESCE(p.category, 'unknown_category') AS category, g.date
FROM good g LEFT JOIN valid_products p ON g.product_id = p.product_id
"""

W2_SUMMARY_ROUNDTRIP = _with(TAGGED_ORDERS) + """
SELECT date, CAST(COUNT(*) FILTER (WHERE good) AS BIGINT) AS rows,
       COALESCE(CAST(ROUND(SUM(total), 2) AS DOUBLE), 0.0) AS revenue
FROM flagged_orders GROUP BY date HAVING COUNT(*) FILTER (WHERE good) > 0
"""

W3_BAD_CSV_ROUNDTRIP = _with(TAGGED_ORDERS) + """
SELECT order_id, order_date, qty, unit_price, _parse_error, _error
FROM flagged_orders WHERE NOT good
"""

RAW_COLS = {
    "orders": ["order_id", "order_date", "product_id", "qty", "unit_price", "user_id", "order_status"],
    "products": ["product_id", "product_name", "category", "price"],
    "inventory": ["product_id", "warehouse_id", "stock_on_hand", "last_restock_date"],
}

A7_NULL_COUNTS = _with(RAW_ORDERS) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM raw_orders"
    for c in RAW_COLS["orders"])

P7_PROFILE = _with(RAW_ORDERS, RAW_PRODUCTS, RAW_INVENTORY) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{ds}' AS dataset, {i} AS position, '{c}' AS \"column\", 'string' AS dtype, "
    f"CAST(COUNT(*) AS BIGINT) AS rows, CAST(COUNT({c}) AS BIGINT) AS non_null, "
    f"CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM raw_{ds}"
    for ds, cols in RAW_COLS.items() for i, c in enumerate(cols))


def _preview(dataset: str, columns: list[str]) -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in columns)
    cells = "\nUNION ALL\n".join(f"SELECT '{dataset}' AS dataset, row, {i} AS position, '{c}' AS \"column\", {c} AS value FROM first_{dataset}"
                                 for i, c in enumerate(columns))
    return (f"first_{dataset} AS (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS row FROM raw_{dataset} "
            f"ORDER BY {order} LIMIT 5),\ncells_{dataset} AS (\n{cells})")


P7_PREVIEW = _with(RAW_ORDERS, RAW_PRODUCTS, RAW_INVENTORY, *[_preview(ds, cols) for ds, cols in RAW_COLS.items()]) + """
SELECT * FROM cells_orders UNION ALL SELECT * FROM cells_products UNION ALL SELECT * FROM cells_inventory
"""

C1_STRICT_DATES = _with(RAW_ORDERS) + """
SELECT order_id, order_date, try_strptime(order_date, '%Y-%m-%d') AS order_ts FROM raw_orders
"""

C5_ALIAS_NORMALIZE = C6_NUMERIC_COERCE

V5_MISSING_COLUMN = _with(RAW_PRODUCTS) + """
SELECT product_id, product_name,
       concat_ws('; ', """ + msg_int("product_id") + """, """ + msg_str("product_name") + """,
                 'price: field required') AS _error
FROM raw_products
"""

A2_PRODUCT_REVENUE = _with(ORDERS_ALL, VALID_PRODUCTS, ENRICHED) + """
SELECT product_id, product_name, category, CAST(SUM(order_total) AS DOUBLE) AS total_revenue,
       CAST(SUM(qty) AS BIGINT) AS total_units
FROM enriched GROUP BY product_id, product_name, category
"""

A3_DAILY_CATEGORY_NET = _with(ORDERS_ALL, PRODUCTS, DAY_CATEGORY) + """
SELECT day AS order_date_only, category, net::DOUBLE AS revenue FROM day_category
"""

A4_DAILY_TOTALS = _with(ORDERS_ALL, PRODUCTS, DAY_CATEGORY) + """
SELECT day AS order_date_only, ROUND(SUM(net), 2)::DOUBLE AS total_revenue FROM day_category GROUP BY day
"""

F7_RETURN_RATE = _with(ORDERS_ALL) + """
SELECT product_id, (units_completed + units_returned)::BIGINT AS total_units_transacted,
       """ + _rate("units_returned", "(units_completed + units_returned)") + """ AS return_rate_percent
FROM (SELECT product_id, """ + _status_columns() + """ FROM orders_all GROUP BY ALL)
"""


S1_PRODUCTS_CSV = _with(VALID_PRODUCTS) + """
SELECT product_id, product_name, category, CAST(product_price AS DOUBLE) AS price FROM valid_products
"""

S2_INVENTORY_CSV = _with(RAW_INVENTORY) + """
SELECT product_id, warehouse_id, stock_on_hand, ts AS last_restock_date
FROM (SELECT *, """ + parse_sql("last_restock_date") + """ AS ts FROM raw_inventory)
WHERE ts IS NOT NULL
"""


S1_QUOTED_LINES = _with(RAW_PRODUCTS) + """
SELECT product_id, CASE WHEN k % 16 < 6 AND k % 5 = 1 THEN 'first, of ' || product_name || chr(10) || 'the "second"' || chr(10)
                        ELSE product_name END AS product_name, price,
       concat_ws('; ', CASE WHEN k % 32 = 31 THEN 'row: malformed CSV line' END, """ + msg_num("price") + """) AS _error
FROM (SELECT *, CAST(product_id AS BIGINT) AS k FROM raw_products)
"""

S3_ORDERS_QUOTED = _with(RAW_ORDERS) + """
SELECT order_id, order_date, product_id, qty, unit_price, user_id,
       CASE WHEN CAST(substr(file_day, 9, 2) AS INTEGER) % 4 = 0 AND CAST(order_id AS BIGINT) % 7 = 2
            THEN coalesce(order_status, '') || ',' || chr(10) || '"checked"' || chr(10) ELSE order_status END AS order_status,
       replace(file_day, '-', '') AS file_day, FALSE AS malformed
FROM raw_orders
"""


# The raw orders with a hot key and a hot product that is rejected.
RAW_HOT = RAW_ORDERS.replace("raw_orders AS", "cold_orders AS") + """,
raw_orders AS (
  SELECT CASE CAST(order_id AS BIGINT) % 3 WHEN 0 THEN '1' ELSE order_id END AS order_id, order_date,
         CASE CAST(order_id AS BIGINT) % 3 WHEN 0 THEN '1' WHEN 1 THEN '10' ELSE product_id END AS product_id,
         qty, unit_price, user_id, order_status, file_day FROM cold_orders
)""" + TAGGED

V_UNIQUE = _with(RAW_HOT, """
keyed AS (SELECT *, COUNT(*) FILTER (WHERE good) OVER (PARTITION BY order_id, product_id) AS n FROM flagged_orders)""") + """
SELECT order_id, product_id, qty, unit_price, CASE WHEN good THEN 'order_id, product_id: key is on ' || n || ' rows' ELSE _error END AS _error
FROM keyed WHERE ts IS NOT NULL AND (NOT good OR n > 1)
"""

V_REFERENCE = _with(RAW_HOT, VALID_PRODUCTS) + """
SELECT order_id, product_id, qty, unit_price, CASE WHEN good THEN 'product_id: no such product' ELSE _error END AS _error
FROM flagged_orders f WHERE ts IS NOT NULL
 AND (NOT good OR NOT EXISTS (SELECT 1 FROM valid_products v WHERE v.product_id = CAST(f.product_id AS BIGINT)))
"""

C3_INFERRED_ORDER = _with(ORDERS_ALL, """
texts AS (
  SELECT order_id, product_id, order_date, strftime(order_date, '%Y%m') AS file, day(order_date) > 12 AS shows,
         CASE WHEN month(order_date) % 2 = 1 THEN strftime(order_date, '%-d/%-m/%Y') ELSE strftime(order_date, '%-m/%-d/%Y') END AS text,
         month(order_date) % 2 = 1 AS day_first
  FROM orders_all
),
files AS (SELECT file, bool_or(shows) AS known FROM texts GROUP BY file)""") + """
SELECT order_id, product_id, text, CASE WHEN known THEN CASE WHEN day_first THEN 'day first' ELSE 'month first' END END AS _date_order,
       CASE WHEN known THEN date_trunc('day', order_date)::TIMESTAMP ELSE strptime(text, '%m/%d/%Y') END AS order_ts
FROM texts JOIN files USING (file)
"""

C3_MORE_FORMS = _with(ORDERS_ALL) + """
SELECT order_id, product_id, CASE order_id % 5 WHEN 0 THEN strftime(order_date, '%b %-d %Y') WHEN 1 THEN strftime(order_date, '%m/%d/%y')
         WHEN 2 THEN strftime(order_date, '%a %b %d %Y') WHEN 3 THEN strftime(order_date, '%Y%m%dT%H%M%S')
         ELSE strftime(order_date, '%A, %B %-d, %Y') END AS text,
       CASE WHEN order_id % 5 = 3 THEN order_date ELSE date_trunc('day', order_date)::TIMESTAMP END AS order_ts
FROM orders_all
"""

J1_ENRICH_HOT = _with(ORDERS_ALL, VALID_PRODUCTS, """
hot AS (
  SELECT order_id, CASE order_id % 4 WHEN 0 THEN 7 WHEN 1 THEN 10 ELSE product_id END AS product_id,
         ROUND(qty * CAST(unit_price AS DECIMAL(28,6)), 2) AS order_total FROM orders_all
)""") + """
SELECT h.order_id, h.product_id, COALESCE(p.product_name, 'unknown_product') AS product_name,
       COALESCE(p.category, 'unknown_category') AS category, CAST(p.product_price AS DOUBLE) AS product_price,
       CAST(h.order_total AS DOUBLE) AS order_total
FROM hot h LEFT JOIN valid_products p ON h.product_id = p.product_id
"""


A9_CHANNELS_BY_DAY = _with(RAW_MONTHLY.replace("raw_orders AS", "all_orders AS"), """
raw_orders AS (
  SELECT order_id, order_date, product_id, CASE WHEN substr(file_day, 6, 2) = '10' THEN '-1' ELSE qty END AS qty,
         unit_price, user_id, order_status, file_day
  FROM all_orders WHERE substr(file_day, 6, 2) <> '02' OR CAST(order_id AS BIGINT) % 50 > 20
)""" + TAGGED) + """
SELECT date, COUNT(*) FILTER (WHERE good) > 0 AS has_good, COUNT(*) FILTER (WHERE NOT good) > 0 AS has_bad
FROM flagged_orders GROUP BY date
"""

P3_LATE_ROWS = _with(RAW_MONTHLY.replace("raw_orders AS", "first_orders AS"), """
raw_orders AS (
  SELECT order_id, order_date, product_id, CASE WHEN CAST(order_id AS BIGINT) % 11 = 5 THEN '7' ELSE qty END AS qty,
         unit_price, user_id, order_status, file_day FROM first_orders
)""" + TAGGED.replace("CASE WHEN strftime(ts, '%Y-%m-%d') <> file_day THEN 'order_date: outside run date ' || file_day END", "NULL")) + """
SELECT strftime(ts, '%Y-%m-%d') AS date, COUNT(*) AS rows, CAST(ROUND(SUM(total), 2) AS DOUBLE) AS revenue,
       COUNT(*) AS rows_held, CAST(ROUND(SUM(total), 2) AS DOUBLE) AS revenue_held, CAST(SUM(""" + int_sql("qty") + """) AS BIGINT) AS units_held
FROM flagged_orders WHERE good GROUP BY 1
"""

# What two incremental runs leave: the orders after the changes between them.
CHANGED = RAW_MONTHLY.replace("raw_orders AS", "first_orders AS") + """,
raw_orders AS (
  SELECT order_id, order_date, product_id,
         CASE WHEN substr(file_day, 6, 2) = '05' AND try_cast(qty AS INTEGER) >= 10 THEN NULL ELSE qty END AS qty,
         unit_price, user_id, order_status, file_day
  FROM first_orders WHERE substr(file_day, 6, 2) <> '08'
)""" + TAGGED

CHANGED_LINES = """
orders_all AS (
  SELECT """ + int_sql("order_id") + """ AS order_id, ts AS order_date, """ + int_sql("product_id") + """ AS product_id,
         """ + int_sql("qty") + """ AS qty, TRY_CAST(unit_price AS DECIMAL(28,6)) AS unit_price, order_status
  FROM flagged_orders WHERE good
),
products AS (SELECT product_id, product_name, category FROM valid_products)"""

P3_INCREMENTAL = _with(CHANGED, """
per_day AS (
  SELECT date, CAST(COUNT(*) FILTER (WHERE good) AS BIGINT) AS rows, COALESCE(CAST(ROUND(SUM(total), 2) AS DOUBLE), 0.0) AS revenue,
         CAST(COUNT(*) FILTER (WHERE NOT good) AS BIGINT) AS bad_rows
  FROM flagged_orders GROUP BY date
),
gone AS (SELECT DISTINCT file_day AS date FROM first_orders WHERE substr(file_day, 6, 2) = '08')""") + """
SELECT date, CASE WHEN substr(date, 6, 2) <> '05' THEN 'unchanged' WHEN rows > 0 THEN 'ok' ELSE 'no_valid_rows' END AS status,
       rows, revenue, bad_rows, CASE WHEN rows > 0 THEN rows END AS rows_held, CASE WHEN rows > 0 THEN revenue END AS revenue_held,
       substr(date, 6, 2) = '05' AS rewritten
FROM per_day
UNION ALL
SELECT date, NULL, NULL, NULL, NULL, NULL, NULL, TRUE FROM gone
"""


P4_FROM_PARTIALS = _with(CHANGED, VALID_PRODUCTS, CHANGED_LINES) + "," + P4_DAILY_REVENUE[P4_DAILY_REVENUE.index("day_category AS") - 1:]
P5_FROM_PARTIALS = _with(CHANGED, VALID_PRODUCTS, CHANGED_LINES) + "," + P5_PRODUCT_PERFORMANCE[P5_PRODUCT_PERFORMANCE.index("sold AS") - 1:]
A1_FROM_PARTIALS = _with(CHANGED, VALID_PRODUCTS, CHANGED_LINES, ENRICHED) + A1_DAILY_CATEGORY_REVENUE[
    A1_DAILY_CATEGORY_REVENUE.index("SELECT strftime(order_date, '%Y-%m-%d') AS order_date_iso"):]

T2_DAILY_ORDER = f"SELECT *, ROW_NUMBER() OVER (ORDER BY date) AS position FROM ({P4_DAILY_REVENUE})"
T3_PERFORMANCE_ORDER = f"""SELECT *, ROW_NUMBER() OVER (ORDER BY revenue_completed DESC, product_id NULLS FIRST) AS position
FROM ({P5_PRODUCT_PERFORMANCE})"""
T4_ALERTS_ORDER = f"""SELECT *, ROW_NUMBER() OVER (ORDER BY stock_on_hand, product_id, warehouse_id) AS position
FROM ({P6_INVENTORY_ALERTS})"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_daily_revenue": P4_DAILY_REVENUE,
        "n1_top_category": N1_TOP_CATEGORY,
        "p5_product_performance": P5_PRODUCT_PERFORMANCE,
        "a5_status_sums": A5_STATUS_SUMS,
        "p6_inventory_alerts": P6_INVENTORY_ALERTS,
        "u1_union_all": U1_UNION_ALL,
        "f1_order_total": F1_ORDER_TOTAL,
        "f2_order_date_iso": F2_ORDER_DATE_ISO,
        "j1_enrich_left": J1_ENRICH_LEFT,
        "j2_enrich_inner": J2_ENRICH_INNER,
        "a1_daily_category_revenue": A1_DAILY_CATEGORY_REVENUE,
        "t1_top_products": T1_TOP_PRODUCTS,
        "c3_dates_good": C3_DATES_GOOD,
        "c3_dates_bad": C3_DATES_BAD,
        "c6_numeric_coerce": C6_NUMERIC_COERCE,
        "v2_orders_good": V2_ORDERS_GOOD,
        "v2_orders_bad": V2_ORDERS_BAD,
        "v6_bad_union": V6_BAD_UNION,
        "v3_products_bad": V3_PRODUCTS_BAD,
        "v4_inventory_bad": V4_INVENTORY_BAD,
        "a6_run_summary": A6_RUN_SUMMARY,
        "p3_backfill": P3_BACKFILL,
        "p3_backfill_written": P3_BACKFILL_WRITTEN,
        "p1_run_day": P1_RUN_DAY,
        "p2_no_valid_rows": P2_NO_VALID_ROWS,
        "w4_bad_rows_by_date": W4_BAD_ROWS_BY_DATE,
        "c2_formatless_dates": C2_FORMATLESS_DATES,
        "c9_text_dates": C9_TEXT_DATES,
        "a9_emptiness": A9_EMPTINESS,
        "t5_head": T5_HEAD,
        "s6_malformed": S6_MALFORMED,
        "j2_enrich_right": _shifted("RIGHT"),
        "j2_enrich_outer": _shifted("FULL OUTER"),
        "c7_text_keys": C7_TEXT_KEYS,
        "w1_parquet_roundtrip": W1_PARQUET_ROUNDTRIP,
        "w2_summary_roundtrip": W2_SUMMARY_ROUNDTRIP,
        "w3_bad_csv_roundtrip": W3_BAD_CSV_ROUNDTRIP,
        "a7_null_counts": A7_NULL_COUNTS,
        "p7_profile": P7_PROFILE,
        "c1_strict_dates": C1_STRICT_DATES,
        "c5_alias_normalize": C5_ALIAS_NORMALIZE,
        "v5_missing_column": V5_MISSING_COLUMN,
        "a2_product_revenue": A2_PRODUCT_REVENUE,
        "a3_daily_category_net": A3_DAILY_CATEGORY_NET,
        "a4_daily_totals": A4_DAILY_TOTALS,
        "f7_return_rate": F7_RETURN_RATE,
        "s1_products_csv": S1_PRODUCTS_CSV,
        "s2_inventory_csv": S2_INVENTORY_CSV,
        "s3_orders_csv_backfill": P3_BACKFILL,
        "s1_quoted_lines": S1_QUOTED_LINES,
        "s3_orders_quoted": S3_ORDERS_QUOTED,
        "s3_order_files_backfill": P3_BACKFILL_WRITTEN,
        "p3_incremental": P3_INCREMENTAL,
        "p3_late_rows": P3_LATE_ROWS,
        "c3_inferred_order": C3_INFERRED_ORDER,
        "c3_more_forms": C3_MORE_FORMS,
        "j1_enrich_hot": J1_ENRICH_HOT,
        "p7_preview": P7_PREVIEW,
        "a9_channels_by_day": A9_CHANNELS_BY_DAY,
        "p4_from_partials": P4_FROM_PARTIALS,
        "p5_from_partials": P5_FROM_PARTIALS,
        "a1_from_partials": A1_FROM_PARTIALS,
        "t2_daily_order": T2_DAILY_ORDER,
        "t3_performance_order": T3_PERFORMANCE_ORDER,
        "t4_alerts_order": T4_ALERTS_ORDER,
        "v_unique": V_UNIQUE,
        "v_reference": V_REFERENCE,
    }
