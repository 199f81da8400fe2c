"""The registered queries once more, as plain SQL over the given tables.

Written for an independent engine and without use of the operators: only the fixed rule lists are
shared with the library.
"""

from __future__ import annotations

from plinth.operators import enrich as R

DAY_0, DAY_1 = "1996-01-01 00:00:00", "1998-07-01 00:00:00"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


def _case(col: str, table: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {col} " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items()) + f" ELSE {other} END"


def _nth(values: list[str], index: str) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END"


def _sha(cols: list[str]) -> str:
    return "sha1(concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in cols) + "))"


def _hk(*cols: str) -> str:
    return f"CAST('0x' || substr({_sha(list(cols))}, 1, 15) AS BIGINT)"


def _avg(total: str, n: str) -> str:
    """Exact half-up division of non-negative money by a count."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST(CAST((2 * {cents} + {n}) // (2 * {n}) AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


NET = "CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(10,2))"
STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'In Transit' END"
CITIES, STATES = R.TIER_1 + R.TIER_2, list(R.STATE_CODES)

# instants enter keys as microseconds, so that they look alike in every time zone
STARTED = "epoch_us(CAST(eff_start AS TIMESTAMP))"

BORN = "(DATE '1970-01-01' + CAST(floor(c_acctbal) AS INTEGER))"
CUSTOMER_TEXT = f"""customer_text AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customerid, c_name AS name,
    '9' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS mobile,
    lower(replace(c_name, '#', '.')) || '@mail.test' AS email,
    c_mktsegment AS loginbyusing, CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN strftime({BORN}, '%d/%m/%Y') ELSE strftime({BORN}, '%Y-%m-%d') END AS dob,
    CASE WHEN c_acctbal >= 0 THEN strftime(DATE '1990-01-01' + CAST(floor(c_acctbal) AS INTEGER), '%Y-%m-%d') END AS anniversary,
    '{{"segment":"' || c_mktsegment || '"}}' AS preferences,
    '2020-01-01T08:30:00.123456' AS createddate,
    '2020-02-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || 'T10:00:00.000001' AS modifieddate,
    c_acctbal
  FROM customer)"""
CUSTOMER_COLS = """customerid AS customer_id, name, mobile, email, loginbyusing AS login_by_using, gender,
  CASE WHEN dob LIKE '____-__-__' THEN dob END AS dob, anniversary, preferences,
  replace(createddate, 'T', ' ') AS created_dt, replace(modifieddate, 'T', ' ') AS modified_dt"""

LOCATION_TEXT = """location_text AS (
  SELECT {key} AS locationid,
    CASE WHEN {p}_acctbal < 0 THEN n_name ELSE {city} END AS city,
    CASE WHEN {p}_acctbal < 0 THEN r_name ELSE {state} END AS landed_state,
    lpad(CAST({key} AS VARCHAR), 6, '0') AS zip_code, {p}_acctbal AS balance
  FROM {owner} JOIN nation ON {p}_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
LOCATION_RULES = f"""located AS (
  SELECT *, CASE WHEN landed_state = 'Delhi' THEN 'New Delhi' ELSE landed_state END AS state,
    {_case('landed_state', R.STATE_CODES)} AS state_code,
    landed_state IN {_in(R.UNION_TERRITORIES)} AS is_union_territory,
    (landed_state = 'Delhi' AND city = 'New Delhi') OR (landed_state = 'Maharashtra' AND city = 'Mumbai') AS capital_city_flag,
    CASE WHEN city IN {_in(R.TIER_1)} THEN 'Tier-1' WHEN city IN {_in(R.TIER_2)} THEN 'Tier-2' ELSE 'Tier-3' END AS city_tier
  FROM location_text)"""


def _locations(owner: str) -> str:
    p = owner[0]
    text = LOCATION_TEXT.format(
        key=f"{p}_suppkey" if owner == "supplier" else f"{p}_custkey", p=p, owner=owner,
        city=_nth(CITIES, "n_nationkey"), state=_nth(STATES, "n_nationkey"),
    )
    return f"{text}, {LOCATION_RULES}"


MENU_TEXT = """menu_text AS (
  SELECT p_partkey AS menu_id, CAST(p_size AS BIGINT) AS restaurant_id_fk, p_name AS item_name,
    p_brand || ' ' || p_name AS description, CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_type AS category,
    CASE p_type WHEN 'PROMO' THEN true WHEN 'ECONOMY' THEN NULL ELSE false END AS availability,
    CASE WHEN p_size < 25 THEN 'Veg' ELSE 'Non-Veg' END AS item_type,
    '2020-01-01 00:00:00' AS created_dt, '2020-01-01 00:00:00' AS modified_dt
  FROM part)"""
ORDER_TEXT = """order_text AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS orderid, CAST(o_custkey AS VARCHAR) AS customerid,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS orderdate,
    CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS totalamount, o_orderstatus AS status,
    o_orderpriority AS paymentmethod FROM orders)"""
LANDED = f"""{ORDER_TEXT}, landed AS (
  SELECT CASE WHEN status = 'O' THEN concat_ws('|', orderid, customerid, orderdate, totalamount, status)
      WHEN substr(totalamount, -2) = '00' THEN 'junk-' || orderid ELSE orderid END AS orderid,
    CASE WHEN status <> 'O' THEN customerid END AS customerid, CASE WHEN status <> 'O' THEN orderdate END AS orderdate,
    CASE WHEN status <> 'O' THEN totalamount END AS totalamount, CASE WHEN status <> 'O' THEN status END AS status
  FROM order_text)"""
ITEM_TEXT = f"""item_text AS (
  SELECT CAST(l_linenumber AS VARCHAR) AS orderitemid, CAST(l_orderkey AS VARCHAR) AS orderid,
    CAST(l_partkey AS VARCHAR) AS menuid,
    CASE WHEN year(l_shipdate) = 2001 THEN 'x' || CAST(l_linenumber AS VARCHAR)
      ELSE CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR) END AS quantity,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS price, CAST({NET} AS VARCHAR) AS subtotal,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped FROM lineitem)"""

CUSTOMERS = """people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS segment,
    CAST(c_acctbal AS DECIMAL(10,2)) AS balance FROM customer),
next_day AS (
  SELECT customer_id, name, CASE WHEN balance < 0 THEN 'DEBT' ELSE segment END AS segment, balance
  FROM people WHERE balance <= 9500
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, 'SUPPLIER', CAST(s_acctbal AS DECIMAL(10,2)) FROM supplier)"""
CUSTOMER_DIM = f"""{CUSTOMERS}, versions AS (
  SELECT p.*, '{DAY_0}' AS eff_start,
    CASE WHEN balance > 9500 OR (balance < 0 AND segment <> 'DEBT') THEN '{DAY_1}' END AS eff_end FROM people p
  UNION ALL
  SELECT n.*, '{DAY_1}', NULL FROM next_day n LEFT JOIN people p USING (customer_id)
  WHERE p.customer_id IS NULL OR p.segment <> n.segment), dim AS (
  SELECT {_hk('customer_id', 'name', 'segment', 'balance', STARTED)} AS hk, customer_id, name, segment, balance,
    eff_start, eff_end, eff_end IS NULL AS is_current FROM versions)"""


def _log(where: str = "true") -> str:
    """Dimension versions from the event log."""
    return f"""steps AS (
  SELECT user_id, ts, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before
  FROM events WHERE {where}), starts AS (
  SELECT user_id, ts, event_type FROM steps WHERE before IS NULL OR before <> event_type), dim AS (
  SELECT {_hk('user_id', 'event_type', 'ts')} AS hk, user_id, event_type, ts AS eff_start,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS eff_end FROM starts)"""


def _totals(where: str = "true") -> str:
    return f"""sales AS (
  SELECT l_orderkey AS order_id, l_suppkey, {NET} AS subtotal, {STATUS} AS delivery_status,
    CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day, dayname(o_orderdate) AS day_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {where})"""


MEASURES = f"""CAST(sum(subtotal) AS DECIMAL(18,2)) AS total_revenue, count(DISTINCT order_id) AS total_orders,
  {_avg('sum(subtotal)', 'count(DISTINCT order_id)')} AS avg_revenue_per_order,
  {_avg('sum(subtotal)', 'count(*)')} AS avg_revenue_per_item, CAST(max(subtotal) AS DECIMAL(18,2)) AS max_order_value"""
DELIVERED = "o_orderstatus = 'F'"


def _kpi(grain: str, where: str = DELIVERED) -> str:
    return f"WITH {_totals(where)} SELECT {grain}, {MEASURES} FROM sales GROUP BY {grain}"


BY_RESTAURANT = f"""{_totals()}, named AS (
  SELECT s.*, s_name AS restaurant_name FROM sales s JOIN supplier ON l_suppkey = s_suppkey), kpis AS (
  SELECT year, month, delivery_status, restaurant_name, {MEASURES} FROM named
  GROUP BY year, month, delivery_status, restaurant_name)"""
YEARLY = f"{_totals(DELIVERED)}, kpis AS (SELECT year, {MEASURES} FROM sales GROUP BY year)"


def _dates(source: str) -> str:
    return f"""CAST(year({source}) AS INTEGER) AS year, CAST(quarter({source}) AS INTEGER) AS quarter,
  CAST(month({source}) AS INTEGER) AS month, CAST(week({source}) AS INTEGER) AS week,
  CAST(dayofyear({source}) AS INTEGER) AS day_of_year, CAST(dayofweek({source}) + 1 AS INTEGER) AS day_of_week,
  CAST(day({source}) AS INTEGER) AS day_of_the_month, dayname({source}) AS day_name"""


DAYS = """days AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders)"""

FACT = f"""WITH {CUSTOMERS}, menu AS (
  SELECT p_partkey AS menu_id, p_name AS item_name, p_type AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part),
customer_versions AS (
  SELECT customer_id, name, segment, balance, '{DAY_0}' AS eff_start, TIMESTAMP '1900-01-01' AS low,
    CASE WHEN balance < 0 THEN TIMESTAMP '{DAY_1}' ELSE TIMESTAMP '2999-01-01' END AS high FROM people
  UNION ALL SELECT customer_id, name, 'DEBT', balance, '{DAY_1}', TIMESTAMP '{DAY_1}', TIMESTAMP '2999-01-01'
  FROM people WHERE balance < 0),
menu_versions AS (
  SELECT menu_id, item_name, category, price, '{DAY_0}' AS eff_start, TIMESTAMP '1900-01-01' AS low,
    CASE WHEN category = 'MEDIUM' THEN TIMESTAMP '{DAY_1}' ELSE TIMESTAMP '2999-01-01' END AS high FROM menu
  UNION ALL SELECT menu_id, item_name, category, CAST(price + 5 AS DECIMAL(10,2)), '{DAY_1}', TIMESTAMP '{DAY_1}', TIMESTAMP '2999-01-01'
  FROM menu WHERE category = 'MEDIUM'),
customer_d AS (SELECT *, {_hk('customer_id', 'name', 'segment', 'balance', STARTED)} AS hk FROM customer_versions),
menu_d AS (SELECT *, {_hk('menu_id', 'item_name', 'category', 'price', STARTED)} AS hk FROM menu_versions),
address_d AS (
  SELECT address_id, {_hk('address_id', 'owner', 'city', 'kind', f"epoch_us(TIMESTAMP '{DAY_0}')")} AS hk FROM (
    SELECT c_custkey * 2 AS address_id, c_custkey AS owner, {_nth(CITIES, 'c_nationkey')} AS city, 'Home' AS kind FROM customer)),
restaurant_d AS (
  SELECT s_suppkey AS restaurant_id, s_nationkey, {_hk('s_suppkey', 's_name', 's_nationkey', 'CAST(s_acctbal AS DECIMAL(10,2))', f"epoch_us(TIMESTAMP '{DAY_0}')")} AS hk FROM supplier),
location_d AS (
  SELECT n_nationkey AS location_id, {_hk('n_nationkey', _nth(CITIES, 'n_nationkey'), _nth(STATES, 'n_nationkey'), f"epoch_us(TIMESTAMP '{DAY_0}')")} AS hk FROM nation),
agent_d AS (
  SELECT s_suppkey AS agent_id, {_hk('s_suppkey', 's_name', 's_nationkey', f"epoch_us(TIMESTAMP '{DAY_0}')")} AS hk FROM supplier)
SELECT CAST(l_linenumber AS BIGINT) AS order_item_id, l_orderkey AS order_id, c.hk AS customer_dim_key,
  a.hk AS customer_address_dim_key, r.hk AS restaurant_dim_key, l.hk AS restaurant_location_dim_key,
  m.hk AS menu_dim_key, g.hk AS delivery_agent_dim_key, {_hk('CAST(o_orderdate AS DATE)')} AS order_date_dim_key,
  CAST(round(CAST(l_quantity AS DECIMAL(10,2)), 0) AS DECIMAL(10,0)) AS quantity,
  CAST(l_extendedprice AS DECIMAL(10,2)) AS price, {NET} AS subtotal,
  {STATUS} AS delivery_status, o_orderpriority AS estimated_time
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer_d c ON c.customer_id = CAST(o_custkey AS VARCHAR) AND o_orderdate >= c.low AND o_orderdate < c.high
JOIN address_d a ON a.address_id = o_custkey * 2
JOIN restaurant_d r ON r.restaurant_id = l_suppkey
JOIN location_d l ON l.location_id = r.s_nationkey
JOIN menu_d m ON m.menu_id = l_partkey AND o_orderdate >= m.low AND o_orderdate < m.high
JOIN agent_d g ON g.agent_id = o_orderkey % (SELECT count(*) FROM supplier)"""

# one item per item and order number
FACT_LATEST = FACT.replace(
    "FROM lineitem JOIN orders",
    f"""FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_linenumber, l_orderkey ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, CAST(l_quantity AS DECIMAL(10,2)) DESC, CAST(l_extendedprice AS DECIMAL(10,2)) DESC, {NET} DESC) AS rn
  FROM lineitem) WHERE rn = 1) JOIN orders""",
)

ITEM_COLS = f"""CAST(l_linenumber AS BIGINT) AS order_item_id, l_orderkey AS order_id_fk, l_partkey AS menu_id_fk,
  CAST(l_quantity AS DECIMAL(10,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price, {NET} AS subtotal,
  l_shipdate AS modified_dt"""
LOCATION_COLS = """CAST(locationid AS BIGINT) AS location_id, city, state, state_code, is_union_territory,
  capital_city_flag, city_tier, zip_code"""


def statements() -> dict[str, str]:
    customer_text_cols = "customerid, name, mobile, email, loginbyusing, gender, dob, anniversary, preferences, createddate, modifieddate"
    sql = {
        "csv_positional_read": f"WITH {CUSTOMER_TEXT} SELECT {customer_text_cols} FROM customer_text",
        "ingest_with_lineage": f"""WITH {CUSTOMER_TEXT} SELECT customerid, name, email, true AS has_file_name,
  true AS has_file_time, 32 AS md5_length, true AS has_load_time FROM customer_text""",
        "delta_append": f"""WITH {ORDER_TEXT} SELECT orderid, orderdate, totalamount, status,
  CASE status WHEN 'F' THEN 'initial' WHEN 'O' THEN 'delta-1' ELSE 'delta-2' END AS load, 32 AS key_length, true AS has_times
FROM order_text""",
        "csv_rejects": """SELECT CAST(c_custkey AS VARCHAR) AS customerid, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'more fields than columns' ELSE 'landed' END AS outcome FROM customer""",
        "list_files": f"""WITH {ORDER_TEXT} SELECT status AS folder,
  CAST(sum(length(orderid) + length(orderdate) + length(totalamount) + 3) AS BIGINT) AS total_bytes FROM order_text GROUP BY status""",
        "csv_error_modes": """SELECT 'keep' AS mode, count(*) AS row_count,
  count(*) FILTER (c_mktsegment = 'FURNITURE') AS shifted_rows FROM customer
UNION ALL SELECT 'continue', count(*), 0 FROM customer WHERE c_mktsegment <> 'FURNITURE'""",
        "quarantine_copy": f"""WITH {LANDED} SELECT orderid, customerid, CASE WHEN orderid LIKE '%|%' THEN 'wrong delimiter'
  WHEN orderid LIKE 'junk%' THEN 'junk id' ELSE 'valid' END AS _reason FROM landed""",
        "quarantine_reasons": f"""WITH {ITEM_TEXT}, marked AS (
  SELECT *, CAST(price AS DOUBLE) > 90000 AS dear, quantity LIKE 'x%' AS odd FROM item_text)
SELECT orderid, orderitemid, menuid, quantity, CASE WHEN dear THEN subtotal || ' INR' ELSE subtotal END AS subtotal,
  concat_ws(';', CASE WHEN odd THEN 'quantity is not a decimal' END, CASE WHEN dear THEN 'subtotal is not a decimal' END) AS _reason
FROM marked WHERE dear OR odd""",
        "castability_report": f"""WITH {ITEM_TEXT}, bad AS (SELECT count(*) FILTER (quantity LIKE 'x%') AS n FROM item_text)
SELECT unnest(['orderitemid', 'orderid', 'menuid', 'quantity', 'price', 'subtotal', 'createddate', 'modifieddate']) AS column_name,
  unnest([0, 0, 0, n, 0, 0, 0, 0]) AS bad_rows FROM bad""",
        "delete_where_like": f"WITH {LANDED} SELECT * FROM landed WHERE NOT (orderid LIKE '%|%' OR orderid LIKE '%junk%')",
        "cast_strict": f"""WITH {ORDER_TEXT} SELECT CAST(orderid AS BIGINT) AS order_id,
  CAST(CAST(totalamount AS DECIMAL(38,0)) AS BIGINT) AS whole_amount, CAST(totalamount AS DECIMAL(12,1)) AS amount FROM order_text""",
        "cast_try": """WITH raw AS (SELECT p_partkey AS part_id, CASE p_type WHEN 'PROMO' THEN p_brand WHEN 'ECONOMY' THEN ''
  ELSE CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey AS VARCHAR) END AS raw FROM part)
SELECT part_id, CAST(TRY_CAST(raw AS DECIMAL(38,0)) AS BIGINT) AS as_number, TRY_CAST(raw AS DECIMAL(10,2)) AS as_price,
  TRY_CAST(raw AS DECIMAL(4,2)) AS as_rating, TRY_CAST(raw AS DECIMAL(12,0)) AS as_whole FROM raw""",
        "parse_dates": f"""WITH {CUSTOMER_TEXT} SELECT customerid, CAST(CAST(try_strptime(dob, '%Y-%m-%d') AS DATE) AS VARCHAR) AS dob,
  CAST(CAST(try_strptime(anniversary, '%Y-%m-%d') AS DATE) AS VARCHAR) AS anniversary FROM customer_text""",
        "parse_timestamps": """SELECT event_id,
  CASE WHEN event_type <> 'error' THEN CAST(date_trunc('second', ts) AS VARCHAR) END AS from_seconds,
  CAST(ts AS VARCHAR) AS from_nanos, CAST(ts AS VARCHAR) AS from_iso_micros,
  CAST(date_trunc('second', ts) AS VARCHAR) AS from_iso_seconds,
  CASE WHEN event_type <> 'error' THEN CAST(date_trunc('second', ts) AS VARCHAR) END AS from_any FROM events""",
        "clean_customer": f"WITH {CUSTOMER_TEXT} SELECT {CUSTOMER_COLS} FROM customer_text",
        "clean_menu": f"WITH {MENU_TEXT} SELECT * FROM menu_text",
        "clean_order_item": f"""SELECT CAST(l_linenumber AS BIGINT) AS order_item_id, l_orderkey AS order_id_fk,
  l_partkey AS menu_id_fk, CAST(l_quantity AS DECIMAL(10,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
  {NET} AS subtotal, CAST(l_shipdate AS VARCHAR) AS created_dt, CAST(l_shipdate AS VARCHAR) AS modified_dt
FROM lineitem WHERE year(l_shipdate) <> 2001""",
        "date_parts": f"SELECT o_orderkey, {_dates('o_orderdate')} FROM orders",
        "date_dim": f"WITH {DAYS} SELECT {_hk('d')} AS date_dim_hk, CAST(d AS VARCHAR) AS calendar_date, {_dates('d')} FROM days",
        "enrich_location": f"""WITH {_locations('customer')} SELECT CAST(locationid AS VARCHAR) AS locationid, city, state,
  state_code, is_union_territory, capital_city_flag, city_tier FROM located""",
        "mask_by_tag": f"""WITH {CUSTOMER_TEXT}, clean AS (SELECT {CUSTOMER_COLS} FROM customer_text)
SELECT * REPLACE ('** PII **' AS mobile, '** EMAIL **' AS email, '** PII **' AS gender, '** PII **' AS dob) FROM clean""",
        "check_tags": f"""WITH {CUSTOMER_TEXT}, clean AS (SELECT {CUSTOMER_COLS} FROM customer_text)
SELECT unnest(['mobile', 'email', 'gender', 'dob', 'anniversary']) AS column_name, unnest(['PII', 'EMAIL', 'PII', 'PII', 'SECRET']) AS tag,
  unnest([true, true, true, true, false]) AS allowed,
  unnest([count(mobile), count(email), count(gender), count(dob), count(anniversary)]) AS tagged_values FROM clean""",
        "mask_after_merge": f"""WITH parts AS (
  SELECT 'stage' AS part, c_custkey FROM customer WHERE NOT (c_mktsegment = 'BUILDING' AND c_acctbal > 5000)
  UNION ALL SELECT 'clean', c_custkey FROM customer
  UNION ALL SELECT 'changes', c_custkey FROM customer, range(CASE WHEN c_acctbal < 0 THEN 2 WHEN c_mktsegment = 'BUILDING' AND c_acctbal > 5000 THEN 1 ELSE 0 END)
  UNION ALL SELECT 'dimension', c_custkey FROM customer, range(CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END))
SELECT part, CAST(c_custkey AS VARCHAR) AS customer_id, '** PII **' AS mobile, '** EMAIL **' AS email, '** PII **' AS gender, '** PII **' AS dob FROM parts""",
        "merge_with_sk": f"""WITH {CUSTOMERS}, old AS (SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_sk FROM people)
SELECT o.customer_sk, o.customer_id, coalesce(n.name, o.name) AS name, coalesce(n.segment, o.segment) AS segment,
  coalesce(n.balance, o.balance) AS balance FROM old o LEFT JOIN next_day n USING (customer_id)
UNION ALL SELECT (SELECT count(*) FROM people) + row_number() OVER (ORDER BY customer_id), customer_id, name, segment, balance
FROM next_day WHERE customer_id NOT IN (SELECT customer_id FROM people)""",
        "hash_key": f"""WITH {CUSTOMER_TEXT} SELECT customerid, {_hk('customerid', 'name', 'anniversary')} AS hk,
  {_hk('loginbyusing', 'gender')} AS subset_hk, {_sha(['customerid', 'anniversary'])} AS wide_hk FROM customer_text""",
        "surrogate_key": f"""SELECT 1000 + row_number() OVER (ORDER BY {_hk('o_orderkey')} % 16, o_orderkey) AS order_sk,
  o_orderkey AS order_id, o_orderstatus AS status FROM orders""",
        "check_not_null": f"""WITH {_locations('customer')} SELECT unnest(['location_id', 'city', 'state', 'state_code', 'zip_code',
    'active_flag', 'created_ts', 'modified_ts']) AS column_name,
  unnest([0, 0, 0, count(*) FILTER (state_code IS NULL), 0, 0, 0, count(*)]) AS null_rows FROM located""",
        "check_length": f"""WITH {CUSTOMER_TEXT} SELECT unnest(['name', 'mobile', 'email', 'login_by_using', 'gender', 'preferences'])
    AS column_name, unnest([0, 0, 0, 0, 0, count(*) FILTER (length(preferences) > 22)]) AS too_long FROM customer_text""",
        "check_unique": """SELECT l_orderkey, l_linenumber, count(*) AS key_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "check_fk": f"""WITH calendar AS (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT 'menu' AS constraint_name, CAST(l_partkey AS VARCHAR) AS key, count(*) AS orphan_rows FROM lineitem
  WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') GROUP BY l_partkey
UNION ALL SELECT 'restaurant', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE CAST(s_acctbal AS DECIMAL(10,2)) < 0) GROUP BY l_suppkey
UNION ALL SELECT 'restaurant_location', CAST(s_nationkey AS VARCHAR), count(*) FROM supplier WHERE s_nationkey >= 20 GROUP BY s_nationkey
UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR), count(*) FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey
UNION ALL SELECT 'customer_address', CAST(o_custkey * 2 AS VARCHAR), count(*) FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {_nth(CITIES, 'c_nationkey')} = 'Mumbai') GROUP BY o_custkey
UNION ALL SELECT 'delivery_agent', CAST(agent AS VARCHAR), count(*) FROM (SELECT o_orderkey % (SELECT count(*) FROM supplier) AS agent FROM orders)
  WHERE agent NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey >= 5) GROUP BY agent
UNION ALL SELECT 'order_date', CAST(d AS VARCHAR), count(*) FROM calendar WHERE year(d) = 1998 GROUP BY d""",
        "layer_counts": """SELECT 'stage' AS layer, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'quarantine', count(*) FROM lineitem WHERE year(l_shipdate) = 2001
UNION ALL SELECT 'clean', count(DISTINCT (l_linenumber, l_orderkey, l_partkey)) FROM lineitem WHERE year(l_shipdate) <> 2001""",
        "merge_upsert": f"""WITH {CUSTOMER_TEXT}, after AS (
  SELECT * REPLACE (CASE WHEN c_acctbal < 0 THEN 'Google' ELSE loginbyusing END AS loginbyusing,
    CASE WHEN c_acctbal < 0 OR (loginbyusing = 'BUILDING' AND c_acctbal > 5000) THEN '2020-03-01T00:00:00' ELSE modifieddate END AS modifieddate)
  FROM customer_text) SELECT {CUSTOMER_COLS} FROM after""",
        "merge_changed_only": f"""WITH {_locations('supplier')} SELECT {LOCATION_COLS},
  CASE WHEN balance > 8000 THEN 'No' ELSE 'Yes' END AS active_flag, '2020-01-01 00:00:00' AS created_ts,
  CASE WHEN balance > 8000 THEN '2020-02-01 12:00:00' END AS modified_ts,
  CASE WHEN balance > 8000 THEN 'day-1.csv' ELSE 'initial.csv' END AS _stg_file_name FROM located""",
        "merge_partial_update": """SELECT o_orderkey AS order_id, o_custkey AS customer_id_fk, CAST(NULL AS BIGINT) AS restaurant_id_fk,
  CAST(o_orderdate AS VARCHAR) AS order_date,
  CAST(CAST(o_totalprice AS DECIMAL(10,2)) + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS total_amount,
  CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderstatus = 'P' THEN 'Card' ELSE o_orderpriority END AS payment_method,
  CAST(o_orderdate AS VARCHAR) AS created_dt,
  CASE WHEN o_orderstatus = 'P' THEN '2002-01-01 00:00:00' ELSE CAST(o_orderdate AS VARCHAR) END AS modified_dt FROM orders""",
        "merge_latest_per_key": f"""WITH {MENU_TEXT} SELECT * REPLACE (
  CAST(CASE WHEN item_type = 'Non-Veg' THEN price + 10 ELSE price END AS DECIMAL(10,2)) AS price,
  CASE WHEN item_type = 'Non-Veg' THEN '2020-02-01 00:00:00' ELSE modified_dt END AS modified_dt) FROM menu_text""",
        "merge_composite_key": f"""WITH items AS (SELECT {ITEM_COLS} FROM lineitem), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_item_id, order_id_fk, menu_id_fk
    ORDER BY modified_dt DESC, quantity DESC, price DESC, subtotal DESC) AS rn FROM items)
SELECT * EXCLUDE (rn) REPLACE (CAST(modified_dt AS VARCHAR) AS modified_dt) FROM ranked WHERE rn = 1""",
        "append_stream": "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events",
        "append_since": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
        "cdc_snapshot_diff": f"""WITH {CUSTOMERS}, pairs AS (
  SELECT p.customer_id AS old_id, n.customer_id AS new_id, p.name AS old_name, n.name AS new_name, p.segment AS old_segment,
    n.segment AS new_segment, p.balance AS old_balance, n.balance AS new_balance
  FROM people p FULL JOIN next_day n ON p.customer_id = n.customer_id
  WHERE p.customer_id IS NULL OR n.customer_id IS NULL OR p.segment <> n.segment)
SELECT 'DELETE' AS _action, new_id IS NOT NULL AS _is_update, old_id AS customer_id, old_name AS name, old_segment AS segment,
  old_balance AS balance FROM pairs WHERE old_id IS NOT NULL
UNION ALL SELECT 'INSERT', old_id IS NOT NULL, new_id, new_name, new_segment, new_balance FROM pairs WHERE new_id IS NOT NULL""",
        "cdc_inserts_only": f"""WITH {CUSTOMERS} SELECT 'INSERT' AS _action, false AS _is_update, n.* FROM next_day n
WHERE customer_id NOT IN (SELECT customer_id FROM people)""",
        "scd2_apply": f"WITH {CUSTOMER_DIM} SELECT * FROM dim",
        "dim_current": f"WITH {CUSTOMER_DIM} SELECT * FROM dim WHERE is_current",
        "scd2_multi_change": f"""WITH {_log()} SELECT {_hk('user_id', 'event_type', 'epoch_us(eff_start)')} AS hk, user_id, event_type,
  CAST(eff_start AS VARCHAR) AS eff_start, CAST(eff_end AS VARCHAR) AS eff_end, eff_end IS NULL AS is_current FROM dim""",
        "scd2_null_keys": f"WITH {CUSTOMER_DIM} SELECT * FROM dim WHERE customer_id NOT LIKE 'S%'",
        "scd2_match_subset": f"""WITH {_locations('supplier')}, rows AS (
  SELECT {_hk('city', 'state', 'state_code', 'zip_code')} AS restaurant_location_hk, {LOCATION_COLS}, balance FROM located)
SELECT * EXCLUDE (balance), 'Yes' AS active_flag, '{DAY_0}' AS eff_start,
  CASE WHEN balance > 8000 THEN '{DAY_1}' END AS eff_end, balance <= 8000 AS is_current FROM rows
UNION ALL SELECT * EXCLUDE (balance), 'No', '{DAY_1}', NULL, true FROM rows WHERE balance > 8000""",
        "scd2_insert_only": f"""WITH rows AS (SELECT p_partkey AS menu_id, p_name AS item_name, p_type AS category,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) - CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END AS DECIMAL(10,2)) AS price,
  CASE WHEN p_type = 'PROMO' THEN '{DAY_1}' ELSE '{DAY_0}' END AS eff_start, CAST(NULL AS VARCHAR) AS eff_end, true AS is_current FROM part)
SELECT {_hk('menu_id', 'item_name', 'category', 'price', STARTED)} AS menu_dim_hk, * FROM rows""",
        "scd2_from_log": f"""WITH {_log()} SELECT hk, user_id, event_type, CAST(eff_start AS VARCHAR) AS eff_start,
  CAST(eff_end AS VARCHAR) AS eff_end, eff_end IS NULL AS is_current FROM dim""",
        "dim_as_of": f"""WITH {_log("event_type <> 'purchase'")}
SELECT e.event_id, e.user_id, CAST(e.ts AS VARCHAR) AS ts, e.value, d.hk AS state_hk, d.event_type AS state
FROM events e LEFT JOIN dim d ON e.user_id = d.user_id AND e.ts >= d.eff_start AND (d.eff_end IS NULL OR e.ts < d.eff_end)
WHERE e.event_type = 'purchase'""",
        "fact_build": FACT,
        "fact_merge": FACT_LATEST.replace(f"{STATUS} AS delivery_status", "CASE o_orderstatus WHEN 'O' THEN 'Pending' ELSE 'Delivered' END AS delivery_status"),
        "fact_orphans": f"""WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY l_linenumber, l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
    CAST(l_quantity AS DECIMAL(10,2)) DESC, CAST(l_extendedprice AS DECIMAL(10,2)) DESC, {NET} DESC) AS rn FROM lineitem)
SELECT CAST(l_linenumber AS BIGINT) AS order_item_id, l_orderkey AS order_id, l_suppkey AS restaurant_id_fk, {NET} AS subtotal
FROM ranked JOIN supplier ON l_suppkey = s_suppkey WHERE rn = 1 AND CAST(s_acctbal AS DECIMAL(10,2)) < 0""",
        "fact_with_sk": f"""WITH f AS ({FACT_LATEST}) SELECT row_number() OVER (ORDER BY order_item_id, order_id) AS order_item_fact_sk,
  order_item_id, order_id, subtotal FROM f""",
        "yearly_revenue": _kpi("year"),
        "monthly_revenue": _kpi("year, month"),
        "daily_revenue": _kpi("year, month, day"),
        "weekday_revenue": _kpi("year, month, day_name", "true"),
        "restaurant_revenue": f"WITH {BY_RESTAURANT} SELECT * FROM kpis",
        "revenue_rollup": f"""WITH {_totals(DELIVERED)} SELECT year, month, day,
  CAST(grouping(year) * 4 + grouping(month) * 2 + grouping(day) AS INTEGER) AS grouping_level, {MEASURES}
FROM sales GROUP BY ROLLUP (year, month, day)""",
        "overall_totals": f"""WITH {YEARLY} SELECT CAST(sum(total_revenue) AS DECIMAL(18,2)) AS total_revenue,
  CAST(sum(total_orders) AS BIGINT) AS total_orders, max(max_order_value) AS max_order_value FROM kpis""",
        "latest_year_kpis": f"WITH {YEARLY} SELECT * FROM kpis WHERE year = (SELECT max(year) FROM kpis)",
        "yoy_delta": f"""WITH {YEARLY} SELECT k.*, k.total_revenue - p.total_revenue AS total_revenue_diff,
  k.total_orders - p.total_orders AS total_orders_diff,
  k.avg_revenue_per_order - p.avg_revenue_per_order AS avg_revenue_per_order_diff,
  k.avg_revenue_per_item - p.avg_revenue_per_item AS avg_revenue_per_item_diff,
  k.max_order_value - p.max_order_value AS max_order_value_diff
FROM kpis k LEFT JOIN kpis p ON p.year = k.year - 1""",
        "monthly_trend": f"""WITH {_totals(DELIVERED)} SELECT month, strftime(make_date(2000, month, 1), '%b') AS month_name,
  CAST(round(sum(subtotal), 0) AS DECIMAL(10,0)) AS total_revenue FROM sales WHERE year = 1997 GROUP BY month""",
        "distinct_months": f"WITH {BY_RESTAURANT} SELECT DISTINCT month FROM kpis WHERE year = 2001",
        "top10_restaurants": f"""WITH {BY_RESTAURANT} SELECT * EXCLUDE (year, month, delivery_status) FROM kpis
WHERE year = 1998 AND month = 3 ORDER BY total_revenue DESC, restaurant_name, delivery_status LIMIT 10""",
        "topk_per_month": f"""WITH {BY_RESTAURANT}, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY year, month
  ORDER BY total_revenue DESC, restaurant_name, delivery_status) AS INTEGER) AS rank FROM kpis) SELECT * FROM ranked WHERE rank <= 5""",
        "stream_upsert": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
        "bucket_delete": """SELECT o_orderkey AS order_id, o_custkey AS customer_id_fk, CAST(o_orderdate AS VARCHAR) AS order_date,
  CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount, o_orderstatus AS status, o_orderpriority AS payment_method
FROM orders WHERE o_orderstatus <> 'P'""",
        "stream_entity": f"""WITH {CUSTOMER_TEXT} SELECT customerid AS customer_id, login, login AS login_by_using, since, NULL AS reason FROM (
  SELECT customerid, CASE WHEN c_acctbal < 0 THEN 'Google' ELSE loginbyusing END AS login,
    CASE WHEN c_acctbal < 0 OR (loginbyusing = 'BUILDING' AND c_acctbal > 5000) THEN '{DAY_1}' ELSE '{DAY_0}' END AS since FROM customer_text)
UNION ALL SELECT NULL, NULL, NULL, NULL, 'customerid missing' FROM range(2)""",
        "stream_daily_revenue": """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS calendar_date,
  CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(18,2)) AS total_revenue, count(*) AS total_orders
FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    }
    return sql
