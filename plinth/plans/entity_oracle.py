"""SQL of the queries on single entities."""

from __future__ import annotations

from plinth.plans import oracle as O

_ADDRESSES = f"""addresses AS (
  SELECT c_custkey * 2 + n AS address_id, c_custkey AS customer_id_fk, 'F' || c_nationkey AS flat_no,
    CAST(c_custkey AS VARCHAR) AS house_no, CAST(c_nationkey AS VARCHAR) AS floor, c_mktsegment AS building,
    'old tree' AS landmark, CAST(NULL AS VARCHAR) AS locality, {O._nth(O.CITIES, "c_nationkey")} AS city,
    {O._nth(O.STATES, "c_nationkey")} AS state, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS pincode,
    '12,' || c_nationkey AS coordinates, CASE n WHEN 0 THEN 'Yes' ELSE 'No' END AS primary_flag,
    CASE n WHEN 0 THEN 'Home' ELSE 'Office' END AS address_type, n, c_acctbal, c_mktsegment
  FROM customer, (SELECT unnest([0, 1]) AS n) WHERE n = 0 OR c_acctbal > 5000),
valid_addresses AS (SELECT * FROM addresses WHERE n = 0 OR c_mktsegment <> 'MACHINERY')"""
_AGENTS = """agents AS (
  SELECT s_suppkey AS delivery_agent_id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance, 0 AS n FROM supplier
  UNION ALL SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal, 1 FROM customer WHERE c_acctbal > 9000),
agent_rows AS (
  SELECT delivery_agent_id, name, '7' || lpad(CAST(delivery_agent_id AS VARCHAR), 10, '0') AS phone,
    CASE WHEN nation < 12 THEN 'Bike' ELSE 'Scooter' END AS vehicle_type, CAST(nation + 1 AS BIGINT) AS location_id_fk,
    'Active' AS status, CAST(NULL AS VARCHAR) AS gender, CAST(nation % 5 + 0.5 AS DECIMAL(4,2)) AS rating, balance, n FROM agents)"""
_RESTAURANTS = """restaurants AS (
  SELECT s_suppkey AS restaurant_id, s_name AS name, 'cuisine ' || s_nationkey AS cuisine_type,
    CAST(s_acctbal AS DECIMAL(10,2)) AS pricing_for_two, '080' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS restaurant_phone,
    '10 AM - 11 PM' AS operating_hours, CAST(s_nationkey + 1 AS BIGINT) AS location_id_fk, 'Yes' AS active_flag,
    'Open' AS open_status, CAST(NULL AS VARCHAR) AS locality, s_name || ', street ' || s_nationkey AS restaurant_address,
    CAST('12.' || lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS DECIMAL(9,6)) AS latitude,
    CAST('-77.' || lpad(CAST(s_nationkey AS VARCHAR), 6, '0') AS DECIMAL(9,6)) AS longitude, s_acctbal
  FROM supplier)"""
_RESTAURANT = ["restaurant_id", "name", "cuisine_type", "pricing_for_two", "restaurant_phone", "operating_hours", "location_id_fk",
               "active_flag", "open_status", "locality", "restaurant_address", "latitude", "longitude"]
_ADDRESS = ["address_id", "customer_id_fk", "flat_no", "house_no", "floor", "building", "landmark", "locality", "city", "state",
            "pincode", "coordinates", "primary_flag", "address_type"]
_AGENT = ["delivery_agent_id", "name", "phone", "vehicle_type", "location_id_fk", "status", "gender", "rating"]


def _versions(hk: str, columns: list[str]) -> str:
    """Versions from a table ``rows`` that also has eff_start and eff_end."""
    return f"""SELECT {O._hk(*columns, O.STARTED)} AS {hk}, {", ".join(columns)}, eff_start, eff_end, eff_end IS NULL AS is_current FROM rows"""


def statements() -> dict[str, str]:
    started = f"CASE n WHEN 0 THEN '{O.DAY_0}' ELSE '{O.DAY_1}' END AS eff_start, CAST(NULL AS VARCHAR) AS eff_end"
    moved, changed = "n = 0 AND c_acctbal < 0", "n = 0 AND balance < 0"
    return {
        "merge_customer_address": f"""WITH {_ADDRESSES}
SELECT * EXCLUDE (n, c_acctbal, c_mktsegment) REPLACE (CASE WHEN {moved} THEN 'new bridge' ELSE landmark END AS landmark),
  '2020-01-01 08:30:00.5' AS created_date,
  CASE WHEN {moved} THEN '2020-03-01 00:00:00' ELSE '2020-01-01 08:30:00.5' END AS modified_date FROM valid_addresses""",
        "merge_delivery_agent": f"""WITH {_AGENTS}
SELECT * EXCLUDE (n, balance) REPLACE (CAST(CASE WHEN {changed} THEN 1.25 ELSE rating END AS DECIMAL(4,2)) AS rating),
  '2020-01-01 00:00:00' AS created_dt, CASE WHEN {changed} THEN '2020-02-01 00:00:00' ELSE '2020-01-01 00:00:00' END AS modified_dt
FROM agent_rows""",
        "merge_delivery": f"""WITH first AS (
  SELECT o_orderkey AS delivery_id, o_orderkey AS order_id_fk, o_orderkey % 97 AS delivery_agent_id_fk,
    {O.STATUS} AS delivery_status, o_orderpriority AS estimated_time, o_custkey * 2 AS customer_address_id_fk,
    CAST(o_orderdate AS VARCHAR) AS delivery_date, CAST(o_orderdate AS VARCHAR) AS created_date,
    CAST(o_orderdate AS VARCHAR) AS modified_date FROM orders)
SELECT * REPLACE (CASE delivery_status WHEN 'In Transit' THEN 'Delivered' ELSE delivery_status END AS delivery_status,
  CASE delivery_status WHEN 'In Transit' THEN '2002-01-01 00:00:00' ELSE modified_date END AS modified_date) FROM first
UNION ALL SELECT * REPLACE (delivery_agent_id_fk + 1 AS delivery_agent_id_fk, '2002-01-01 00:00:00' AS modified_date) FROM first
WHERE delivery_status = 'Pending' AND estimated_time = '1-URGENT'""",
        "quarantine_entities": f"""WITH {_ADDRESSES}
SELECT 'customer_address' AS entity, 'x' || address_id AS id, 'addressid is not a decimal' AS _reason
FROM addresses WHERE n = 1 AND c_mktsegment = 'MACHINERY'
UNION ALL SELECT 'delivery', CAST(o_orderkey AS VARCHAR), 'deliverydate is not a timestamp' FROM orders
WHERE o_orderstatus = 'O' AND o_orderpriority = '5-LOW'""",
        "dim_restaurant": f"""WITH {_RESTAURANTS}, rows AS (
  SELECT * EXCLUDE (s_acctbal), CASE WHEN s_acctbal > 8000 THEN '{O.DAY_1}' ELSE '{O.DAY_0}' END AS eff_start,
    CASE WHEN s_acctbal < 0 THEN '{O.DAY_1}' END AS eff_end FROM restaurants
  UNION ALL SELECT * EXCLUDE (s_acctbal) REPLACE (CAST(NULL AS DECIMAL(10,2)) AS pricing_for_two, 'Closed' AS open_status), '{O.DAY_1}', NULL
  FROM restaurants WHERE s_acctbal < 0) {_versions("restaurant_hk", _RESTAURANT)}""",
        "dim_customer_address": f"""WITH {_ADDRESSES}, rows AS (SELECT *, {started} FROM valid_addresses)
{_versions("customer_address_hk", _ADDRESS)}""",
        "dim_delivery_agent": f"""WITH {_AGENTS}, rows AS (SELECT *, {started} FROM agent_rows)
{_versions("delivery_agent_hk", _AGENT)}""",
    }
