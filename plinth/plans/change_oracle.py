"""SQL of the queries on changes."""

from __future__ import annotations

from plinth.plans import oracle as O

_RANKED = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_linenumber, l_orderkey ORDER BY l_shipdate DESC,
    l_partkey DESC, l_suppkey DESC, CAST(l_quantity AS DECIMAL(10,2)) DESC, CAST(l_extendedprice AS DECIMAL(10,2)) DESC, {O.NET} DESC) AS rn
  FROM lineitem) WHERE rn = 1)"""


def _sales(where: str = "true", status: str = O.STATUS) -> str:
    return O._totals(where).replace("FROM lineitem JOIN", f"FROM {_RANKED} JOIN").replace(
        f"{O.STATUS} AS delivery_status", f"{status} AS delivery_status"
    )


_AFTER = _sales(
    "NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')", "CASE o_orderstatus WHEN 'O' THEN 'Pending' ELSE 'Delivered' END"
)
_KEYS = ["year", "month", "day", "day_name", "delivery_status", "restaurant_name"]


def _view(name: str, keys: list[str], source: str, where: str = "true") -> str:
    columns = ", ".join(k if k in keys else f"NULL AS {k}" for k in _KEYS)
    return f"SELECT '{name}' AS view, {columns}, {O.MEASURES} FROM {source} WHERE {where} GROUP BY {', '.join(keys)}"


def _kpi_views() -> str:
    done = "delivery_status = 'Delivered'"
    views = [
        _view("yearly", ["year"], "sales", done), _view("monthly", ["year", "month"], "sales", done),
        _view("daily", ["year", "month", "day"], "sales", done), _view("weekday", ["year", "month", "day_name"], "sales"),
        _view("restaurant", ["year", "month", "delivery_status", "restaurant_name"], "named"),
    ]
    return f"WITH {_AFTER}, named AS (SELECT s.*, s_name AS restaurant_name FROM sales s JOIN supplier ON l_suppkey = s_suppkey) " + " UNION ALL ".join(views)


_STATE = """SELECT user_id, event_type FROM (
  SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts < TIMESTAMP '{until}') WHERE rn = 1 AND event_type <> 'error'"""


def statements() -> dict[str, str]:
    base = O.statements()
    return {
        "merge_with_deletes": f"""WITH {O.CUSTOMERS} SELECT customer_id, name, CASE WHEN balance > 9800 THEN 'BACK' ELSE segment END AS segment,
  balance, CASE WHEN balance > 9800 THEN '1999-01-01 00:00:00' WHEN balance > 9500 THEN '{O.DAY_1}' ELSE '{O.DAY_0}' END AS modified,
  balance > 9500 AND balance <= 9800 AS _gone FROM people""",
        "merge_by_digest": f"""WITH {O._locations('supplier')} SELECT a.action AS _action, true AS _is_update, {O.LOCATION_COLS},
  a.flag AS active_flag, '2020-01-01 00:00:00' AS created_ts, a.modified AS modified_ts
FROM located, (VALUES ('DELETE', 'Yes', NULL), ('INSERT', 'No', '2020-02-01 12:00:00')) AS a(action, flag, modified) WHERE balance > 8000""",
        "cdc_net_changes": f"""WITH p AS ({_STATE.format(until='2024-01-15 00:00:00')}), n AS ({_STATE.format(until='2100-01-01 00:00:00')}),
pairs AS (SELECT p.user_id AS old_id, n.user_id AS new_id, p.event_type AS old_type, n.event_type AS new_type
  FROM p FULL JOIN n ON p.user_id = n.user_id WHERE p.event_type IS DISTINCT FROM n.event_type)
SELECT 'DELETE' AS _action, new_id IS NOT NULL AS _is_update, old_id AS user_id, old_type AS event_type FROM pairs WHERE old_id IS NOT NULL
UNION ALL SELECT 'INSERT', old_id IS NOT NULL, new_id, new_type FROM pairs WHERE new_id IS NOT NULL""",
        "scd2_late": base["scd2_from_log"],
        "fact_delete": O.FACT_LATEST.replace(
            f"{O.STATUS} AS delivery_status",
            f"CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'Delivered' ELSE {O.STATUS} END AS delivery_status",
        ).replace("o_orderpriority AS estimated_time", "o_orderpriority AS estimated_time, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date")
        + " WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')",
        "kpi_incremental": _kpi_views(),
        "restaurant_cube": f"""WITH {_sales()}, named AS (SELECT s.*, s_name AS restaurant_name FROM sales s JOIN supplier ON l_suppkey = s_suppkey)
SELECT year, month, restaurant_name, CAST(grouping(year) * 4 + grouping(month) * 2 + grouping(restaurant_name) AS INTEGER) AS grouping_level,
  CAST(sum(subtotal) AS DECIMAL(18,2)) AS total_revenue, count(DISTINCT order_id) AS total_orders, max(subtotal) AS max_order_value
FROM named GROUP BY CUBE (year, month, restaurant_name)""",
        "period_report": f"WITH {_sales(O.DELIVERED)} SELECT year, month, day, {O.MEASURES} FROM sales WHERE year = 1997 AND month = 3 GROUP BY year, month, day",
        "fact_bucketed": O.FACT,
        "checks_on_load": f"""WITH {O.ITEM_TEXT}, n AS (SELECT count(*) AS n, count(*) FILTER (length(quantity) > 4) AS long_ones,
  count(*) FILTER (quantity LIKE 'x%') AS odd, count(*) FILTER (CAST(price AS DECIMAL(10,2)) > 90000) AS dear FROM item_text)
SELECT unnest(['rows', 'null orderid', 'null menuid', 'too long quantity', 'dear', 'not castable orderitemid', 'not castable orderid',
    'not castable menuid', 'not castable quantity', 'not castable price', 'not castable subtotal', 'not castable createddate',
    'not castable modifieddate']) AS check_name,
  unnest([n, 0, 0, long_ones, dear, 0, 0, 0, odd, 0, 0, 0, 0]) AS row_count FROM n""",
        "reconcile_layers": f"""WITH {O.CUSTOMERS}, clean AS (
  SELECT customer_id, CAST(balance + CASE WHEN segment = 'MACHINERY' THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS balance
  FROM people WHERE segment <> 'BUILDING' UNION ALL SELECT customer_id, balance FROM next_day WHERE segment = 'SUPPLIER')
SELECT 'stage to clean' AS step, customer_id, CASE WHEN segment = 'BUILDING' THEN 'lost' ELSE 'changed' END AS difference
FROM people WHERE segment IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'stage to clean', customer_id, 'added' FROM next_day WHERE segment = 'SUPPLIER'
UNION ALL SELECT 'clean to dimension', customer_id, 'lost' FROM clean WHERE balance < 0""",
        "stream_landing": f"""WITH {O.ORDER_TEXT} SELECT orderid, customerid, orderdate, totalamount, status, true AS has_key,
  CASE WHEN customerid LIKE '%7' THEN 'more fields than columns' END AS reason FROM order_text""",
        "stream_kpis": f"WITH {_sales("o_orderstatus IN ('F', 'P')")} SELECT year, month, day, {O.MEASURES} FROM sales GROUP BY year, month, day",
    }
