"""DuckDB SQL twins of ``footfall.plans.catalog`` queries.

Windows are integer arithmetic on epoch microseconds (``us // size * size``),
which is what ``F.window`` computes for windows aligned to the epoch.
``arg_max_null`` is DuckDB's ``max_by`` (null values kept, null orderings
skipped). Sums are cast back to BIGINT (DuckDB widens them to HUGEINT).
"""

from __future__ import annotations

from footfall import settings as S

M10, M15, M20, M30 = 600_000_000, 900_000_000, 1_200_000_000, 1_800_000_000
H2 = 7_200_000_000
US = 1_000_000


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _readings(spread: bool = False, grouped: bool = True) -> str:
    extra = (" + 60 * (user_id % 5)" if grouped else "") + (" + 120 * (user_id % 3)" if spread else "")
    return f"""readings AS (
  SELECT event_id AS id, ts AS arrival, epoch_us(ts) AS arrival_us,
         CAST(1 + event_id % 4 AS INTEGER) AS zone,
         'S' || CAST(user_id % 10 AS VARCHAR) AS sensor_uid,
         'M' || CAST(user_id % 20 AS VARCHAR) AS mac,
         CAST(40419373 + (event_id * 37) % 627 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS latitude,
         CAST(-3705999 + (event_id * 53) % 925 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS longitude,
         CAST(epoch(date_trunc('day', ts)) AS BIGINT){extra} AS ts
  FROM events)"""


PURCHASES = """purchases AS (
  SELECT event_id AS id, ts AS arrival, epoch_us(ts) AS arrival_us,
         CASE WHEN event_id % 2 = 0 THEN 'POS1' ELSE 'POS2' END AS pos,
         'Seller_' || CAST(1 + user_id % 4 AS VARCHAR) AS seller_name,
         CAST(1 + user_id % 29 AS BIGINT) AS productid,
         event_type AS product_category,
         CAST((event_id * 17) % 101 AS INTEGER) AS available_stock,
         CASE WHEN user_id % 3 = 0 THEN 'Cash' WHEN user_id % 3 = 1 THEN 'Mobile Payment'
              ELSE 'Credit Card' END AS payment_method,
         CAST(floor(value) AS INTEGER) AS amount,
         CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS ts
  FROM events)"""


def _date(expr: str) -> str:
    return f"strftime(make_timestamp(CAST({expr} AS BIGINT) * 1000000), '%m/%d/%Y %H:%M:%S')"


def _win(size: int, ws: str = "ws") -> str:
    return f"{ws} // {US} AS window_start, ({ws} + {size}) // {US} AS window_end"


def _doc_id(index: str, *parts: str) -> str:
    items = [_q(index)] + [f"coalesce(CAST({p} AS VARCHAR), '<null>')" for p in parts]
    return f"sha256(concat_ws('|', {', '.join(items)}))"


# Fixed values, written out here so that they do not come from the code under test.
AREA = """CASE
  WHEN latitude > 40.419890e0 AND latitude <= 40.419999e0 AND longitude > -3.705689e0 AND longitude <= -3.705075e0 THEN 'Zone1-Area3-Mango'
  WHEN latitude > 40.419643e0 AND latitude <= 40.419890e0 AND longitude > -3.705689e0 AND longitude <= -3.705381e0 THEN 'Zone1-Area2-H&M'
  WHEN latitude >= 40.419373e0 AND latitude < 40.419643e0 AND longitude >= -3.705999e0 AND longitude < -3.705689e0 THEN 'Zone1-Area1-Zara'
  END"""
OFFER = "'Up to 70% Off on Kids Wear at H&M'"
SENDER = "'Mall Discounts'"
NO_JAM = "'No sign of Traffic Jam at this moment'"
REORDER = "'Item is below the System Quantity, needs REORDERING'"
SUFFICIENT = "'Item Quantity is sufficient'"
LAST = "(arrival, id)"

# --- foot traffic --------------------------------------------------------------

def _running(grouped: bool = True) -> str:
    return f"""WITH {_readings(grouped=grouped)},
running AS (
  SELECT id, arrival, arrival_us, zone, sensor_uid, ts,
         first_value(ts) OVER (PARTITION BY zone, sensor_uid ORDER BY arrival, id) AS first_ts,
         row_number() OVER (PARTITION BY zone, sensor_uid ORDER BY arrival, id) AS visitors
  FROM readings WHERE zone IN (1, 2, 3))"""


RUNNING = _running()


def _j12_cte(running: str = RUNNING) -> str:
    return running + f""",
k10 AS (SELECT zone, arrival_us // {M10} * {M10} AS ws, first_ts, count(*) AS n
        FROM running WHERE zone IN (1, 2) GROUP BY ALL),
j12 AS (
  SELECT a.ws, a.first_ts AS timestamp, a.n AS readings_zone1, b.n AS readings_zone2,
         a.n * b.n AS documents
  FROM k10 a JOIN k10 b ON a.ws = b.ws AND a.first_ts = b.first_ts
  WHERE a.zone = 1 AND b.zone = 2)"""


def _j123_cte(running: str = RUNNING) -> str:
    return _j12_cte(running) + f""",
left20 AS (
  SELECT (ws + {M10}) // {M20} * {M20} AS ws, timestamp, CAST(sum(documents) AS BIGINT) AS pairs_12
  FROM j12 GROUP BY ALL),
k20 AS (SELECT arrival_us // {M20} * {M20} AS ws, first_ts, count(*) AS n
        FROM running WHERE zone = 3 GROUP BY ALL),
j123 AS (
  SELECT l.ws, l.timestamp, l.pairs_12, r.n AS readings_zone3, l.pairs_12 * r.n AS documents
  FROM left20 l JOIN k20 r ON l.ws = r.ws AND l.timestamp = r.first_ts)"""


def _factors_cte(running: str = RUNNING) -> str:
    return _j123_cte(running) + f""",
rng10 AS (
  SELECT zone, arrival_us // {M10} * {M10} AS jws, first_ts AS timestamp, sensor_uid,
         min(visitors) AS visitors_from, max(visitors) AS visitors_to
  FROM running WHERE zone IN (1, 2) GROUP BY ALL),
rng20 AS (
  SELECT zone, arrival_us // {M20} * {M20} AS jws, first_ts AS timestamp, sensor_uid,
         min(visitors) AS visitors_from, max(visitors) AS visitors_to
  FROM running WHERE zone = 3 GROUP BY ALL),
live12 AS (
  SELECT j.ws AS w10, j.timestamp, (j.ws + {M10}) // {M20} * {M20} AS w20 FROM j12 j
  WHERE EXISTS (SELECT 1 FROM j123 d
                WHERE d.ws = (j.ws + {M10}) // {M20} * {M20} AND d.timestamp = j.timestamp)),
factors AS (
  SELECT l.w20 AS ws, r.timestamp, r.zone, r.jws, r.jws + {M10} AS jwe, r.sensor_uid,
         r.visitors_from, r.visitors_to
  FROM rng10 r JOIN live12 l ON r.jws = l.w10 AND r.timestamp = l.timestamp
  UNION ALL
  SELECT r.jws AS ws, r.timestamp, r.zone, r.jws, r.jws + {M20} AS jwe, r.sensor_uid,
         r.visitors_from, r.visitors_to
  FROM rng20 r
  WHERE EXISTS (SELECT 1 FROM j123 d WHERE d.ws = r.jws AND d.timestamp = r.timestamp))"""


# --- proximity -------------------------------------------------------------------

PROX = f"""WITH {_readings(spread=True)},
classified AS (
  SELECT *, {AREA} AS area, arrival_us // {M30} * {M30} AS ws FROM readings WHERE zone = 1),
prox AS (
  SELECT ws, ts, coalesce(arg_max_null(area, {LAST}) FILTER (WHERE area IS NOT NULL), '') AS area,
         count(area) AS visitors
  FROM classified GROUP BY ws, ts)"""

JAM = PROX + f""",
jam AS (
  SELECT (ws + {M30}) // {M20} * {M20} AS jws, area,
         arg_max_null(visitors, (ws + {M30}, ts)) AS visitors
  FROM prox GROUP BY ALL)"""

CROWD = 2  # the test tables' crowd threshold (see catalog.TEST_SETTINGS)


def _jam_label(col: str) -> str:
    return (f"CASE WHEN {col} >= {CROWD} THEN {OFFER} "
            f"ELSE {NO_JAM} END")


def _stock_label(col: str) -> str:
    return f"CASE WHEN {col} < 30 THEN {REORDER} ELSE {SUFFICIENT} END"


ALERTS = PROX + f""",
alerts AS (
  SELECT ws, ts, area, visitors, {OFFER} AS message, {SENDER} AS sender
  FROM prox WHERE visitors >= {CROWD})"""

# --- in-store ----------------------------------------------------------------------


def _pos_window(pos: str | None, size: int) -> str:
    where = f"WHERE pos = '{pos}'" if pos else ""
    return f"""WITH {PURCHASES},
b AS (SELECT *, arrival_us // {size} * {size} AS ws FROM purchases {where})"""


CATEGORY = _pos_window("POS2", M15) + """,
cat AS (
  SELECT ws, product_category AS category, arg_max_null(ts, (arrival, id)) AS last_ts,
         count(*) AS total_sales
  FROM b GROUP BY ws, product_category)"""

PAYMENT = _pos_window("POS1", M15) + """,
pay AS (SELECT ws, payment_method, count(*) AS count FROM b GROUP BY ws, payment_method)"""

STOCK = _pos_window("POS1", M15) + """,
stock AS (
  SELECT ws, productid, arg_max_null(available_stock, (arrival, id)) AS stock_check
  FROM b GROUP BY ws, productid)"""

SALES = _pos_window("POS2", M30) + """,
sales AS (
  SELECT ws, product_category AS category, arg_max_null(ts, (arrival, id)) AS last_ts,
         arg_max_null(amount, (arrival, id)) AS total_sales
  FROM b GROUP BY ws, product_category)"""


ORACLE: dict[str, str] = {
    "running_visitors": RUNNING + """
SELECT id, zone, sensor_uid, ts, first_ts, visitors FROM running""",

    "running_visitors_resumed": RUNNING + """
SELECT id, zone, sensor_uid, ts, first_ts, visitors FROM running""",

    "foot_traffic_window_join_12": _j12_cte() + f"""
SELECT {_win(M10)}, timestamp, readings_zone1, readings_zone2, documents FROM j12""",

    "foot_traffic_as_coded": _j123_cte() + f"""
SELECT {_win(M20)}, timestamp, pairs_12, readings_zone3, documents FROM j123""",

    "foot_traffic_factors": _factors_cte() + f"""
SELECT {_win(M20)}, timestamp, zone, jws // {US} AS join_window_start, jwe // {US} AS join_window_end,
       sensor_uid, visitors_from, visitors_to
FROM factors""",

    "foot_traffic_intended": f"""WITH {_readings()},
dev AS (
  SELECT arrival_us // {H2} * {H2} AS ws, zone, mac FROM readings
  WHERE zone IN (1, 2, 3) AND mac IS NOT NULL GROUP BY ALL)
SELECT {_win(H2)},
       count(*) FILTER (WHERE zone = 1) AS visitors_zone1,
       count(*) FILTER (WHERE zone = 2) AS visitors_zone2,
       count(*) FILTER (WHERE zone = 3) AS visitors_zone3
FROM dev GROUP BY ws""",

    "classify_area": f"""WITH {_readings()}
SELECT id, zone, latitude, longitude, {AREA} AS area FROM readings""",

    "unique_devices_by_week": f"""WITH {_readings()}
SELECT CAST(epoch(date_trunc('week', arrival)) AS BIGINT) AS week_start, zone, count(*) AS readings, count(DISTINCT mac) AS devices
FROM readings GROUP BY ALL""",

    "classify_by_table": f"""WITH {_readings()},
steps AS (
  SELECT o_orderkey AS k, 40419373 + (o_orderkey * 17) % 627 AS lat, -3705999 + (o_orderkey * 29) % 925 AS lon,
         CASE WHEN o_orderkey % 500 = 0 THEN 200 + o_orderkey % 7 ELSE o_orderkey % 6 END AS high,
         CASE WHEN o_orderkey % 500 = 0 THEN 300 + o_orderkey % 11 ELSE o_orderkey % 9 END AS wide
  FROM orders),
boxes AS (
  SELECT k, lat / 1e6 AS a, (lat + high) / 1e6 AS b, lon / 1e6 AS c, (lon + wide) / 1e6 AS d FROM steps),
met AS (
  SELECT r.id, max(k) AS k FROM readings r JOIN boxes ON latitude BETWEEN a AND b AND longitude BETWEEN c AND d
  WHERE (k % 2 = 0 OR latitude > a) AND (k % 3 = 0 OR latitude < b) AND (k % 5 <> 0 OR longitude > c) AND (k % 7 <> 0 OR longitude < d)
  GROUP BY r.id)
SELECT id, latitude, longitude, CASE WHEN k IS NOT NULL THEN 'Shop' || CAST(k AS VARCHAR) END AS area
FROM readings LEFT JOIN met USING (id)""",

    "proximity_traffic_as_coded": PROX + f"""
SELECT {_win(M30)}, ts, area, visitors FROM prox""",

    "proximity_traffic_intended": PROX + f"""
SELECT {_win(M30)}, area, count(*) AS visitors FROM classified WHERE area IS NOT NULL
GROUP BY ws, area""",

    "traffic_jam_as_coded": JAM + f"""
SELECT {_win(M20, 'jws')}, visitors, area, {_jam_label('visitors')} AS observation FROM jam""",

    "offer_alerts": ALERTS + f"""
SELECT {_win(M30)}, ts, area, visitors, message, sender FROM alerts""",

    "offer_recipients": ALERTS + f"""
SELECT {_win(M30, 'c.ws')}, c.ts, c.area, c.mac, first(a.message) AS message
FROM classified c JOIN alerts a ON c.ws = a.ws AND c.ts = a.ts AND c.area = a.area
WHERE c.area IS NOT NULL
GROUP BY c.ws, c.ts, c.area, c.mac""",

    "capture_rate": f"""WITH {_readings()},
dev AS (
  SELECT arrival_us // {H2} * {H2} AS ws, mac, {AREA} AS area FROM readings WHERE zone = 1
  GROUP BY ALL),
z AS (SELECT ws, count(DISTINCT mac) AS zone_devices FROM dev GROUP BY ws),
a AS (SELECT ws, area, count(mac) AS area_devices FROM dev WHERE area IS NOT NULL GROUP BY ws, area)
SELECT {_win(H2, 'a.ws')}, a.area, a.area_devices, z.zone_devices,
       a.area_devices / z.zone_devices AS capture_rate
FROM a JOIN z ON a.ws = z.ws""",

    "category_count": CATEGORY + f"""
SELECT {_win(M15)}, category, {_date('last_ts')} AS date, total_sales FROM cat""",

    "payment_method_count": PAYMENT + f"""
SELECT {_win(M15)}, payment_method, count FROM pay""",

    "stock_availability": STOCK + f"""
SELECT {_win(M15)}, productid, stock_check, {_stock_label('stock_check')} AS observation FROM stock""",

    "total_sales_as_coded": SALES + f"""
SELECT {_win(M30)}, {_date('last_ts')} AS date, total_sales FROM sales""",

    "total_sales_intended": _pos_window("POS2", M30) + f"""
SELECT {_win(M30)}, product_category AS category,
       {_date('arg_max_null(ts, (arrival, id))')} AS date,
       CAST(sum(amount) AS BIGINT) AS total_sales, count(*) AS sales
FROM b GROUP BY ws, product_category""",

    "most_used_payment_method": PAYMENT + f"""
SELECT {_win(M15)}, arg_min_null(payment_method, (-count, payment_method)) AS payment_method,
       max(count) AS count, CAST(sum(count) AS BIGINT) AS purchases
FROM pay GROUP BY ws""",

    "underperforming_categories": _pos_window("POS2", M15) + f""",
c AS (SELECT ws, product_category, count(*) AS sales, CAST(sum(amount) AS BIGINT) AS amount
      FROM b GROUP BY ws, product_category),
r AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY sales NULLS FIRST, amount NULLS FIRST,
                                   product_category NULLS FIRST) AS rank FROM c)
SELECT {_win(M15)}, product_category AS category, sales, amount, rank FROM r WHERE rank <= 2""",

    "underperforming_category": _pos_window("POS2", M15) + f""",
c AS (SELECT ws, product_category, count(*) AS sales, CAST(sum(amount) AS BIGINT) AS amount
      FROM b GROUP BY ws, product_category),
r AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY sales NULLS FIRST, amount NULLS FIRST,
                                   product_category NULLS FIRST) AS rank FROM c)
SELECT {_win(M15)}, product_category AS category, sales, amount, rank FROM r WHERE rank = 1""",

    "sale_sessions": f"""WITH {PURCHASES},
g AS (
  SELECT *, CASE WHEN lag(arrival_us) OVER w IS NULL
                   OR arrival_us - lag(arrival_us) OVER w > {M10} THEN 1 ELSE 0 END AS new_session
  FROM purchases WINDOW w AS (PARTITION BY seller_name ORDER BY arrival_us, id)),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY seller_name ORDER BY arrival_us, id) AS sid FROM g)
SELECT min(arrival_us) AS session_start, max(arrival_us) + {M10} AS session_end, seller_name,
       count(*) AS purchases, CAST(sum(amount) AS BIGINT) AS amount,
       min(arrival_us) AS first_arrival, max(arrival_us) AS last_arrival
FROM s GROUP BY seller_name, sid""",

    "instore_shared": f"""WITH {PURCHASES},
p15 AS (SELECT *, arrival_us // {M15} * {M15} AS ws FROM purchases),
p30 AS (SELECT *, arrival_us // {M30} * {M30} AS ws FROM purchases)
SELECT 'category' AS kind, {_win(M15)}, product_category AS key, count(*) AS count, {_date('arg_max_null(ts, (arrival, id))')} AS date,
       CAST(NULL AS INTEGER) AS total_sales, CAST(NULL AS INTEGER) AS stock_check, CAST(NULL AS VARCHAR) AS observation
FROM p15 WHERE pos = 'POS2' GROUP BY ws, product_category
UNION ALL
SELECT 'sales', {_win(M30)}, product_category, NULL, {_date('arg_max_null(ts, (arrival, id))')}, arg_max_null(amount, (arrival, id)), NULL, NULL
FROM p30 WHERE pos = 'POS2' GROUP BY ws, product_category
UNION ALL
SELECT 'payment', {_win(M15)}, payment_method, count(*), NULL, NULL, NULL, NULL FROM p15 WHERE pos = 'POS1' GROUP BY ws, payment_method
UNION ALL
SELECT 'stock', {_win(M15)}, CAST(productid AS VARCHAR), NULL, NULL, NULL, arg_max_null(available_stock, (arrival, id)),
       {_stock_label('arg_max_null(available_stock, (arrival, id))')}
FROM p15 WHERE pos = 'POS1' GROUP BY ws, productid""",

    "items_by_shop": f"""WITH {PURCHASES}
SELECT seller_name, product_category, count(*) AS items, CAST(sum(amount) AS BIGINT) AS amount,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM purchases GROUP BY seller_name, product_category""",

    "customer_journey": f"""WITH {_readings()},
inside AS (SELECT mac, arrival_us, id, {AREA} AS area FROM readings WHERE zone = 1),
lagged AS (
  SELECT *, lag(area) OVER (PARTITION BY mac ORDER BY arrival_us, id) AS prev_area
  FROM inside WHERE area IS NOT NULL),
entries AS (SELECT * FROM lagged WHERE prev_area IS NULL OR prev_area <> area)
SELECT mac, row_number() OVER (PARTITION BY mac ORDER BY arrival_us, id) AS visit_no, area, prev_area,
       arrival_us AS entered_at, id
FROM entries""",

    "visit_history": f"""WITH {_readings()}
SELECT mac, count(*) AS readings, count(DISTINCT date_trunc('day', arrival)) AS days_seen,
       count(DISTINCT zone) AS zones_seen, min(arrival_us) AS first_seen, max(arrival_us) AS last_seen
FROM readings GROUP BY mac""",

    "sales_conversion": f"""WITH {_readings()}, {PURCHASES},
v AS (SELECT ws, count(*) AS visitors FROM (
        SELECT arrival_us // {H2} * {H2} AS ws, mac FROM readings WHERE mac IS NOT NULL GROUP BY ALL)
      GROUP BY ws),
p AS (SELECT arrival_us // {H2} * {H2} AS ws, count(*) AS purchases, CAST(sum(amount) AS BIGINT) AS amount
      FROM purchases GROUP BY ALL),
j AS (SELECT coalesce(v.ws, p.ws) AS ws, v.visitors, p.purchases, p.amount
      FROM v FULL OUTER JOIN p ON v.ws = p.ws)
SELECT {_win(H2)}, coalesce(visitors, 0) AS visitors, coalesce(purchases, 0) AS purchases,
       coalesce(amount, 0) AS amount, purchases / visitors AS conversion
FROM j""",

    "docs_foot_traffic": _j123_cte() + f"""
SELECT {_doc_id(S.INDEX_FOOT_TRAFFIC, f'ws // {US}', 'timestamp')} AS doc_id, {_win(M20)}, timestamp,
       pairs_12 AS "pairs_Zone1_Zone2", readings_zone3 AS "readings_Zone3", documents
FROM j123""",

    "docs_foot_traffic_factors": _factors_cte(_running(grouped=False)) + f"""
SELECT {_doc_id(S.INDEX_FOOT_TRAFFIC, f'ws // {US}', 'timestamp', 'zone', f'jws // {US}', 'sensor_uid')}
       AS doc_id, {_win(M20)}, timestamp, zone, jws // {US} AS join_window_start, jwe // {US} AS join_window_end,
       sensor_uid, visitors_from, visitors_to
FROM factors""",

    "docs_proximity": PROX + f"""
SELECT {_doc_id(S.INDEX_PROXIMITY, f'ws // {US}', 'ts')} AS doc_id, area AS "Area", visitors FROM prox""",

    "docs_traffic_jam": JAM + f"""
SELECT {_doc_id(S.INDEX_TRAFFIC_JAM, f'jws // {US}', 'area')} AS doc_id, visitors, area,
       {_jam_label('visitors')} AS "traffic observation"
FROM jam""",

    "docs_categories": CATEGORY + f"""
SELECT {_doc_id(S.INDEX_CATEGORIES, f'ws // {US}', 'category')} AS doc_id, category,
       {_date('last_ts')} AS date, total_sales AS "total_Sales"
FROM cat""",

    "docs_payment": PAYMENT + f"""
SELECT {_doc_id(S.INDEX_PAYMENT, f'ws // {US}', 'payment_method')} AS doc_id,
       payment_method AS "payment_Method", count
FROM pay""",

    "docs_stock": STOCK + f"""
SELECT {_doc_id(S.INDEX_STOCK, f'ws // {US}', 'productid')} AS doc_id, productid AS "product_ID",
       stock_check, {_stock_label('stock_check')} AS observation
FROM stock""",

    "docs_sales": SALES + f"""
SELECT {_doc_id(S.INDEX_SALES, f'ws // {US}', 'category')} AS doc_id, {_date('last_ts')} AS date,
       total_sales AS "total_Sales"
FROM sales""",
}
