"""SQL that states the expected result of each registered query."""

from __future__ import annotations


def _sum(value: str) -> str:
    """Sum of amounts of two decimal places, exact in any order of addition."""
    return f"CAST(SUM(CAST({value} AS DECIMAL(18,2))) AS DOUBLE)"


def _avg(value: str) -> str:
    return f"{_sum(value)} / COUNT({value})"


_LATEST_EVENTS = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1
"""

_EVENT_KINDS = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
), c AS (SELECT * FROM e WHERE event_type = 'click'), p AS (SELECT * FROM e WHERE event_type = 'purchase')
"""

_INTERVAL_JOIN = (
    _EVENT_KINDS
    + """
SELECT c.user_id, c.event_id AS click_id, p.event_id AS purchase_id, c.ts AS click_ts, p.ts AS purchase_ts
FROM c JOIN p ON c.user_id = p.user_id
 AND c.ts >= p.ts - INTERVAL 10 MINUTE AND c.ts <= p.ts + INTERVAL 10 MINUTE
"""
)

_SLIDING = f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, event_type,
       COUNT(*) AS row_count, {_avg("value")} AS avg_value
FROM (
  SELECT event_type, value, date_trunc('minute', ts) - to_minutes(CAST(s.i AS BIGINT)) AS window_start
  FROM events, (SELECT unnest(range(0, 5)) AS i) s
)
GROUP BY window_start, event_type
"""

_EVDATA = """
WITH raw AS (
  SELECT CAST(o_custkey AS VARCHAR) AS dol_vehicle_id, o_orderdate AS event_time, o_orderkey AS msg_offset,
         o_orderpriority AS make, o_orderstatus AS model,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'unknown'
              ELSE CAST(o_totalprice / 800 AS VARCHAR) END AS range_text,
         CAST(year(o_orderdate) + floor(o_totalprice / 15000) AS INTEGER) AS model_year,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(trunc(o_totalprice / 800) AS INTEGER) END AS electric_range,
         CASE WHEN o_orderstatus = 'F' THEN 'Battery Electric Vehicle (BEV)'
              ELSE 'Plug-in Hybrid Electric Vehicle (PHEV)' END AS electric_vehicle_type
  FROM orders
), valid AS (
  SELECT * FROM raw WHERE electric_range BETWEEN 0 AND 600 AND model_year BETWEEN 1990 AND 2025
)
"""

_AGGREGATE = (
    _EVDATA
    + """
, newest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY dol_vehicle_id ORDER BY event_time DESC, msg_offset DESC) AS rn FROM valid
  ) WHERE rn = 1
)
SELECT 'County ' || CAST(c_nationkey AS VARCHAR) AS county, make,
       COUNT(*) AS vehicle_count, AVG(electric_range) AS avg_electric_range
FROM newest JOIN customer ON dol_vehicle_id = CAST(c_custkey AS VARCHAR)
GROUP BY 1, 2
"""
)

_WORKBOOK = (
    _EVDATA
    + """
, vehicles AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY dol_vehicle_id ORDER BY event_time DESC, msg_offset DESC) AS rn FROM valid
  ) WHERE rn = 1
), places AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, 'County ' || CAST(c_nationkey AS VARCHAR) AS county, c_mktsegment AS city
  FROM customer WHERE c_custkey % 7 <> 0
), located AS (SELECT * FROM vehicles LEFT JOIN places ON dol_vehicle_id = id
), totals AS (SELECT county, make, AVG(electric_range) AS average FROM located WHERE id IS NOT NULL GROUP BY 1, 2)
"""
)

_VEHICLE_INTERVAL = (
    _EVENT_KINDS
    + """
SELECT 'County ' || CAST(CAST(floor(c.k / 25) AS INTEGER) AS VARCHAR) AS county,
       'Make ' || CAST(CAST(floor(p.k / 25) AS INTEGER) AS VARCHAR) AS make,
       COUNT(*) AS vehicle_count, AVG(p.k) AS avg_electric_range
FROM c JOIN p ON c.user_id = p.user_id
 AND c.ts >= p.ts - INTERVAL 10 MINUTE AND c.ts <= p.ts + INTERVAL 10 MINUTE
GROUP BY 1, 2
"""
)

_NULL_GROUPS = (
    _EVDATA
    + """
, newest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY dol_vehicle_id ORDER BY event_time DESC, msg_offset DESC) AS rn
    FROM valid WHERE msg_offset % 4 <> 0
  ) WHERE rn = 1
)
SELECT CASE WHEN c_custkey % 5 <> 0 THEN 'County ' || CAST(c_nationkey AS VARCHAR) END AS county,
       CASE WHEN msg_offset % 3 <> 0 THEN make END AS make,
       COUNT(*) AS vehicle_count, AVG(electric_range) AS avg_electric_range
FROM newest JOIN customer ON dol_vehicle_id = CAST(c_custkey AS VARCHAR)
WHERE c_custkey % 7 <> 0
GROUP BY 1, 2
"""
)

_EVDATA_SUMMARY = """
SELECT '_consumed' AS field, NULL AS field_value, COUNT(*) AS row_count FROM orders
UNION ALL
SELECT '_unreadable', NULL, COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT 'make', o_orderpriority, COUNT(*) FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY o_orderpriority
UNION ALL
SELECT 'electric_vehicle_type',
       CASE WHEN o_orderstatus = 'F' THEN 'Battery Electric Vehicle (BEV)'
            ELSE 'Plug-in Hybrid Electric Vehicle (PHEV)' END AS t, COUNT(*)
FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY t
"""

ORACLE: dict[str, str] = {
    "join_group_count_avg": f"""
SELECT c_nationkey, c_mktsegment, COUNT(*) AS order_count, {_avg("o_totalprice")} AS avg_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_nationkey, c_mktsegment
""",
    "keyed_join_aggregate": _AGGREGATE,
    "aggregate_refresh": _AGGREGATE,
    "stream_tables": _AGGREGATE,
    "rebuild_tables": _AGGREGATE,
    "null_keys_and_groups": _NULL_GROUPS,
    "vehicle_interval_aggregate": _VEHICLE_INTERVAL,
    "stream_vehicle_interval": _VEHICLE_INTERVAL,
    "interval_join": _INTERVAL_JOIN,
    "stream_interval_join": _INTERVAL_JOIN,
    "interval_join_grouped": _EVENT_KINDS
    + """
SELECT county, make, COUNT(*) AS vehicle_count, AVG(k) AS avg_electric_range FROM (
  SELECT CAST(floor(c.k / 25) AS INTEGER) AS county, CAST(floor(p.k / 25) AS INTEGER) AS make, p.k AS k,
         ROW_NUMBER() OVER (PARTITION BY c.user_id ORDER BY c.ts DESC, c.event_id DESC, p.event_id DESC) AS rn
  FROM c JOIN p ON c.user_id = p.user_id
   AND c.ts >= p.ts - INTERVAL 10 MINUTE AND c.ts <= p.ts + INTERVAL 10 MINUTE
) WHERE rn = 1 GROUP BY county, make
""",
    "group_two_dims": """
SELECT o_orderpriority, l_returnflag, COUNT(*) AS row_count
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
GROUP BY o_orderpriority, l_returnflag
""",
    "relationship_left": """
SELECT CAST(s_nationkey AS VARCHAR) AS s_nationkey, c_mktsegment, COUNT(*) AS row_count
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
GROUP BY 1, 2
""",
    "relationship_no_fanout": f"""
WITH s AS (
  SELECT s_nationkey AS nationkey, COUNT(*) AS suppliers, {_sum("s_acctbal")} AS s_acctbal
  FROM supplier GROUP BY 1
), c AS (
  SELECT c_nationkey AS nationkey, COUNT(*) AS customers, {_sum("c_acctbal")} AS c_acctbal
  FROM customer GROUP BY 1
)
SELECT COALESCE(s.nationkey, c.nationkey) AS nationkey,
       suppliers, s_acctbal, customers, c_acctbal
FROM s FULL OUTER JOIN c ON s.nationkey = c.nationkey
""",
    "top_k_counts": """
SELECT o_custkey, COUNT(*) AS row_count FROM orders
GROUP BY o_custkey ORDER BY row_count DESC, o_custkey LIMIT 10
""",
    "full_counts": "SELECT event_type, COUNT(*) AS row_count FROM events GROUP BY event_type",
    "rollup_two_level": """
SELECT p_brand, p_type,
       CAST(GROUPING(p_brand, p_type) AS INTEGER) AS level, COUNT(*) AS row_count
FROM part GROUP BY ROLLUP (p_brand, p_type)
""",
    "rollup_share": """
SELECT nation, c_mktsegment,
       CAST(GROUPING(nation, c_mktsegment) AS INTEGER) AS level, COUNT(*) AS row_count,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM customer) AS share
FROM (SELECT CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment FROM customer)
GROUP BY ROLLUP (nation, c_mktsegment)
""",
    "fixed_grain_avg_vs_max": f"""
SELECT c_nationkey, c_mktsegment, {_avg("o_totalprice")} AS sum_of_avg,
       MAX(o_totalprice) AS max_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_nationkey, c_mktsegment
""",
    "fixed_grain_finer_view": f"""
WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
f AS (
  SELECT c_nationkey, c_mktsegment, {_avg("o_totalprice")} AS fixed_avg
  FROM j GROUP BY c_nationkey, c_mktsegment
)
SELECT v.c_nationkey, v.c_mktsegment, v.o_orderstatus, f.fixed_avg
FROM (SELECT DISTINCT c_nationkey, c_mktsegment, o_orderstatus FROM j) v
JOIN f ON f.c_nationkey = v.c_nationkey AND f.c_mktsegment = v.c_mktsegment
""",
    "fixed_grain_coarser_view": f"""
SELECT c_nationkey, {_sum("m")} AS sum_of_max, CAST(SUM(n) AS BIGINT) AS row_count
FROM (
  SELECT c_nationkey, c_mktsegment, MAX(o_totalprice) AS m, COUNT(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, c_mktsegment
) GROUP BY c_nationkey
""",
    "measure_sums": f"""
SELECT {_avg("top")} AS avg_of_tops, {_sum("top")} AS sum_of_tops,
       {_sum("total")} AS sum_totalprice
FROM (
  SELECT o_orderstatus, MAX(o_totalprice) AS top, SUM(o_totalprice) AS total
  FROM orders GROUP BY o_orderstatus
)
""",
    "sliding_window_agg": _SLIDING,
    "stream_sliding": _SLIDING,
    "json_decode_filter": """
SELECT event_id, user_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 10 AND 60
""",
    "location_rows": """
SELECT CAST(c_custkey AS VARCHAR) AS dol_vehicle_id,
       TIMESTAMP '1995-01-01 00:00:00' + to_seconds(c_custkey) AS event_time,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE c_name END AS vin,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE 'County ' || CAST(c_nationkey AS VARCHAR) END AS county,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE c_mktsegment END AS city,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE 'WA' END AS state,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS postal_code,
       CASE WHEN c_nationkey = 7 THEN NULL ELSE CAST(c_acctbal AS VARCHAR) END AS vehicle_location
FROM customer
""",
    "evdata_rows": _EVDATA
    + """
SELECT dol_vehicle_id, event_time, 'VIN' || dol_vehicle_id AS vin, model_year, make, model, electric_vehicle_type,
       'Clean Alternative Fuel Vehicle Eligible' AS cafv_eligibility, electric_range, '' AS legislative_district,
       'Utility \\ "' || model || '"' AS electric_utility, CAST(msg_offset AS VARCHAR) AS census_tract_2020
FROM valid WHERE make <> '1-URGENT'
""",
    "parse_errors": """
SELECT 0 AS msg_partition, o_orderkey AS msg_offset,
       left('{"vin_(1-10)":"VIN' || CAST(o_custkey AS VARCHAR) || '","model_year":"', 25) AS payload
FROM orders WHERE o_orderpriority = '1-URGENT'
""",
    "location_fields": """
SELECT 0 AS msg_partition, c_custkey AS msg_offset, c_name AS vin, 'County ' || CAST(c_nationkey AS VARCHAR) AS county,
       c_mktsegment AS city, 'WA' AS state, CAST(c_nationkey AS VARCHAR) AS postal_code,
       CAST(c_custkey AS VARCHAR) AS dol_vehicle_id, CAST(c_acctbal AS VARCHAR) AS vehicle_location
FROM customer WHERE c_nationkey <> 7
""",
    "evdata_fields": _EVDATA
    + """
SELECT 0 AS msg_partition, msg_offset, 'VIN' || dol_vehicle_id AS vin, CAST(model_year AS VARCHAR) AS model_year,
       make, model, electric_vehicle_type, 'Clean Alternative Fuel Vehicle Eligible' AS cafv_eligibility,
       range_text AS electric_range, 'N/A' AS legislative_district, dol_vehicle_id, 'Utility \\ "' || model || '"' AS electric_utility,
       CAST(msg_offset AS VARCHAR) AS census_tract_2020
FROM raw WHERE make <> '1-URGENT'
""",
    "alias_lookup": """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase')
                      THEN ' user ' || CAST(user_id AS VARCHAR) ELSE 'N/A' END AS found
FROM events
""",
    "message_keys": """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN CAST(c_custkey + 1 AS VARCHAR)
                       ELSE c_name END AS message_key
FROM customer
""",
    "row_to_json": """
SELECT p_partkey, '{"p_partkey":"' || CAST(p_partkey AS VARCHAR) || '","p_name":"' || p_name ||
       '","p_brand":"' || p_brand || '","p_size":"' || CAST(p_size AS VARCHAR) || '"}' AS value
FROM part
""",
    "latest_by_key": _LATEST_EVENTS,
    "upsert_merge": _LATEST_EVENTS,
    "keyed_table_upsert": _LATEST_EVENTS,
    "catalog_table_scan": _LATEST_EVENTS,
    "stream_upsert": _LATEST_EVENTS,
    "csv_scan": """
SELECT CAST(c_custkey AS VARCHAR) AS dol_vehicle_id, c_name AS vin_prefix,
       'a "quoted", ' || c_mktsegment AS county,
       CASE WHEN c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS postal_code
FROM customer
""",
    "csv_to_topic": """
SELECT CAST(c_custkey AS VARCHAR) AS dol_vehicle_id, c_name AS vin, 'a "quoted", ' || c_mktsegment AS county,
       CASE WHEN c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS postal_code
FROM customer
""",
    "csv_row_keys": """
SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY')
            THEN CAST(ROW_NUMBER() OVER (ORDER BY c_custkey) AS VARCHAR) ELSE c_name END AS key,
       CAST(c_custkey AS BIGINT) AS c_custkey, c_mktsegment || chr(10) || 'second line' AS county
FROM customer
""",
    "topic_counts": """
SELECT 'location' AS topic, COUNT(*) AS messages FROM customer
UNION ALL SELECT 'evdata', COUNT(*) FROM orders
UNION ALL SELECT 'total', (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM orders)
""",
    "bounded_publish": """
WITH n AS (SELECT LEAST(2000, (SELECT COUNT(*) FROM customer)) AS location, LEAST(2000, (SELECT COUNT(*) FROM orders)) AS evdata)
SELECT 'electric-vehicle-location' AS topic, location AS messages FROM n
UNION ALL SELECT 'electric-vehicle-evdata', evdata FROM n
UNION ALL SELECT 'total', location + evdata FROM n
""",
    "bounded_read": """
SELECT CAST(user_id AS VARCHAR) AS user_key, event_id AS msg_offset, ts AS event_time
FROM events ORDER BY event_id LIMIT 500
""",
    "location_summary": """
SELECT '_consumed' AS field, NULL AS field_value, COUNT(*) AS row_count FROM customer
UNION ALL SELECT '_unreadable', NULL, COUNT(*) FROM customer WHERE c_nationkey = 7
UNION ALL SELECT 'county', 'County ' || CAST(c_nationkey AS VARCHAR), COUNT(*)
FROM customer WHERE c_nationkey <> 7 GROUP BY c_nationkey
UNION ALL SELECT 'city', c_mktsegment, COUNT(*) FROM customer WHERE c_nationkey <> 7 GROUP BY c_mktsegment
""",
    "evdata_summary": _EVDATA_SUMMARY,
    "stream_summary": _EVDATA_SUMMARY,
    "top_counties": """
SELECT 'County ' || CAST(c_nationkey AS VARCHAR) AS field_value, COUNT(*) AS row_count
FROM customer GROUP BY 1 ORDER BY row_count DESC, field_value LIMIT 10
""",
    "worksheet_ranges": _WORKBOOK
    + """
SELECT county, make, MAX(electric_range) AS max_electric_range, AVG(electric_range) AS fixed_avg_range
FROM located GROUP BY county, make
""",
    "worksheet_county_make": _WORKBOOK
    + """
SELECT county, make, CAST(GROUPING(county, make) AS INTEGER) AS level, COUNT(*) AS row_count,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM located) AS share
FROM located GROUP BY ROLLUP (county, make)
""",
    "worksheet_make_model": _WORKBOOK
    + """
SELECT make, model, CAST(GROUPING(make, model) AS INTEGER) AS level, COUNT(*) AS row_count,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM located) AS share
FROM located GROUP BY ROLLUP (make, model)
""",
    "worksheet_make_city": _WORKBOOK + "SELECT city, make, COUNT(*) AS row_count FROM located GROUP BY city, make",
    "workbook_measures": _WORKBOOK
    + """
SELECT ROUND(AVG(average), 6) AS avg_of_averages, ROUND(SUM(average), 6) AS sum_of_averages,
       (SELECT CAST(SUM(electric_range) AS BIGINT) FROM located) AS sum_electric_range
FROM totals
""",
    "workbook_measures_by_city": _WORKBOOK
    + """
, t AS (
  SELECT city, ROUND(AVG(average), 6) AS avg_of_averages, ROUND(SUM(average), 6) AS sum_of_averages
  FROM totals JOIN (SELECT DISTINCT county, city FROM places) p ON totals.county = p.county GROUP BY city
), r AS (SELECT city, CAST(SUM(electric_range) AS BIGINT) AS sum_electric_range FROM located GROUP BY city)
SELECT r.city, avg_of_averages, sum_of_averages, sum_electric_range FROM r LEFT JOIN t ON r.city IS NOT DISTINCT FROM t.city
""",
    "extreme_averages": """
WITH e AS (
  SELECT event_type, CASE WHEN event_id % 500 = 0 AND event_type = 'click' THEN CAST('NaN' AS DOUBLE)
    WHEN event_id % 500 = 0 AND event_type = 'view' THEN CAST('Infinity' AS DOUBLE)
    WHEN event_id % 500 = 0 AND event_type = 'purchase' THEN 1e15 ELSE value END AS v FROM events
), s AS (
  SELECT event_type, COUNT(*) AS row_count, COUNT(v) AS n, CASE WHEN COUNT(*) FILTER (NOT isfinite(v)) > 0 THEN SUM(v)
    ELSE CAST(SUM(CAST(CASE WHEN isfinite(v) THEN v END AS DECIMAL(30,2))) AS DOUBLE) END AS sum_value
  FROM e GROUP BY event_type
)
SELECT event_type, row_count, sum_value, sum_value / n AS avg_value FROM s
""",
    "csv_split_records": r"""
WITH r AS (
  SELECT c_custkey % 8 AS f, c_custkey, 0 AS blank, c_mktsegment, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS id FROM customer
  UNION ALL SELECT c_custkey % 8, c_custkey, 1, NULL, '' FROM customer WHERE c_custkey % 11 = 0
), n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY f, c_custkey, blank) AS i FROM r)
SELECT CASE WHEN id = '' THEN CAST(i AS VARCHAR) ELSE id END AS key,
       '{"dol_vehicle_id":"' || id || CASE WHEN blank = 1 THEN '"}'
         ELSE '","county":"' || c_mktsegment || '\nsecond \"line\""}' END AS value
FROM n
""",
    "stream_progress": _EVDATA
    + """
SELECT 'ev_location_data' AS table_name, COUNT(*) AS rows, COUNT(*) FILTER (c_nationkey = 7) AS unreadable,
       CAST(0 AS BIGINT) AS rejected, CAST(0 AS BIGINT) AS rows_without_key
FROM customer
UNION ALL
SELECT 'ev_data', COUNT(*), COUNT(*) FILTER (make = '1-URGENT'),
       COUNT(*) - (SELECT COUNT(*) FROM valid WHERE make <> '1-URGENT'), 0
FROM raw
""",
    "stream_join_rocksdb": _INTERVAL_JOIN,
    "stream_late_rows": _SLIDING,
    "stream_vehicle_once": _EVENT_KINDS
    + """
SELECT county, make, COUNT(*) AS vehicle_count, AVG(k) AS avg_electric_range FROM (
  SELECT county, make, k, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, county DESC, make DESC, k DESC) AS rn FROM (
    SELECT c.user_id, c.ts, p.k, 'County ' || CAST(CAST(floor(c.k / 25) AS INTEGER) AS VARCHAR) AS county,
           'Make ' || CAST(CAST(floor(p.k / 25) AS INTEGER) AS VARCHAR) AS make
    FROM c JOIN p ON c.user_id = p.user_id AND c.ts >= p.ts - INTERVAL 10 MINUTE AND c.ts <= p.ts + INTERVAL 10 MINUTE
  )
) WHERE rn = 1 GROUP BY county, make
""",
    "vehicle_types": """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'Battery Electric Vehicle (BEV)'
            ELSE 'Plug-in Hybrid Electric Vehicle (PHEV)' END AS field_value, COUNT(*) AS row_count
FROM orders GROUP BY 1
""",
}
