"""SQL building blocks of the oracle: the derived inputs and layers as CTEs."""

from __future__ import annotations

SHIPMENTS = """
SELECT CAST(l_shipdate AS DATE) AS event_date,
       strftime(l_shipdate, '%Y-%m') AS event_year_month,
       CASE WHEN l_suppkey % 23 = 0 THEN '' ELSE s_name END AS station,
       p_type AS code_clean,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE concat('DESC ', p_type) END AS code_description,
       concat(l_returnflag, l_linestatus) AS line_canonical,
       CASE WHEN l_quantity <= 30 THEN 0 ELSE CAST(l_quantity - 30 AS INT) END AS min_delay,
       CAST(year(l_shipdate) AS INT) AS event_year,
       CAST(quarter(l_shipdate) AS INT) AS event_quarter
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
"""

_LINE_TEXT = """
CASE event_id % 11 WHEN 0 THEN 'YU' WHEN 1 THEN 'yus' WHEN 2 THEN 'BD' WHEN 3 THEN 'SHP'
     WHEN 4 THEN 'SRT' WHEN 5 THEN 'YU/ BD' WHEN 6 THEN 'LINE 2 - X' WHEN 7 THEN 'LINE 1'
     WHEN 8 THEN 'line 2' WHEN 9 THEN '95 YORK' ELSE '' END
"""

CLICKS = f"""
SELECT event_id, ts AS event_ts, CAST(ts AS DATE) AS event_date,
       CAST(hour(ts) AS INT) AS event_hour, strftime(ts, '%Y-%m') AS event_year_month,
       CASE WHEN event_id % 17 = 0 THEN ''
            ELSE concat('  user ', CAST(user_id % 40 AS VARCHAR), '   stn ') END AS station_raw,
       event_type AS code, {_LINE_TEXT} AS line_raw,
       CASE WHEN event_id % 5 < 2 THEN 0 ELSE CAST(floor(value) AS INT) END AS min_delay
FROM events
"""

TYPED_FEED = f"""
SELECT strftime(ts, '%Y-%m-%d') AS date,
       CASE WHEN event_id % 113 = 0 THEN '24:61' ELSE strftime(ts, '%H:%M') END AS time,
       dayname(ts) AS day,
       CASE WHEN event_id % 17 = 0 THEN ''
            ELSE concat('  user ', CAST(user_id % 40 AS VARCHAR), '   stn ') END AS station,
       concat(' ', event_type) AS code,
       CASE WHEN event_id % 101 = 0 THEN '-4.0' WHEN event_id % 103 = 0 THEN ''
            WHEN event_id % 5 < 2 THEN '0.0'
            ELSE CAST(CAST(floor(value) AS DOUBLE) AS VARCHAR) END AS min_delay,
       CASE WHEN event_id % 7 <> 0 THEN CAST(value AS VARCHAR) ELSE '' END AS min_gap,
       CASE user_id % 3 WHEN 0 THEN 'n ' WHEN 1 THEN ' S' ELSE '' END AS bound,
       {_LINE_TEXT} AS line, CAST(user_id AS VARCHAR) AS vehicle,
       'typed_feed' AS source_file, 0 AS source_ord, event_id AS source_row_id
FROM events
"""

TEXT_FEED = """
SELECT CASE WHEN o_custkey % 211 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
       CASE WHEN o_custkey % 97 = 0 THEN ''
            ELSE CASE o_custkey % 4 WHEN 0 THEN '8:15' WHEN 1 THEN '08:15' WHEN 2 THEN '17:45'
                 ELSE '18:05' END END AS time,
       dayname(o_orderdate) AS day,
       concat(' ', replace(o_orderpriority, '-', '  '), ', "main" ') AS station,
       lower(o_orderstatus) AS code,
       CASE WHEN o_custkey % 101 = 0 THEN '-4' WHEN o_custkey % 103 = 0 THEN ''
            WHEN o_custkey % 107 = 0 THEN 'abc'
            ELSE CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) AS VARCHAR) END AS min_delay,
       CAST(o_totalprice AS VARCHAR) AS min_gap,
       CASE WHEN o_custkey % 5 = 0 THEN 'NA' ELSE o_orderstatus END AS bound,
       CASE o_orderstatus WHEN 'F' THEN 'YU' WHEN 'O' THEN 'Line 2' ELSE 'YU / BD' END AS line,
       '' AS vehicle, 'text_feed' AS source_file, 1 AS source_ord, o_orderkey AS source_row_id
FROM orders
"""

BRONZE = """
SELECT *, CAST(coalesce(year(try_strptime(date, '%Y-%m-%d')), 0) AS INT) AS partition_year,
       CAST(coalesce(month(try_strptime(date, '%Y-%m-%d')), 0) AS INT) AS partition_month
FROM (SELECT * FROM typed_feed UNION ALL SELECT * FROM text_feed)
"""

CODE_LIST = """
SELECT upper(code) AS code_clean, concat('CODE – ', upper(code)) AS code_description
FROM (SELECT DISTINCT event_type AS code FROM events WHERE event_type <> 'signup'
      UNION ALL SELECT DISTINCT lower(o_orderstatus) FROM orders WHERE o_orderstatus <> 'P')
"""


def bucket(text: str) -> str:
    """The canonical bucket of a raw line value, as one CASE."""
    key = f"upper(regexp_replace({text}, '\\s+', '', 'g'))"
    return f"""
    CASE WHEN {key} = '' THEN 'UNKNOWN'
         WHEN {key} IN ('YU', 'YUS') THEN 'LINE_1_YONGE_UNIVERSITY'
         WHEN {key} = 'BD' THEN 'LINE_2_BLOOR_DANFORTH'
         WHEN {key} = 'SHP' THEN 'LINE_4_SHEPPARD'
         WHEN {key} = 'SRT' THEN 'LINE_3_SCARBOROUGH_RT'
         WHEN contains({key}, '/') OR contains({key}, '-') OR contains({key}, 'LINES')
           THEN 'MULTI_LINE_OR_NETWORK'
         WHEN contains({key}, 'LINE1') THEN 'LINE_1_YONGE_UNIVERSITY'
         WHEN contains({key}, 'LINE2') THEN 'LINE_2_BLOOR_DANFORTH'
         ELSE 'UNKNOWN' END"""


def cleaned(text: str) -> str:
    return f"trim(regexp_replace(upper({text}), '\\s+', ' ', 'g'))"


TYPED = f"""
SELECT source_file, source_ord, source_row_id, date, time, day, station AS station_raw,
       CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS event_date,
       try_strptime(concat(substr(date, 1, 10), ' ', substr(time, 1, 5)), '%Y-%m-%d %H:%M')
         AS event_ts,
       {cleaned('station')} AS station, upper(trim(code)) AS code_clean,
       TRY_CAST(min_delay AS DOUBLE) AS min_delay, TRY_CAST(min_gap AS DOUBLE) AS min_gap,
       upper(trim(bound)) AS bound, line AS line_raw, {bucket('line')} AS line_canonical,
       trim(vehicle) AS vehicle_id
FROM bronze
"""

ANNOTATED = """
SELECT t.*, c.code_description,
       event_date IS NULL OR min_delay IS NULL OR min_delay < 0 AS is_reject
FROM typed t LEFT JOIN code_list c ON t.code_clean = c.code_clean
"""

SILVER = """
SELECT event_ts, event_date, CAST(hour(event_ts) AS INT) AS event_hour,
       strftime(event_ts, '%Y-%m') AS event_year_month, day AS day_of_week, station, code_clean,
       code_description, min_delay, min_gap, bound, line_raw, line_canonical, vehicle_id,
       source_file
FROM (SELECT *, row_number() OVER (
          PARTITION BY event_ts, station, code_clean, min_delay, vehicle_id, line_raw
          ORDER BY source_ord, source_row_id) AS rn
      FROM annotated WHERE NOT is_reject)
WHERE rn = 1
"""

# each name after the ones its text reads from
_CTES = {
    "shipments": SHIPMENTS, "clicks": CLICKS, "typed_feed": TYPED_FEED, "text_feed": TEXT_FEED,
    "bronze": BRONZE, "code_list": CODE_LIST, "typed": TYPED, "annotated": ANNOTATED,
    "silver": SILVER,
}
_LAYERS = ("typed_feed", "text_feed", "bronze", "code_list", "typed", "annotated", "silver")


def over(name: str, body: str) -> str:
    """``body`` with the CTE ``name`` and everything below it in front."""
    needed = _LAYERS[: _LAYERS.index(name) + 1] if name in _LAYERS else (name,)
    ctes = ", ".join(f"{n} AS ({_CTES[n]})" for n in needed)
    return f"WITH {ctes} {body}"
