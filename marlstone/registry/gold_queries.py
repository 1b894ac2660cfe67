"""Gold aggregates and leaderboards over ``shipments`` and silver."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import gold
from marlstone.registry.base import query
from marlstone.registry.inputs import clicks, shipments
from marlstone.registry.sql import over

SUMS = "count(*) AS incidents, CAST(sum(min_delay) AS BIGINT) AS total_delay_minutes"
DELAYED = "CAST(sum(CASE WHEN min_delay > 0 THEN 1 ELSE 0 END) AS BIGINT) AS incidents_with_delay"
MEAN = "avg(CASE WHEN min_delay > 0 THEN min_delay END)"
AVERAGE = f"floor({MEAN} * 100 + 0.5) / 100 AS avg_delay_minutes_when_delayed"


@query("a1_daily_summary", over("shipments", f"""
    SELECT event_date, {SUMS}, {DELAYED}, {AVERAGE}, count(DISTINCT station) AS stations_affected
    FROM shipments GROUP BY event_date"""))
def daily_summary(spark, sf_dir):
    return gold.daily_summary(shipments(spark, sf_dir))


@query("a2_monthly_trend", over("shipments", f"""
    SELECT event_year_month, {SUMS}, {DELAYED} FROM shipments GROUP BY event_year_month"""))
def monthly_trend(spark, sf_dir):
    return gold.monthly_trend(shipments(spark, sf_dir))


@query("a3_delays_by_hour", over("clicks", f"""
    SELECT event_hour, {SUMS} FROM clicks GROUP BY event_hour"""))
def delays_by_hour(spark, sf_dir):
    return gold.delays_by_hour(clicks(spark, sf_dir))


@query("a4_delays_by_line", over("shipments", f"""
    SELECT line_canonical, {SUMS}, {AVERAGE},
           floor(100.0::DOUBLE * sum(CASE WHEN min_delay > 0 THEN 1 ELSE 0 END) / count(*) * 10 + 0.5)
             / 10 AS pct_incidents_with_delay
    FROM shipments GROUP BY line_canonical"""))
def delays_by_line(spark, sf_dir):
    return gold.delays_by_line(shipments(spark, sf_dir))


@query("a5_delays_by_station", over("shipments", f"""
    SELECT station, {SUMS}, {AVERAGE} FROM shipments WHERE station <> '' GROUP BY station"""))
def delays_by_station(spark, sf_dir):
    return gold.delays_by_station(shipments(spark, sf_dir))


_CODES = f"""
    SELECT code_clean AS code,
           coalesce(max(code_description), 'Not in reference table') AS description, {SUMS}
    FROM shipments GROUP BY code_clean"""


@query("a6_delays_by_code", over("shipments", _CODES + """
    ORDER BY total_delay_minutes DESC, code LIMIT 25"""))
def delays_by_code(spark, sf_dir):
    return gold.delays_by_code(shipments(spark, sf_dir))


_HEADLINE = f"""
    SELECT {SUMS}, min(event_date) AS min_date, max(event_date) AS max_date,
           count(DISTINCT station) AS stations, count(DISTINCT line_canonical) AS lines
    FROM shipments"""


@query("a7_headline", over("shipments", _HEADLINE))
def headline(spark, sf_dir):
    return gold.headline(shipments(spark, sf_dir))


@query("a8_totals_by_year_line", over("shipments", f"""
    SELECT event_year, line_canonical, {SUMS}, count(DISTINCT station) AS stations
    FROM shipments GROUP BY event_year, line_canonical"""))
def totals_by_year_line(spark, sf_dir):
    return gold.totals_by_line(shipments(spark, sf_dir), "year")


CLICKS_LINED = "line_raw AS line_canonical"


def lined_clicks(spark, sf_dir):
    """Clicks with the raw line text as the category."""
    return clicks(spark, sf_dir).withColumnRenamed("line_raw", "line_canonical")


@query("a9_hour_by_year_line", over("clicks", f"""
    SELECT CAST(year(event_date) AS INT) AS event_year, {CLICKS_LINED}, event_hour, {SUMS}
    FROM clicks GROUP BY ALL"""))
def hour_by_year_line(spark, sf_dir):
    return gold.hours_by_line(lined_clicks(spark, sf_dir), "year")


@query("a10_monthly_by_line", over("shipments", f"""
    SELECT event_year_month, line_canonical, {SUMS}
    FROM shipments GROUP BY event_year_month, line_canonical"""))
def monthly_by_line(spark, sf_dir):
    return gold.months_by_line(shipments(spark, sf_dir))


@query("a11_daily_by_line", over("shipments", """
    SELECT event_date, line_canonical, CAST(sum(min_delay) AS BIGINT) AS total_delay_minutes
    FROM shipments GROUP BY event_date, line_canonical"""))
def daily_by_line(spark, sf_dir):
    return gold.days_by_line(shipments(spark, sf_dir))


@query("a12_totals_by_quarter_line", over("shipments", f"""
    SELECT event_year, event_quarter, line_canonical, {SUMS}, count(DISTINCT station) AS stations
    FROM shipments GROUP BY event_year, event_quarter, line_canonical"""))
def totals_by_quarter_line(spark, sf_dir):
    return gold.totals_by_line(shipments(spark, sf_dir), "quarter")


@query("a13_hour_by_quarter_line", over("clicks", f"""
    SELECT CAST(year(event_date) AS INT) AS event_year,
           CAST(quarter(event_date) AS INT) AS event_quarter, {CLICKS_LINED}, event_hour, {SUMS}
    FROM clicks GROUP BY ALL"""))
def hour_by_quarter_line(spark, sf_dir):
    return gold.hours_by_line(lined_clicks(spark, sf_dir), "quarter")


def station_rows(periods: str) -> str:
    return f"""
    SELECT {periods}, line_canonical, station, {SUMS}, {AVERAGE}
    FROM shipments WHERE station <> '' GROUP BY {periods}, line_canonical, station"""


def code_rows(periods: str) -> str:
    return f"""
    SELECT {periods}, line_canonical, code_clean AS code,
           coalesce(max(code_description), 'Not in reference table') AS description, {SUMS}
    FROM shipments GROUP BY {periods}, line_canonical, code_clean"""


def top_rows(rows: str, periods: str, tie: str, k: int) -> str:
    return f"""
    SELECT * FROM ({rows}) QUALIFY row_number() OVER (
        PARTITION BY {periods}, line_canonical ORDER BY total_delay_minutes DESC, {tie}) <= {k}"""


YEAR, QUARTER = "event_year", "event_year, event_quarter"


@query("a14_station_totals_by_year_line", over("shipments", station_rows(YEAR)))
def station_totals_year(spark, sf_dir):
    return gold.station_totals(shipments(spark, sf_dir), "year")


@query("a14_station_totals_by_quarter_line", over("shipments", station_rows(QUARTER)))
def station_totals_quarter(spark, sf_dir):
    return gold.station_totals(shipments(spark, sf_dir), "quarter")


@query("a14_code_totals_by_year_line", over("shipments", code_rows(YEAR)))
def code_totals_year(spark, sf_dir):
    return gold.code_totals(shipments(spark, sf_dir), "year")


@query("a14_code_totals_by_quarter_line", over("shipments", code_rows(QUARTER)))
def code_totals_quarter(spark, sf_dir):
    return gold.code_totals(shipments(spark, sf_dir), "quarter")


@query("t1_global_top_k", over("shipments", f"""
    SELECT station AS code, 'Not in reference table' AS description, {SUMS}
    FROM shipments GROUP BY station ORDER BY total_delay_minutes DESC, code LIMIT 25"""))
def global_top_k(spark, sf_dir):
    """The code leaderboard on a column with more than 25 values, so the cut matters."""
    rows = shipments(spark, sf_dir).withColumns({
        "code_clean": F.col("station"), "code_description": F.lit(None).cast("string")})
    return gold.delays_by_code(rows)


@query("t2_station_leaderboard", over("shipments", f"""
    SELECT station, {SUMS}, {AVERAGE} FROM shipments WHERE station <> '' GROUP BY station
    ORDER BY total_delay_minutes DESC, station LIMIT 50"""))
def station_leaderboard(spark, sf_dir):
    return gold.station_leaderboard(shipments(spark, sf_dir))


@query("t3_top_stations_by_year_line",
       over("shipments", top_rows(station_rows(YEAR), YEAR, "station", 15)))
def top_stations_year(spark, sf_dir):
    return gold.top_stations(shipments(spark, sf_dir), "year")


_PART_CODES = "SELECT s.* REPLACE (concat(code_clean, ' ', station) AS code_clean) FROM shipments s"


def many_codes(spark, sf_dir):
    """More codes than a group's limit, so that the top-12 cut matters."""
    return shipments(spark, sf_dir).withColumn("code_clean", F.concat_ws(" ", "code_clean", "station"))


def top_codes_sql(periods: str) -> str:
    rows = code_rows(periods).replace("FROM shipments", f"FROM ({_PART_CODES})")
    return over("shipments", top_rows(rows, periods, "code", 12))


@query("t4_top_codes_by_year_line", top_codes_sql(YEAR))
def top_codes_year(spark, sf_dir):
    return gold.top_codes(many_codes(spark, sf_dir), "year")


@query("t5_top_stations_by_quarter_line",
       over("shipments", top_rows(station_rows(QUARTER), QUARTER, "station", 15)))
def top_stations_quarter(spark, sf_dir):
    return gold.top_stations(shipments(spark, sf_dir), "quarter")


@query("t6_top_codes_by_quarter_line", top_codes_sql(QUARTER))
def top_codes_quarter(spark, sf_dir):
    return gold.top_codes(many_codes(spark, sf_dir), "quarter")


# --- the same tables from cubes -----------------------------------------------

@query("a1_daily_summary_from_cube", over("shipments", f"""
    SELECT event_date, {SUMS}, {DELAYED}, {AVERAGE}, count(DISTINCT station) AS stations_affected
    FROM shipments GROUP BY event_date"""))
def daily_summary_from_cube(spark, sf_dir):
    return gold.daily_summary(gold.station_cube(shipments(spark, sf_dir)))


@query("a3_delays_by_hour_from_cube", over("clicks", f"""
    SELECT event_hour, {SUMS} FROM clicks GROUP BY event_hour"""))
def delays_by_hour_from_cube(spark, sf_dir):
    return gold.delays_by_hour(gold.time_cube(lined_clicks(spark, sf_dir)))


@query("a6_delays_by_code_from_cube", over("shipments", _CODES + """
    ORDER BY total_delay_minutes DESC, code LIMIT 25"""))
def delays_by_code_from_cube(spark, sf_dir):
    return gold.delays_by_code(gold.code_cube(shipments(spark, sf_dir)))


@query("a7_headline_from_cube", over("shipments", _HEADLINE))
def headline_from_cube(spark, sf_dir):
    return gold.headline(gold.station_cube(shipments(spark, sf_dir)))


@query("t5_top_stations_by_quarter_line_from_cube",
       over("shipments", top_rows(station_rows(QUARTER), QUARTER, "station", 15)))
def top_stations_quarter_from_cube(spark, sf_dir):
    return gold.top_stations(gold.station_cube(shipments(spark, sf_dir)), "quarter")
