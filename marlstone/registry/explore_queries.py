"""Selections over ``shipments`` and ``clicks``."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import explore, gold
from marlstone.registry.base import query
from marlstone.registry.gold_queries import AVERAGE, SUMS, lined_clicks
from marlstone.registry.inputs import shipments
from marlstone.registry.sql import over

_QUARTER = "event_date >= DATE '1998-07-01' AND event_date < DATE '1998-10-01'"


@query("p20_period_and_line_rows", over("shipments", f"""
    SELECT * EXCLUDE (event_year, event_quarter) FROM shipments
    WHERE {_QUARTER} AND line_canonical = 'AF'"""))
def period_and_line(spark, sf_dir):
    return explore.select_rows(shipments(spark, sf_dir), "1998-Q3", "AF")


@query("p21_station_search", over("shipments", f"""
    SELECT * FROM (
        SELECT station, {SUMS}, {AVERAGE} FROM shipments WHERE station <> '' GROUP BY station
        ORDER BY total_delay_minutes DESC, station LIMIT 50)
    WHERE contains(lower(station), '1') ORDER BY total_delay_minutes DESC, station LIMIT 15"""))
def station_search(spark, sf_dir):
    ranking = gold.station_leaderboard(shipments(spark, sf_dir))
    return explore.search_stations(ranking, " 1 ")


@query("p21_station_search_all_stations", over("shipments", f"""
    SELECT station, {SUMS}, {AVERAGE} FROM shipments
    WHERE station <> '' AND contains(lower(station), '7') GROUP BY station
    ORDER BY total_delay_minutes DESC, station LIMIT 15"""))
def station_search_all(spark, sf_dir):
    return explore.search_stations(gold.delays_by_station(shipments(spark, sf_dir)), "7")


@query("p22_monthly_series_year_line", over("shipments", f"""
    SELECT event_year_month, {SUMS} FROM shipments
    WHERE line_canonical = 'NO' AND year(event_date) = 1999 GROUP BY event_year_month"""))
def monthly_series(spark, sf_dir):
    return explore.monthly_series(shipments(spark, sf_dir), "1999", "NO")


@query("p22_daily_series_quarter", over("shipments", f"""
    SELECT event_date, CAST(sum(min_delay) AS BIGINT) AS total_delay_minutes FROM shipments
    WHERE {_QUARTER} GROUP BY event_date"""))
def daily_series(spark, sf_dir):
    return explore.daily_series(shipments(spark, sf_dir), "1998-Q3")


@query("p22_hourly_series_quarter_line", over("clicks", f"""
    SELECT event_hour, {SUMS} FROM clicks
    WHERE line_raw = 'BD' AND event_date < DATE '2024-04-01' GROUP BY event_hour"""))
def hourly_series(spark, sf_dir):
    return explore.hourly_series(lined_clicks(spark, sf_dir), "2024-Q1", "BD")


@query("d5_available_periods", over("shipments", """
    SELECT DISTINCT event_year, event_quarter FROM shipments"""))
def available_periods(spark, sf_dir):
    return explore.available_periods(shipments(spark, sf_dir))


@query("a15_roll_up", over("shipments", f"""
    SELECT line_canonical, {SUMS} FROM shipments GROUP BY line_canonical"""))
def roll_up(spark, sf_dir):
    totals = gold.line_totals(shipments(spark, sf_dir), "quarter")
    return explore.roll_up(totals, "line_canonical")


@query("a15_roll_up_hours", over("clicks", f"""
    SELECT event_hour, {SUMS} FROM clicks GROUP BY event_hour"""))
def roll_up_hours(spark, sf_dir):
    hours = gold.line_hours(lined_clicks(spark, sf_dir), "year")
    return explore.roll_up(hours, "event_hour")


@query("a16_filtered_headline", over("shipments", f"""
    SELECT {SUMS} FROM shipments WHERE event_year = 1998 AND event_quarter = 3
      AND line_canonical = 'AF'"""))
def filtered_headline(spark, sf_dir):
    totals = gold.line_totals(shipments(spark, sf_dir), "quarter")
    return explore.headline_totals(totals, "1998-Q3", "AF")


@query("a17_top_line_share", over("shipments", """
    SELECT line_canonical, total_delay_minutes,
           CAST(floor(total_delay_minutes / sum(total_delay_minutes) OVER () * 100 + 0.5) AS BIGINT)
             AS share_pct
    FROM (SELECT line_canonical, CAST(sum(min_delay) AS BIGINT) AS total_delay_minutes
          FROM shipments GROUP BY line_canonical)
    ORDER BY total_delay_minutes DESC, line_canonical LIMIT 1"""))
def top_line_share(spark, sf_dir):
    return explore.top_line_share(shipments(spark, sf_dir))


@query("a17_line_totals_year", over("shipments", f"""
    SELECT line_canonical, {SUMS} FROM shipments WHERE event_year = 2000 GROUP BY line_canonical"""))
def line_totals(spark, sf_dir):
    return explore.line_totals(shipments(spark, sf_dir), "2000")


@query("a18_peak_month", over("shipments", f"""
    SELECT event_year_month, {SUMS} FROM shipments GROUP BY event_year_month
    ORDER BY total_delay_minutes DESC, event_year_month LIMIT 1"""))
def peak_month(spark, sf_dir):
    return explore.peak(explore.monthly_series(shipments(spark, sf_dir)), "event_year_month")


@query("a18_worst_day_of_line", over("shipments", """
    SELECT event_date, CAST(sum(min_delay) AS BIGINT) AS total_delay_minutes FROM shipments
    WHERE line_canonical = 'RF' GROUP BY event_date
    ORDER BY total_delay_minutes DESC, event_date LIMIT 1"""))
def worst_day(spark, sf_dir):
    return explore.peak(explore.daily_series(shipments(spark, sf_dir), line="RF"), "event_date")


@query("a18_busiest_hour", over("clicks", f"""
    SELECT event_hour, {SUMS} FROM clicks GROUP BY event_hour
    ORDER BY total_delay_minutes DESC, event_hour LIMIT 1"""))
def busiest_hour(spark, sf_dir):
    return explore.peak(explore.hourly_series(lined_clicks(spark, sf_dir)), "event_hour")


def _rolling(where: str) -> str:
    return f"""
    SELECT line, event_date, total_delay_minutes,
           CAST(floor(avg(total_delay_minutes) OVER (
               PARTITION BY line ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) + 0.5)
             AS BIGINT) AS rolling_avg
    FROM (SELECT line_canonical AS line, event_date, CAST(sum(min_delay) AS BIGINT) AS total_delay_minutes
          FROM shipments WHERE {where} GROUP BY ALL
          UNION ALL
          SELECT 'ALL', event_date, CAST(sum(min_delay) AS BIGINT) FROM shipments
          WHERE {where} GROUP BY ALL)"""


@query("t7_rolling_daily", over("shipments", _rolling("true")))
def rolling_daily(spark, sf_dir):
    return explore.rolling_daily(shipments(spark, sf_dir))


@query("t7_rolling_daily_year_from_cube", over("shipments", _rolling("event_year = 1997")))
def rolling_daily_year(spark, sf_dir):
    return explore.rolling_daily(gold.station_cube(shipments(spark, sf_dir)), "1997")


@query("t9_rank_stations_line_all_years", over("shipments", f"""
    SELECT station, {SUMS}, {AVERAGE} FROM shipments
    WHERE station <> '' AND line_canonical = 'AF' GROUP BY station
    ORDER BY total_delay_minutes DESC, station LIMIT 15"""))
def rank_stations(spark, sf_dir):
    return explore.rank_stations(shipments(spark, sf_dir), line="AF")


@query("t9_rank_stations_year_all_lines", over("shipments", f"""
    SELECT station, {SUMS}, {AVERAGE} FROM shipments
    WHERE station <> '' AND event_year = 1996 GROUP BY station
    ORDER BY total_delay_minutes DESC, station LIMIT 15"""))
def rank_stations_year(spark, sf_dir):
    return explore.rank_stations(shipments(spark, sf_dir), "1996")


@query("t9_rank_codes_quarter", over("shipments", f"""
    SELECT code_clean AS code, coalesce(max(code_description), 'Not in reference table') AS description,
           {SUMS} FROM shipments WHERE {_QUARTER} GROUP BY code_clean
    ORDER BY total_delay_minutes DESC, code LIMIT 12"""))
def rank_codes(spark, sf_dir):
    return explore.rank_codes(shipments(spark, sf_dir), "1998-Q3")


@query("t8_ordered_export", over("shipments", f"""
    SELECT row_number() OVER (ORDER BY total_delay_minutes DESC, station) AS place, station,
           total_delay_minutes
    FROM (SELECT station, {SUMS} FROM shipments WHERE station <> '' GROUP BY station
          ORDER BY total_delay_minutes DESC, station LIMIT 50)"""))
def ordered_export(spark, sf_dir):
    """The order of the leaderboard itself, as the place of each of its 50 rows."""
    ordered = gold.station_leaderboard(shipments(spark, sf_dir))
    place = F.monotonically_increasing_id() + 1
    return ordered.select(place.alias("place"), "station", "total_delay_minutes")
