import duckdb
import pandas as pd
import pytest
from frames import SILVER_DDL, random_silver, silver_frame

from marlstone.operators import gold

ROWS = random_silver()
SUMS = "count(*) AS incidents, sum(min_delay) AS total"
MEAN = "floor(avg(CASE WHEN min_delay > 0 THEN min_delay END) * 100 + 0.5) / 100"


@pytest.fixture(scope="module")
def silver(spark):
    return silver_frame(spark, ROWS).repartition(7)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    names = [c.split()[0] for c in SILVER_DDL.split(", ")]
    frame = pd.DataFrame(ROWS, columns=names)
    frame["event_hour"] = frame["event_hour"].astype("Int32")
    con.register("raw", frame)
    con.execute("""CREATE TABLE s AS SELECT *, year(event_date) AS y, quarter(event_date) AS q
                   FROM (SELECT * REPLACE (CAST(event_date AS DATE) AS event_date) FROM raw)""")
    return con


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_daily(silver, db):
    expected = db.sql(f"""
        SELECT event_date, count(*), count(*) FILTER (min_delay > 0), sum(min_delay), {MEAN},
               count(DISTINCT station) FROM s GROUP BY 1 ORDER BY 1""").fetchall()
    assert rows(gold.daily_summary(silver)) == expected
    assert rows(gold.daily_summary(gold.station_cube(silver))) == expected


def test_monthly_puts_unknown_month_last(silver, db):
    expected = db.sql("""
        SELECT event_year_month, count(*), sum(min_delay), count(*) FILTER (min_delay > 0)
        FROM s GROUP BY 1 ORDER BY 1 NULLS LAST""").fetchall()
    assert expected[-1][0] is None
    assert rows(gold.monthly_trend(silver)) == expected
    assert rows(gold.monthly_trend(gold.time_cube(silver))) == expected


def test_hours_keep_the_unknown_hour(silver, db):
    expected = db.sql(f"SELECT event_hour, {SUMS} FROM s GROUP BY 1 ORDER BY 1 NULLS LAST").fetchall()
    assert len(expected) == 25
    assert rows(gold.delays_by_hour(silver)) == expected
    assert rows(gold.delays_by_hour(gold.time_cube(silver))) == expected


def test_lines(silver, db):
    expected = db.sql(f"""
        SELECT line_canonical, {SUMS}, {MEAN},
               floor(100.0::DOUBLE * count(*) FILTER (min_delay > 0) / count(*) * 10 + 0.5) / 10
        FROM s GROUP BY 1 ORDER BY total DESC, 1""").fetchall()
    assert rows(gold.delays_by_line(silver)) == expected
    assert rows(gold.delays_by_line(gold.time_cube(silver))) == expected


def test_stations_leave_out_blanks_and_break_ties_by_name(silver, db):
    expected = db.sql(f"""
        SELECT station, {SUMS}, {MEAN} FROM s WHERE station <> '' GROUP BY 1
        ORDER BY total DESC, 1""").fetchall()
    assert len(expected) == 30
    assert rows(gold.delays_by_station(silver)) == expected
    assert rows(gold.station_leaderboard(silver, 4)) == expected[:4]


def test_codes_are_cut_to_25(silver, db):
    expected = db.sql(f"""
        SELECT code_clean, coalesce(max(code_description), 'Not in reference table'), {SUMS}
        FROM s GROUP BY 1 ORDER BY total DESC, 1 LIMIT 25""").fetchall()
    assert rows(gold.delays_by_code(silver)) == expected
    assert rows(gold.delays_by_code(gold.code_cube(silver))) == expected


def test_headline_counts_the_blank_station(silver, db):
    expected = db.sql("""SELECT count(*), sum(min_delay), min(event_date), max(event_date),
                         count(DISTINCT station), count(DISTINCT line_canonical) FROM s""").fetchall()
    assert expected[0][4] == 31
    assert rows(gold.headline(silver)) == expected
    assert rows(gold.headline(gold.station_cube(silver))) == expected


GRAINS = {"year": "y", "quarter": "y, q"}


@pytest.mark.parametrize("grain", GRAINS)
def test_totals_and_hours_per_period_and_line(silver, db, grain):
    keys = f"{GRAINS[grain]}, line_canonical"
    totals = db.sql(f"SELECT {keys}, {SUMS}, count(DISTINCT station) FROM s GROUP BY ALL ORDER BY {keys}").fetchall()
    assert rows(gold.totals_by_line(silver, grain)) == totals
    assert rows(gold.totals_by_line(gold.station_cube(silver), grain)) == totals
    hours = db.sql(f"SELECT {keys}, event_hour, {SUMS} FROM s GROUP BY ALL ORDER BY {keys}, event_hour NULLS LAST")
    assert rows(gold.hours_by_line(silver, grain)) == hours.fetchall()


@pytest.mark.parametrize("grain", GRAINS)
def test_top_rows_per_group_with_ties(silver, db, grain):
    keys = f"{GRAINS[grain]}, line_canonical"
    stations = db.sql(f"""
        SELECT * FROM (SELECT {keys}, station, {SUMS}, {MEAN} FROM s WHERE station <> '' GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY total DESC, station) <= 3
        ORDER BY {keys}, total DESC, station""").fetchall()
    assert rows(gold.top_stations(silver, grain, 3)) == stations
    codes = db.sql(f"""
        SELECT * FROM (SELECT {keys}, code_clean, coalesce(max(code_description), 'Not in reference table'),
                              {SUMS} FROM s GROUP BY {keys}, code_clean)
        QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY total DESC, code_clean) <= 12
        ORDER BY {keys}, total DESC, code_clean""").fetchall()
    assert rows(gold.top_codes(silver, grain)) == codes
    assert rows(gold.top_codes(gold.code_cube(silver), grain)) == codes


def test_by_line_series(silver, db):
    months = db.sql(f"""SELECT event_year_month, line_canonical, {SUMS} FROM s GROUP BY 1, 2
                        ORDER BY 1 NULLS LAST, 2""").fetchall()
    assert rows(gold.months_by_line(gold.time_cube(silver))) == months
    days = db.sql("SELECT event_date, line_canonical, sum(min_delay) FROM s GROUP BY 1, 2 ORDER BY 1, 2")
    assert rows(gold.days_by_line(silver)) == days.fetchall()


def test_average_is_null_when_nothing_was_delayed(spark):
    import datetime as dt
    quiet = silver_frame(spark, [(dt.date(2024, 1, 1), 1, "2024-01", "A", "C", None, 0, "UNKNOWN")])
    assert gold.daily_summary(quiet).first()["avg_delay_minutes_when_delayed"] is None
    cube = gold.station_cube(quiet)
    assert gold.delays_by_station(cube).first()["avg_delay_minutes_when_delayed"] is None
    assert gold.delays_by_code(quiet).first()["description"] == "Not in reference table"
