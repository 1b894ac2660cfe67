import datetime as dt

import pytest
from frames import random_silver, silver_frame
from pyspark.sql import functions as F

from marlstone.config import LINE_1, LINE_2
from marlstone.operators import explore, gold

ROWS = random_silver(900, seed=11)


@pytest.fixture(scope="module")
def silver(spark):
    return silver_frame(spark, ROWS)


def picked(period, line):
    year, quarter = explore.parse_period(period)
    return [r for r in ROWS
            if (year is None or r[0].year == year)
            and (quarter is None or (r[0].month - 1) // 3 + 1 == quarter)
            and line in ("ALL", r[7])]


def totals(rows, key):
    out = {}
    for r in rows:
        n, m = out.get(key(r), (0, 0))
        out[key(r)] = (n + 1, m + r[6])
    return out


SELECTIONS = [("ALL", "ALL"), ("2023", "ALL"), ("2024-Q4", "ALL"), ("ALL", LINE_1), ("2024", LINE_2),
              ("2024-Q2", "UNKNOWN"), ("2030", "ALL")]


def test_periods():
    assert explore.parse_period("2025-Q3") == (2025, 3)
    assert explore.period_bounds(2024, 4) == (dt.date(2024, 10, 1), dt.date(2025, 1, 1))
    assert explore.period_bounds(2024, None) == (dt.date(2024, 1, 1), dt.date(2025, 1, 1))
    for bad in ("2025-Q5", "25", "all", "2025-"):
        with pytest.raises(ValueError):
            explore.parse_period(bad)


@pytest.mark.parametrize("period, line", SELECTIONS)
def test_selection_from_silver_and_aggregates(silver, period, line):
    expected = picked(period, line)
    assert explore.select_rows(silver, period, line).count() == len(expected)
    headline = explore.headline_totals(gold.totals_by_line(silver, "quarter"), period, line).first()
    assert tuple(headline) == (len(expected), sum(r[6] for r in expected))


@pytest.mark.parametrize("period, line", SELECTIONS)
def test_series(silver, period, line):
    rows = picked(period, line)
    days = explore.daily_series(silver, period, line).collect()
    assert [tuple(r) for r in days] == sorted((k, v[1]) for k, v in totals(rows, lambda r: r[0]).items())
    hours = explore.hourly_series(gold.time_cube(silver), period, line).collect()
    assert {r[0]: (r[1], r[2]) for r in hours} == totals(rows, lambda r: r[1])
    months = explore.monthly_series(silver, period, line).collect()
    known = [r for r in rows if r[2] is not None]
    assert [tuple(r) for r in months] == sorted((k, *v) for k, v in totals(known, lambda r: r[2]).items())


@pytest.mark.parametrize("period, line", SELECTIONS)
def test_rankings_are_exact_for_the_selection(silver, period, line):
    rows = picked(period, line)
    stations = totals([r for r in rows if r[3]], lambda r: r[3])
    best = sorted(stations.items(), key=lambda kv: (-kv[1][1], kv[0]))[:15]
    got = explore.rank_stations(gold.station_cube(silver), period, line).collect()
    assert [(r[0], (r[1], r[2])) for r in got] == best
    codes = sorted(totals(rows, lambda r: r[4]).items(), key=lambda kv: (-kv[1][1], kv[0]))[:12]
    got = explore.rank_codes(gold.code_cube(silver), period, line).collect()
    assert [(r["code"], (r["incidents"], r["total_delay_minutes"])) for r in got] == codes


def test_search_filters_then_cuts(silver):
    ranking = gold.station_leaderboard(silver)
    everything = [r["station"] for r in ranking.collect()]
    found = [r["station"] for r in explore.search_stations(ranking, " s1 ").collect()]
    assert found == [s for s in everything if "s1" in s.lower()][:15]
    assert [r["station"] for r in explore.search_stations(ranking, "").collect()] == everything[:15]
    assert explore.search_stations(ranking, "%").isEmpty()


@pytest.mark.parametrize("period", ["ALL", "2024"])
def test_rolling_mean_over_present_days(silver, period):
    got = {(r["line"], r["event_date"]): r["rolling_avg"]
           for r in explore.rolling_daily(silver, period).collect()}
    expected = {}
    for line in ("ALL", LINE_1, LINE_2, "UNKNOWN"):
        days = sorted(totals(picked(period, line), lambda r: r[0]).items())
        for i, (day, _) in enumerate(days):
            window = [v[1] for _, v in days[max(0, i - 6): i + 1]]
            expected[(line, day)] = int(sum(window) / len(window) + 0.5)
    assert got == expected


def test_peaks_take_the_earliest_on_a_tie(spark):
    series = spark.createDataFrame(
        [(3, 9), (1, 5), (2, 9), (None, 9)], "event_hour int, total_delay_minutes int")
    assert explore.peak(series, "event_hour").first()["event_hour"] == 2


def test_top_line_share(silver):
    lines = sorted(totals(ROWS, lambda r: r[7]).items(), key=lambda kv: (-kv[1][1], kv[0]))
    whole = sum(v[1] for _, v in lines)
    row = explore.top_line_share(silver).first()
    assert tuple(row) == (lines[0][0], lines[0][1][1], int(lines[0][1][1] / whole * 100 + 0.5))
    assert explore.top_line_share(silver, "2030").isEmpty()
    assert explore.top_line_share(silver.withColumn("min_delay", F.lit(0))).isEmpty()


def test_available_periods(silver):
    expected = sorted({(r[0].year, (r[0].month - 1) // 3 + 1) for r in ROWS})
    assert [tuple(r) for r in explore.available_periods(silver).collect()] == expected
    assert [tuple(r) for r in explore.available_periods(gold.code_cube(silver)).collect()] == expected


def test_roll_up_sums_a_finer_aggregate(silver):
    lines = {r[0]: (r[1], r[2]) for r in
             explore.roll_up(gold.totals_by_line(silver, "quarter"), "line_canonical").collect()}
    assert lines == totals(ROWS, lambda r: r[7])
