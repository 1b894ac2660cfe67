"""Interactive selections: a period, a line, a search term.

A period is "ALL", a year ("2025") or a quarter ("2025-Q3"); a line is "ALL"
or one canonical value. Rankings are computed from silver or a cube for the
exact selection, never re-summed from lists that were already cut.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marlstone.operators import gold
from marlstone.operators.gold import (
    INCIDENTS, TOP_CODES_PER_GROUP, TOP_STATIONS_PER_GROUP, TOTAL,
)

ALL = "ALL"
ROLLING_DAYS = 7


def parse_period(period: str) -> tuple[int | None, int | None]:
    """"2025-Q3" -> (2025, 3); "2025" -> (2025, None); "ALL" -> (None, None)."""
    if period == ALL:
        return None, None
    match = re.fullmatch(r"(\d{4})(?:-Q([1-4]))?", period)
    if not match:
        raise ValueError(f"Not a period: {period!r}")
    return int(match.group(1)), int(match.group(2)) if match.group(2) else None


def period_bounds(year: int, quarter: int | None) -> tuple[dt.date, dt.date]:
    """First day of the period and first day after it."""
    first = 1 if quarter is None else 3 * quarter - 2
    last = 12 if quarter is None else first + 2
    end = dt.date(year + 1, 1, 1) if last == 12 else dt.date(year, last + 1, 1)
    return dt.date(year, first, 1), end


def in_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the period, as range predicates that reach the Parquet scan.

    Folder pruning comes from the layout columns where the frame has them.
    """
    year, quarter = parse_period(period)
    if year is None:
        return df
    columns = df.columns
    if "event_date" in columns:
        start, end = period_bounds(year, quarter)
        rows = df.where((F.col("event_date") >= F.lit(start)) & (F.col("event_date") < F.lit(end)))
        if "partition_year" in columns:
            rows = rows.where(F.col("partition_year") == year)
            if quarter is not None and "partition_month" in columns:
                rows = rows.where(F.col("partition_month").between(start.month, start.month + 2))
        return rows
    if "event_year" in columns:
        keep = F.col("event_year") == year
        if quarter is not None:
            keep = keep & (F.col("event_quarter") == quarter)
        return df.where(keep)
    start, end = period_bounds(year, quarter)
    month = F.col("event_year_month")
    return df.where((month >= start.strftime("%Y-%m")) & (month < end.strftime("%Y-%m")))


def on_line(df: DataFrame, line: str) -> DataFrame:
    return df if line == ALL else df.where(F.col("line_canonical") == line)


def select_rows(df: DataFrame, period: str = ALL, line: str = ALL) -> DataFrame:
    return on_line(in_period(df, period), line)


def roll_up(df: DataFrame, *keys: str) -> DataFrame:
    """Additive measures of an aggregate summed to coarser ``keys``."""
    return df.groupBy(*keys).agg(
        F.sum(INCIDENTS).alias(INCIDENTS), F.sum(TOTAL).alias(TOTAL))


def headline_totals(totals: DataFrame, period: str = ALL, line: str = ALL) -> DataFrame:
    """Incidents and total of a selection; zero, not null, when it is empty."""
    return select_rows(totals, period, line).agg(
        F.coalesce(F.sum(INCIDENTS), F.lit(0)).alias(INCIDENTS),
        F.coalesce(F.sum(TOTAL), F.lit(0)).alias(TOTAL),
    )


def available_periods(df: DataFrame) -> DataFrame:
    """Every year, and every quarter within it, that has data."""
    return (gold.with_periods(df).select("event_year", "event_quarter").distinct()
                .orderBy("event_year", "event_quarter"))


# --- time series ------------------------------------------------------------

def monthly_series(df: DataFrame, period: str = ALL, line: str = ALL) -> DataFrame:
    """By month of the timestamp; rows without one have no month and are left out."""
    rows = select_rows(df, period, line).where(F.col("event_year_month").isNotNull())
    return gold.monthly_trend(rows).select("event_year_month", INCIDENTS, TOTAL)


def daily_series(df: DataFrame, period: str = ALL, line: str = ALL) -> DataFrame:
    return gold.daily_totals(select_rows(df, period, line))


def hourly_series(df: DataFrame, period: str = ALL, line: str = ALL) -> DataFrame:
    return gold.delays_by_hour(select_rows(df, period, line))


def _rounded_mean(over: WindowSpec) -> Column:
    return F.floor(F.avg(TOTAL).over(over) + 0.5).cast("bigint").alias("rolling_avg")


def rolling_daily(df: DataFrame, period: str = ALL, days: int = ROLLING_DAYS) -> DataFrame:
    """Rolling mean over the last ``days`` present days, for every line and for all.

    The all-lines series is summed from the lines' daily totals, so the rows
    are read once. Each series holds at most one row per day of the period.
    """
    by_line = gold.line_days(in_period(df, period))
    totals = by_line.groupingSets(
        [["event_date", "line_canonical"], ["event_date"]], "event_date", "line_canonical",
    ).agg(F.sum(TOTAL).alias(TOTAL), F.grouping("line_canonical").alias("_all"))
    series = totals.select(
        F.when(F.col("_all") == 1, ALL).otherwise(F.col("line_canonical")).alias("line"),
        "event_date", TOTAL)
    recent = Window.partitionBy("line").orderBy("event_date").rowsBetween(1 - days, 0)
    return series.select("line", "event_date", TOTAL, _rounded_mean(recent))


# --- peaks, shares, rankings ------------------------------------------------

def peak(series: DataFrame, order: str) -> DataFrame:
    """The row with the highest total; the earliest in ``order`` wins a tie."""
    return series.orderBy(F.desc(TOTAL), F.asc_nulls_last(order)).limit(1)


def line_totals(df: DataFrame, period: str = ALL) -> DataFrame:
    """Lines of a period, worst first, whichever line is selected."""
    rows = in_period(df, period)
    return gold.delays_by_line(rows).select("line_canonical", INCIDENTS, TOTAL)


def top_line_share(df: DataFrame, period: str = ALL) -> DataFrame:
    """The worst line and its whole-percent share of the period's total."""
    lines = gold.line_summary(in_period(df, period)).select("line_canonical", TOTAL)
    worst = F.min_by(F.struct("line_canonical", TOTAL), F.struct(-F.col(TOTAL), "line_canonical"))
    found = lines.agg(worst.alias("worst"), F.sum(TOTAL).alias("_sum"))
    share = F.floor(F.col(f"worst.{TOTAL}") / F.nullif(F.col("_sum"), F.lit(0)) * 100 + 0.5)
    return found.where(F.col("_sum") != 0).select(
        F.col("worst.line_canonical").alias("line_canonical"),
        F.col(f"worst.{TOTAL}").alias(TOTAL),
        share.cast("bigint").alias("share_pct"),
    )


def rank_stations(
    df: DataFrame, period: str = ALL, line: str = ALL, k: int = TOP_STATIONS_PER_GROUP,
) -> DataFrame:
    return gold.station_leaderboard(select_rows(df, period, line), k)


def rank_codes(
    df: DataFrame, period: str = ALL, line: str = ALL, k: int = TOP_CODES_PER_GROUP,
) -> DataFrame:
    return gold.delays_by_code(select_rows(df, period, line), k)


def search_stations(ranking: DataFrame, query: str, k: int = TOP_STATIONS_PER_GROUP) -> DataFrame:
    """First ``k`` ranking rows whose station contains ``query``, ignoring case."""
    wanted = query.strip().lower()
    rows = ranking.where(F.lower("station").contains(wanted)) if wanted else ranking
    return rows.orderBy(F.desc(TOTAL), "station").limit(k)
