"""Gold aggregates and per-group leaderboards.

Every function takes silver or a cube of it. A cube is silver pre-aggregated
to a coarser key and carries the additive measures below, so the same sums give
the same answers from either; a run that needs many gold tables reads silver
once per cube instead of once per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.encoding import percent, round_half_up

# Leaderboard sizes and the text for a code without description.
TOP_CODES = 25
TOP_STATIONS_HEAD = 50
TOP_STATIONS_PER_GROUP = 15
TOP_CODES_PER_GROUP = 12
NO_DESCRIPTION = "Not in reference table"

GRAINS = {"all": (), "year": ("event_year",), "quarter": ("event_year", "event_quarter")}

INCIDENTS = "incidents"
DELAYED = "incidents_with_delay"
TOTAL = "total_delay_minutes"
DELAYED_TOTAL = "delayed_minutes"
AVERAGE = "avg_delay_minutes_when_delayed"


def is_cube(df: DataFrame) -> bool:
    return INCIDENTS in df.columns


def _incidents(df: DataFrame) -> Column:
    return (F.sum(INCIDENTS) if is_cube(df) else F.count(F.lit(1))).alias(INCIDENTS)


def _delayed(df: DataFrame) -> Column:
    flag = F.when(F.col("min_delay") > 0, 1).otherwise(0) if not is_cube(df) else F.col(DELAYED)
    return F.sum(flag).alias(DELAYED)


def _total(df: DataFrame) -> Column:
    return F.sum(TOTAL if is_cube(df) else "min_delay").alias(TOTAL)


def _delayed_total(df: DataFrame) -> Column:
    if is_cube(df):
        return F.sum(DELAYED_TOTAL).alias(DELAYED_TOTAL)
    return F.sum(F.when(F.col("min_delay") > 0, F.col("min_delay"))).alias(DELAYED_TOTAL)


def _average(df: DataFrame) -> Column:
    """Mean delay of delayed incidents, 2 places; null when none was delayed."""
    if is_cube(df):
        mean = F.sum(DELAYED_TOTAL).cast("double") / F.nullif(F.sum(DELAYED), F.lit(0))
    else:
        mean = F.avg(F.when(F.col("min_delay") > 0, F.col("min_delay")))
    return round_half_up(mean, 2).alias(AVERAGE)


def _stations(name: str) -> Column:
    return F.count_distinct("station").alias(name)


def with_periods(df: DataFrame) -> DataFrame:
    """Adds ``event_year`` and ``event_quarter`` unless the frame has them."""
    if "event_year" in df.columns:
        return df
    return df.withColumns({
        "event_year": F.year("event_date"), "event_quarter": F.quarter("event_date"),
    })


# --- cubes ------------------------------------------------------------------

def _cube(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(_incidents(df), _delayed(df), _total(df), _delayed_total(df))


def time_cube(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(date, month, hour, line): bounded by the calendar and the line domain. ``by`` are further keys."""
    return _cube(silver, (*by, "event_date", "event_year_month", "event_hour", "line_canonical"))


def station_cube(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(date, line, station): keeps station, so distinct counts stay exact."""
    return _cube(silver, (*by, "event_date", "line_canonical", "station"))


def code_cube(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(year, quarter, line, code, description)."""
    return _cube(with_periods(silver), (
        *by, "event_year", "event_quarter", "line_canonical", "code_clean", "code_description"))


# --- gold models ------------------------------------------------------------

def day_summary(df: DataFrame) -> DataFrame:
    """Per day, in no order."""
    return df.groupBy("event_date").agg(
        _incidents(df), _delayed(df), _total(df), _average(df), _stations("stations_affected"))


def daily_summary(df: DataFrame) -> DataFrame:
    return day_summary(df).orderBy("event_date")


def monthly_trend(df: DataFrame) -> DataFrame:
    return df.groupBy("event_year_month").agg(
        _incidents(df), _total(df), _delayed(df),
    ).orderBy(F.asc_nulls_last("event_year_month"))


def delays_by_hour(df: DataFrame) -> DataFrame:
    """An unknown hour is its own group, last."""
    return df.groupBy("event_hour").agg(
        _incidents(df), _total(df)).orderBy(F.asc_nulls_last("event_hour"))


def line_summary(df: DataFrame) -> DataFrame:
    """Per line, in no order."""
    share = round_half_up(percent(_delayed(df), _incidents(df)), 1)
    return df.groupBy("line_canonical").agg(
        _incidents(df), _total(df), _average(df), share.alias("pct_incidents_with_delay"))


def delays_by_line(df: DataFrame) -> DataFrame:
    return line_summary(df).orderBy(F.desc(TOTAL), "line_canonical")


def named_stations(df: DataFrame) -> DataFrame:
    """Rows with a station; a blank one counts in totals but is never ranked."""
    return df.where(F.col("station") != "")


def _station_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = named_stations(df)
    return named.groupBy(*keys, "station").agg(_incidents(df), _total(df), _average(df))


def _code_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per code, with its first non-null description.

    The description is a grouping key of the pass over the rows and is chosen
    afterwards: a maximum of text cannot be hash-aggregated and would sort them.
    """
    described = df.groupBy(*keys, "code_clean", "code_description").agg(_incidents(df), _total(df))
    return described.groupBy(*keys, F.col("code_clean").alias("code")).agg(
        F.coalesce(F.max("code_description"), F.lit(NO_DESCRIPTION)).alias("description"),
        F.sum(INCIDENTS).alias(INCIDENTS), F.sum(TOTAL).alias(TOTAL))


def delays_by_station(df: DataFrame) -> DataFrame:
    """All stations, worst first; ties by name."""
    return _station_totals(df, ()).orderBy(F.desc(TOTAL), "station")


def station_leaderboard(df: DataFrame, k: int = TOP_STATIONS_HEAD) -> DataFrame:
    return delays_by_station(df).limit(k)


def delays_by_code(df: DataFrame, k: int = TOP_CODES) -> DataFrame:
    return _code_totals(df, ()).orderBy(F.desc(TOTAL), "code").limit(k)


def headline(df: DataFrame) -> DataFrame:
    """Whole-table totals in one row.

    Reduced to one row per (line, station) first: the two distinct counts then
    expand that small result, not silver.
    """
    pairs = df.groupBy("line_canonical", "station").agg(
        _incidents(df), _total(df),
        F.min("event_date").alias("min_date"), F.max("event_date").alias("max_date"))
    return pairs.agg(
        F.sum(INCIDENTS).alias(INCIDENTS),
        F.sum(TOTAL).alias(TOTAL),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        F.count_distinct("station").alias("stations"),
        F.count_distinct("line_canonical").alias("lines"),
    )


# --- breakdowns for filters -------------------------------------------------

def line_totals(df: DataFrame, grain: str = "year") -> DataFrame:
    """Per (period, line), with distinct stations, in no order; needs silver or the station cube.

    Further aggregates start from this: Spark keeps a sort below a sum of
    doubles, so an ordered view would be sorted for nobody.
    """
    return with_periods(df).groupBy(*GRAINS[grain], "line_canonical").agg(
        _incidents(df), _total(df), _stations("stations"))


def totals_by_line(df: DataFrame, grain: str = "year") -> DataFrame:
    """``line_totals`` in order of period and line."""
    return line_totals(df, grain).orderBy(*GRAINS[grain], "line_canonical")


def line_hours(df: DataFrame, grain: str = "year") -> DataFrame:
    """Per (period, line, hour), in no order."""
    return with_periods(df).groupBy(*GRAINS[grain], "line_canonical", "event_hour").agg(_incidents(df), _total(df))


def hours_by_line(df: DataFrame, grain: str = "year") -> DataFrame:
    keys = (*GRAINS[grain], "line_canonical", "event_hour")
    return line_hours(df, grain).orderBy(*[F.asc_nulls_last(k) for k in keys])


def line_months(df: DataFrame) -> DataFrame:
    """Per (month, line), in no order."""
    return df.groupBy("event_year_month", "line_canonical").agg(_incidents(df), _total(df))


def months_by_line(df: DataFrame) -> DataFrame:
    return line_months(df).orderBy(*[F.asc_nulls_last(k) for k in ("event_year_month", "line_canonical")])


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("event_date").agg(_total(df)).orderBy("event_date")


def line_days(df: DataFrame) -> DataFrame:
    """Total per day and line, in no order."""
    return df.groupBy("event_date", "line_canonical").agg(_total(df))


def days_by_line(df: DataFrame) -> DataFrame:
    return line_days(df).orderBy("event_date", "line_canonical")


def station_totals(df: DataFrame, grain: str = "year") -> DataFrame:
    """Per (period, line, station), blanks left out: the rows the rankings cut."""
    return _station_totals(with_periods(df), (*GRAINS[grain], "line_canonical"))


def code_totals(df: DataFrame, grain: str = "year") -> DataFrame:
    return _code_totals(with_periods(df), (*GRAINS[grain], "line_canonical"))


def top_per_group(df: DataFrame, groups: Sequence[str], k: int, tie: str) -> DataFrame:
    """The ``k`` rows with the highest total in each group, ties by ``tie``.

    The rank filter becomes a group limit on both sides of the shuffle, so a
    task sends at most k rows per group however large the group is.
    """
    ranked = Window.partitionBy(*groups).orderBy(F.desc(TOTAL), F.asc(tie))
    return (df.withColumn("_rank", F.row_number().over(ranked))
              .where(F.col("_rank") <= k).drop("_rank")
              .orderBy(*groups, F.desc(TOTAL), F.asc(tie)))


def top_stations(df: DataFrame, grain: str = "year", k: int = TOP_STATIONS_PER_GROUP) -> DataFrame:
    return top_per_group(
        station_totals(df, grain), (*GRAINS[grain], "line_canonical"), k, "station")


def top_codes(df: DataFrame, grain: str = "year", k: int = TOP_CODES_PER_GROUP) -> DataFrame:
    return top_per_group(code_totals(df, grain), (*GRAINS[grain], "line_canonical"), k, "code")
