"""Export sections: short line codes, epoch days, dictionary-encoded rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.config import LINE_CODES
from marlstone.functions.encoding import (
    decode_domain, encode_domain, epoch_day, json_row, shortest_number,
)
from marlstone.operators import gold
from marlstone.operators.gold import AVERAGE, INCIDENTS, TOTAL
from marlstone.operators.joins import broadcast_if_small

PERIOD = ("event_year", "event_quarter")


def with_short_line(df: DataFrame, codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    """``line_canonical`` replaced by its short code in ``line``."""
    return df.withColumn(
        "line", encode_domain(F.col("line_canonical"), codes, "line")).drop("line_canonical")


def with_full_line(df: DataFrame, codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    return df.withColumn("line_canonical", decode_domain(F.col("line"), codes, "line")).drop("line")


def line_code_table(spark: SparkSession, codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    return spark.createDataFrame(
        [(short, full) for full, short in codes.items()], "line string, line_canonical string")


def records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object in ``record``; dates are ISO text."""
    return df.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


# --- daily ------------------------------------------------------------------

def daily_compact(df: DataFrame) -> DataFrame:
    """(epoch_day, incidents, total) per day."""
    days = gold.daily_summary(df)
    return days.select(epoch_day(F.col("event_date")).alias("epoch_day"), INCIDENTS, TOTAL)


def daily_by_line_compact(df: DataFrame, codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    """(epoch_day, line, total) per day and line."""
    days = with_short_line(gold.days_by_line(df), codes)
    return days.select(epoch_day(F.col("event_date")).alias("epoch_day"), "line", TOTAL)


def as_arrays(df: DataFrame) -> DataFrame:
    """Rows as compact JSON arrays in column order; 17.0 is written as 17."""
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    cells = [
        shortest_number(F.col(c)) if c in fractional else F.col(c).cast("variant")
        for c in df.columns
    ]
    return df.select(json_row(*cells).alias("row"))


# --- dictionaries -----------------------------------------------------------

def _dense_index(first_seen: DataFrame) -> DataFrame:
    """0-based position in (year, quarter, rank) order.

    Numbered inside each quarter, then shifted by the size of the quarters
    before it, so only one row per quarter is ordered globally.
    """
    before = Window.orderBy(*PERIOD).rowsBetween(Window.unboundedPreceding, -1)
    sizes = first_seen.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        *PERIOD, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*PERIOD).orderBy("_place")
    numbered = first_seen.withColumn("_inside", F.row_number().over(inside))
    return numbered.join(broadcast_if_small(offsets), list(PERIOD)).select(
        "station", (F.col("_offset") + F.col("_inside") - 1).cast("bigint").alias("station_index"))


def station_dictionary(ranked: DataFrame) -> DataFrame:
    """``station -> station_index`` by first appearance in the ordered ranking rows."""
    place = F.struct(
        F.col("line_canonical"), (-F.col(TOTAL)).alias("_worst"), F.col("station").alias("_name"))
    seen = ranked.groupBy("station").agg(
        F.min(F.struct(*PERIOD, place.alias("_place"))).alias("_first"))
    return _dense_index(seen.select("station", "_first.*"))


def code_dictionary(ranked: DataFrame) -> DataFrame:
    """``code -> description``; the last ranking row of a code decides."""
    place = F.struct(*PERIOD, "line_canonical", -F.col(TOTAL), F.col("code").alias("_name"))
    return ranked.groupBy("code").agg(F.max_by("description", place).alias("description"))


def encode_stations(ranked: DataFrame, dictionary: DataFrame,
                    codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    """Ranking rows with the station as its index."""
    joined = ranked.join(broadcast_if_small(dictionary), "station")
    return with_short_line(joined, codes).select(
        *PERIOD, "line", "station_index", INCIDENTS, TOTAL, AVERAGE)


def decode_stations(encoded: DataFrame, dictionary: DataFrame,
                    codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    joined = encoded.join(broadcast_if_small(dictionary), "station_index")
    return with_full_line(joined, codes).select(
        *PERIOD, "line_canonical", "station", INCIDENTS, TOTAL, AVERAGE)


def encode_codes(ranked: DataFrame, codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    """Ranking rows with the code alone; its description is in the dictionary."""
    return with_short_line(ranked, codes).select(*PERIOD, "line", "code", INCIDENTS, TOTAL)


def decode_codes(encoded: DataFrame, dictionary: DataFrame,
                 codes: Mapping[str, str] = LINE_CODES) -> DataFrame:
    joined = encoded.join(broadcast_if_small(dictionary), "code")
    return with_full_line(joined, codes).select(
        *PERIOD, "line_canonical", "code", "description", INCIDENTS, TOTAL)


# --- sections ---------------------------------------------------------------

def field_table(spark: SparkSession, compact: Mapping[str, DataFrame]) -> DataFrame:
    """What each position of a section's arrays holds; ``line`` is a short code."""
    names = [
        (section, ["line_code" if c == "line" else c for c in rows.columns])
        for section, rows in compact.items()
    ]
    return spark.createDataFrame(names, "section string, fields array<string>")


def _as_is(name: str, df: DataFrame) -> DataFrame:
    return df


def sections(
    by_time: DataFrame, by_station: DataFrame, by_code: DataFrame,
    codes: Mapping[str, str] = LINE_CODES,
    keep: Callable[[str, DataFrame], DataFrame] = _as_is,
) -> dict[str, DataFrame]:
    """Every export section by name, from the three cubes (or silver for each).

    ``keep`` may store a frame that several sections read and return it stored.
    """
    def short(df: DataFrame) -> DataFrame:
        return with_short_line(df, codes)

    quarter_stations = keep("quarter_stations", gold.top_stations(by_station, "quarter"))
    quarter_codes = keep("quarter_codes", gold.top_codes(by_code, "quarter"))
    station_names = keep("station_names", station_dictionary(quarter_stations))
    compact = {
        "daily_summary": daily_compact(by_station),
        "daily_by_line": daily_by_line_compact(by_time, codes),
        "totals_by_quarter_line": short(gold.totals_by_line(by_station, "quarter")).select(
            *PERIOD, "line", INCIDENTS, TOTAL, "stations"),
        "hour_by_quarter_line": short(gold.hours_by_line(by_time, "quarter")).select(
            *PERIOD, "line", "event_hour", INCIDENTS, TOTAL),
        "stations_by_quarter_line": encode_stations(quarter_stations, station_names, codes),
        "codes_by_quarter_line": encode_codes(quarter_codes, codes),
    }
    return {
        "headline": gold.headline(by_station),
        "line_codes": line_code_table(by_time.sparkSession, codes),
        "delays_by_line": gold.delays_by_line(by_time),
        "delays_by_station": gold.station_leaderboard(by_station),
        "delays_by_hour": gold.delays_by_hour(by_time),
        "monthly_trend": gold.monthly_trend(by_time),
        "delays_by_code": gold.delays_by_code(by_code),
        "totals_by_year_line": short(gold.totals_by_line(by_station, "year")),
        "hour_by_year_line": short(gold.hours_by_line(by_time, "year")),
        "monthly_by_line": short(gold.months_by_line(by_time)),
        "stations_by_year_line": short(gold.top_stations(by_station, "year")),
        "codes_by_year_line": short(gold.top_codes(by_code, "year")),
        **{name: as_arrays(rows) for name, rows in compact.items()},
        "array_fields": field_table(by_time.sparkSession, compact),
        "station_names": station_names,
        "code_descriptions": code_dictionary(quarter_codes),
    }
