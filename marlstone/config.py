"""Everything dataset-specific: sources, schemas, mapping rules, thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Columns every raw feed must publish.
REQUIRED_COLUMNS = (
    "date", "time", "day", "station", "code",
    "min_delay", "min_gap", "bound", "line", "vehicle",
)

# Canonical categories and their short codes.
LINE_1 = "LINE_1_YONGE_UNIVERSITY"
LINE_2 = "LINE_2_BLOOR_DANFORTH"
LINE_3 = "LINE_3_SCARBOROUGH_RT"
LINE_4 = "LINE_4_SHEPPARD"
MULTI_LINE = "MULTI_LINE_OR_NETWORK"
UNKNOWN = "UNKNOWN"

LINE_CODES = {
    LINE_1: "L1",
    LINE_2: "L2",
    LINE_4: "L4",
    LINE_3: "L3",
    MULTI_LINE: "ML",
    UNKNOWN: "UNK",
}

# Mapping rules, first match wins. They see the raw value
# upper-cased with all whitespace removed, so "YU/ BD" arrives as "YU/BD".
LINE_RULES = (
    ("equals", "", UNKNOWN),
    ("equals", "YU", LINE_1),
    ("equals", "YUS", LINE_1),
    ("equals", "BD", LINE_2),
    ("equals", "SHP", LINE_4),
    ("equals", "SRT", LINE_3),
    ("contains", "/", MULTI_LINE),
    ("contains", "-", MULTI_LINE),
    ("contains", "LINES", MULTI_LINE),
    ("contains", "LINE1", LINE_1),
    ("contains", "LINE2", LINE_2),
)

SILVER_SCHEMA = T.StructType([
    T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("event_date", T.DateType()),
    T.StructField("event_hour", T.IntegerType()),
    T.StructField("event_year_month", T.StringType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("station", T.StringType()),
    T.StructField("code_clean", T.StringType()),
    T.StructField("code_description", T.StringType()),
    T.StructField("min_delay", T.DoubleType()),
    T.StructField("min_gap", T.DoubleType()),
    T.StructField("bound", T.StringType()),
    T.StructField("line_raw", T.StringType()),
    T.StructField("line_canonical", T.StringType()),
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("source_file", T.StringType()),
])
SILVER_COLUMNS = tuple(SILVER_SCHEMA.fieldNames())

# Two rows are copies of one incident when these agree (nulls equal).
DEDUPE_KEYS = ("event_ts", "station", "code_clean", "min_delay", "vehicle_id", "line_raw")

PARTITION_COLUMNS = ("partition_year", "partition_month")

# Check thresholds of the preset suite.
THRESHOLDS = {
    "timestamp_parse_min_rate": 0.99,
    "station_blank_max_rate": 0.01,
    "code_reference_min_rate": 0.90,
    "duplicate_max_rate": 0.01,
    "canonical_line_min_rate": 0.90,
    "freshness_max_age_days": 75,
    "volume_max_deviation": 0.60,
    "volume_min_periods": 7,
    "long_tail_max_count": 5,
    "long_tail_max_rate": 0.10,
}
BRONZE_REQUIRED = ("date", "time", "station", "code", "min_delay", "line")


@dataclass(frozen=True)
class SourceSpec:
    """One raw feed. ``multi_line=None`` looks for line breaks inside quotes first."""

    name: str
    path: str
    format: str = "csv"
    multi_line: bool | None = None
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class FeedConfig:
    """A dataset: its feeds in priority order, its code reference, its rules.

    ``time_ordered`` says that the raw files are in date order, which saves the
    shuffle that gathers bronze by month. ``view_name`` is what SQL calls silver;
    give every dataset of a session its own.
    """

    sources: tuple[SourceSpec, ...] = ()
    codes: SourceSpec | None = None
    required_columns: tuple[str, ...] = REQUIRED_COLUMNS
    line_rules: tuple[tuple[str, str, str], ...] = LINE_RULES
    line_default: str = UNKNOWN
    line_codes: dict = field(default_factory=lambda: dict(LINE_CODES))
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",)
    dedupe_keys: tuple[str, ...] = DEDUPE_KEYS
    thresholds: dict = field(default_factory=lambda: dict(THRESHOLDS))
    time_ordered: bool = False
    view_name: str = "silver_delays"
