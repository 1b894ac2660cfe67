"""Config-driven data-quality checks.

Spark reduces the data to a handful of numbers: one fused pass for everything
that is a plain aggregate, one grouped pass for each check that needs one. The
thresholds are then compared on the driver, against the unrounded rate.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.config import BRONZE_REQUIRED, THRESHOLDS
from marlstone.functions.casting import parse_number, parse_timestamp
from marlstone.functions.text import is_blank, strip_upper
from marlstone.operators.joins import lookup
from marlstone.sources.sinks import reliable_checkpoint

# The configuration keys.
KNOWN_KEYS = (
    "dataset_name", "layer", "required_columns", "timestamp_column",
    "timestamp_parse_min_rate", "not_blank_max_rates", "non_negative_columns",
    "reference_coverage", "duplicate_max_rate", "mapped_value_coverage",
    "freshness", "volume_anomaly", "long_tail",
)
# Defaults of optional settings.
DEFAULT_TIMESTAMP_RATE = 0.99
DEFAULT_UNKNOWN_VALUES = ("UNKNOWN", "")
DEFAULT_MIN_PERIODS = 7
TRAILING_PERIODS = 8  # latest partial + latest full + six before them

# Texts of measures, thresholds and the configuration error.
SCHEMA_MEASURE = "{present}/{total} required columns present"
SCHEMA_THRESHOLD = "all required columns present"
FRESHNESS_MEASURE = "max {column} {newest}, {age} days before run date"
NO_HISTORY = "insufficient history"
UNKNOWN_KEYS = "Unknown config keys: {keys}"

# Suspect row hashes up to this many (16 bytes each in the hash table) are
# broadcast; with more, all rows are grouped instead.
BROADCAST_HASHES = 1_000_000

RESULT_SCHEMA = (
    "name string, layer string, passed boolean, measured string, "
    "measured_value double, threshold string, detail string"
)


@dataclass
class CheckResult:
    name: str
    layer: str
    passed: bool
    measured: float | int | str
    threshold: str
    detail: str

    def to_dict(self) -> dict:
        return asdict(self)


class QualityGateError(RuntimeError):
    """Raised by the gate when a check failed."""


# --- measures: DataFrame -> small DataFrame ---------------------------------

def named(column: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + column.replace("`", "``") + "`")


def _text(c: str) -> Column:
    return named(c).cast("string")


def _present(df: DataFrame, column: str) -> Column:
    """The value, or null where it is NaN: that is a missing number, not one."""
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(named(column)), named(column))
    return named(column)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, rows): how often each value occurs; missing ones are one null."""
    return df.groupBy(_present(df, column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))


def parsed_timestamp(df: DataFrame, column: str) -> Column:
    return parse_timestamp(named(column), df.schema[column].dataType)


def count_parseable(df: DataFrame, column: str) -> Column:
    return F.count(parsed_timestamp(df, column))


def count_blank(column: str) -> Column:
    """Blank text only; a null is missing, not blank."""
    return F.count_if(is_blank(named(column)))


def count_negative(column: str) -> Column:
    return F.count_if(F.coalesce(parse_number(named(column)) < 0, F.lit(False)))


def count_mapped(column: str, unknown: Iterable[str]) -> Column:
    """Rows outside the unknown bucket; null counts as mapped."""
    unmapped = F.coalesce(_text(column).isin(*[str(v) for v in unknown]), F.lit(False))
    return F.count_if(~unmapped)


def latest_date(df: DataFrame, column: str) -> Column:
    return F.max(parsed_timestamp(df, column)).cast("date")


def coverage(counts: DataFrame, reference: DataFrame) -> DataFrame:
    """(hits): rows whose value is in a one-column reference frame.

    Rows are counted per value first, so the join sees each value once and a
    hot value costs nothing.
    """
    wanted = reference.select(strip_upper(named(reference.columns[0]).cast("string")).alias("_value"))
    wanted = wanted.where(F.col("_value").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    cleaned = counts.groupBy(strip_upper(F.col("_value").cast("string")).alias("_value")).agg(
        F.sum("_rows").alias("_rows"))
    return lookup(cleaned, wanted, "_value").agg(
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_rows"))), F.lit(0)).alias("hits"))


def long_tail(counts: DataFrame, max_count: int) -> DataFrame:
    """(rows, tail_rows): rows whose value occurs at most ``max_count`` times, missing ones never."""
    rare = F.col("_value").isNotNull() & (F.col("_rows") <= max_count)
    return counts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(rare, F.col("_rows"))), F.lit(0)).alias("tail_rows"),
    )


def recent_periods(counts: DataFrame, at_least: int = TRAILING_PERIODS) -> DataFrame:
    """The last periods with their row counts, newest first.

    Only these decide the check: fewer rows than asked for means that the
    table has no more periods.
    """
    periods = counts.where("_value is not null").select(F.col("_value").alias("period"), F.col("_rows").alias("rows"))
    return periods.orderBy(F.desc("period")).limit(max(at_least, TRAILING_PERIODS))


def volume_deviation(counts: DataFrame, at_least: int = TRAILING_PERIODS) -> DataFrame:
    """(periods, latest, baseline, deviation) over the most recent periods.

    The newest period may be partial, so the one before it is the latest full
    one; the baseline is the mean of up to six before that.
    """
    newest_first = recent_periods(counts, at_least).agg(
        F.sort_array(F.collect_list(F.struct("period", "rows")), asc=False).alias("_recent"))
    rows = F.col("_recent.rows")
    prior = F.slice(rows, 3, TRAILING_PERIODS - 2)
    total = F.aggregate(prior, F.lit(0).cast("bigint"), lambda a, x: a + x)
    sized = newest_first.select(
        F.size("_recent").alias("periods"),
        F.get(rows, F.lit(1)).cast("double").alias("latest"),
        (total / F.nullif(F.size(prior), F.lit(0))).alias("baseline"),
    )
    gap = F.abs(F.col("latest") - F.col("baseline")) / F.col("baseline")
    return sized.withColumn("deviation", F.when(F.col("baseline") == 0, 0.0).otherwise(gap))


def repeated_rows(df: DataFrame, broadcast_hashes: int = BROADCAST_HASHES) -> int:
    """How many rows repeat an earlier row, comparing all columns.

    Rows are first counted by a 64-bit hash, which shuffles sixteen bytes per
    row; only rows whose hash occurs twice can repeat and are compared in full.
    Runs jobs, because how many there are decides how to compare them.
    """
    columns = [named(c) for c in df.columns]
    hashed = F.xxhash64(*columns)
    suspects = reliable_checkpoint(
        df.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
          .where("_rows > 1").select("_hash"))
    found = suspects.count()
    if not found:
        return 0
    rows = df
    if found <= broadcast_hashes:
        rows = (df.withColumn("_hash", hashed)
                  .join(F.broadcast(suspects), "_hash", "left_semi").drop("_hash"))
    copies = rows.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("_extra"))
    return copies.agg(F.coalesce(F.sum("_extra"), F.lit(0))).first()[0]


# --- the checks: measures -> results ----------------------------------------

@dataclass(frozen=True)
class _Suite:
    """One table under one config, with the measures of the fused pass.

    ``counts`` may hold, by column, a frame of value counts that is there
    already; other columns are counted from the table.
    """

    df: DataFrame
    config: Mapping
    layer: str
    run_date: dt.date
    measured: Mapping
    counts: Mapping[str, DataFrame]

    def values(self, column: str) -> DataFrame:
        return self.counts[column] if column in self.counts else value_counts(self.df, column)

    @property
    def rows(self) -> int:
        return self.measured["rows"]

    def share(self, part: int, empty: float) -> float:
        return part / self.rows if self.rows else empty

    def result(self, name, passed, measured, threshold, detail) -> CheckResult:
        return CheckResult(name, self.layer, passed, measured, threshold, detail)

    def at_least(self, name: str, rate: float, floor: float, detail: str) -> CheckResult:
        return self.result(name, rate >= floor, round(rate, 4), f">= {floor}", detail)

    def at_most(self, name: str, rate: float, ceiling, detail: str) -> CheckResult:
        return self.result(name, rate <= float(ceiling), round(rate, 4), f"<= {ceiling}", detail)


def _schema(suite: _Suite) -> Iterator[CheckResult]:
    required = list(suite.config["required_columns"])
    missing = [c for c in required if c not in suite.df.columns]
    present = len(required) - len(missing)
    yield suite.result(
        "schema_conformance", not missing,
        SCHEMA_MEASURE.format(present=present, total=len(required)), SCHEMA_THRESHOLD,
        f"missing: {missing}")


def _timestamps(suite: _Suite) -> Iterator[CheckResult]:
    column = suite.config["timestamp_column"]
    floor = float(suite.config.get("timestamp_parse_min_rate", DEFAULT_TIMESTAMP_RATE))
    yield suite.at_least("timestamp_parse_rate", suite.share(suite.measured["parsed"], 0.0), floor,
                         f"rows whose {column} is a timestamp")


def _blanks(suite: _Suite) -> Iterator[CheckResult]:
    for column, ceiling in suite.config["not_blank_max_rates"].items():
        rate = suite.share(suite.measured[f"blank:{column}"], 1.0)
        yield suite.at_most(f"{column}_null_rate", rate, ceiling, f"rows whose {column} is blank")


def _negatives(suite: _Suite) -> Iterator[CheckResult]:
    for column in suite.config["non_negative_columns"]:
        found = suite.measured[f"negative:{column}"]
        yield suite.result(f"non_negative_{column}", found == 0, found, "== 0",
                           f"rows whose {column} is below zero")


def _references(suite: _Suite) -> Iterator[CheckResult]:
    spec = suite.config["reference_coverage"]
    known = spec["reference_values"]
    if not isinstance(known, DataFrame):
        known = suite.df.sparkSession.createDataFrame([(str(v),) for v in known], "value string")
    hits = coverage(suite.values(spec["column"]), known).first()["hits"] if suite.rows else 0
    yield suite.at_least(
        spec.get("name", "reference_coverage"), suite.share(hits, 0.0), float(spec["min_rate"]),
        f"rows whose {spec['column']} is in the reference set")


def _duplicates(suite: _Suite) -> Iterator[CheckResult]:
    repeats = repeated_rows(suite.df) if suite.rows else 0
    yield suite.at_most("duplicate_rate", suite.share(repeats, 0.0),
                        float(suite.config["duplicate_max_rate"]), "rows that repeat an earlier row")


def _mapped(suite: _Suite) -> Iterator[CheckResult]:
    spec = suite.config["mapped_value_coverage"]
    yield suite.at_least(
        spec.get("name", "mapped_value_coverage"), suite.share(suite.measured["mapped"], 0.0),
        float(spec["min_rate"]), f"rows whose {spec['column']} is not an unknown value")


def _freshness(suite: _Suite) -> Iterator[CheckResult]:
    spec = suite.config["freshness"]
    column, limit = spec["date_column"], int(spec["max_age_days"])
    newest = suite.measured["latest"] if suite.rows else suite.run_date
    if newest is None:
        passed, measure = False, "no parseable date"
    else:
        age = (suite.run_date - newest).days
        passed = age <= limit
        measure = FRESHNESS_MEASURE.format(column=column, newest=newest.isoformat(), age=age)
    yield suite.result("freshness", passed, measure, f"<= {limit} days",
                       "an old newest date means that the feed stopped")


def _volume(suite: _Suite) -> Iterator[CheckResult]:
    spec = suite.config["volume_anomaly"]
    ceiling = float(spec["max_deviation"])
    minimum = int(spec.get("min_periods", DEFAULT_MIN_PERIODS))
    found = volume_deviation(suite.values(spec["period_column"]), minimum).first()
    if found["periods"] < minimum or found["latest"] is None:
        yield suite.result("volume_anomaly", False, NO_HISTORY, f"<= {ceiling}",
                           f"{found['periods']} periods, {minimum} needed")
        return
    # too few periods for a baseline leave the deviation undefined, which fails
    deviation = math.nan if found["deviation"] is None else found["deviation"]
    yield suite.at_most("volume_anomaly", deviation, ceiling,
                        f"latest full period has {int(found['latest'])} rows, "
                        f"periods before it {found['baseline'] or 0:.0f} on average")


def _tail(suite: _Suite) -> Iterator[CheckResult]:
    spec = suite.config["long_tail"]
    limit = int(spec["max_count"])
    found = long_tail(suite.values(spec["column"]), limit).first()
    rate = found["tail_rows"] / found["rows"] if found["rows"] else 1.0
    yield suite.at_most(spec.get("name", "long_tail_rate"), rate, float(spec["max_rate"]),
                        f"rows whose {spec['column']} occurs at most {limit} times")


# config key -> check, in the order of the report
CHECKS: dict[str, Callable[[_Suite], Iterator[CheckResult]]] = {
    "required_columns": _schema,
    "timestamp_column": _timestamps,
    "not_blank_max_rates": _blanks,
    "non_negative_columns": _negatives,
    "reference_coverage": _references,
    "duplicate_max_rate": _duplicates,
    "mapped_value_coverage": _mapped,
    "freshness": _freshness,
    "volume_anomaly": _volume,
    "long_tail": _tail,
}
_COUNTED = {"reference_coverage", "duplicate_max_rate"}  # need the row count, nothing else fused


def _fused(df: DataFrame, config: Mapping) -> dict:
    """The row count and all plain aggregates the config asks for, in one pass."""
    measures = {}
    if "timestamp_column" in config:
        measures["parsed"] = count_parseable(df, config["timestamp_column"])
    for column in config.get("not_blank_max_rates", {}):
        measures[f"blank:{column}"] = count_blank(column)
    for column in config.get("non_negative_columns", []):
        measures[f"negative:{column}"] = count_negative(column)
    if "mapped_value_coverage" in config:
        spec = config["mapped_value_coverage"]
        measures["mapped"] = count_mapped(
            spec["column"], spec.get("unknown_values", DEFAULT_UNKNOWN_VALUES))
    if "freshness" in config:
        measures["latest"] = latest_date(df, config["freshness"]["date_column"])
    if not measures and not _COUNTED & set(config):
        return {}
    measures["rows"] = F.count(F.lit(1))
    return df.agg(*[m.alias(name) for name, m in measures.items()]).first().asDict()


def run_checks(
    df: DataFrame, config: Mapping, run_date: dt.date | None = None,
    counts: Mapping[str, DataFrame] | None = None,
) -> list[CheckResult]:
    """Run the checks named in ``config``, in a fixed order."""
    unknown = sorted(set(config) - set(KNOWN_KEYS))
    if unknown:
        raise ValueError(UNKNOWN_KEYS.format(keys=unknown))
    suite = _Suite(df, config, str(config.get("layer", "dataset")),
                   run_date or dt.date.today(), _fused(df, config), counts or {})
    return [result for key, check in CHECKS.items() if key in config for result in check(suite)]


# --- preset, report, gate ---------------------------------------------------

def preset_configs(reference_values, limits: Mapping = THRESHOLDS) -> tuple[dict, dict]:
    """The (bronze, silver) check configs of the incident dataset."""
    bronze = {"layer": "bronze", "required_columns": list(BRONZE_REQUIRED)}
    silver = {
        "layer": "silver",
        "timestamp_column": "event_ts",
        "timestamp_parse_min_rate": limits["timestamp_parse_min_rate"],
        "not_blank_max_rates": {"station": limits["station_blank_max_rate"]},
        "non_negative_columns": ["min_delay"],
        "reference_coverage": {
            "name": "code_reference_coverage", "column": "code_clean",
            "min_rate": limits["code_reference_min_rate"],
            "reference_values": reference_values,
        },
        "duplicate_max_rate": limits["duplicate_max_rate"],
        "mapped_value_coverage": {
            "name": "canonical_line_rate", "column": "line_canonical",
            "unknown_values": ["UNKNOWN"], "min_rate": limits["canonical_line_min_rate"],
        },
        "freshness": {
            "date_column": "event_date", "max_age_days": limits["freshness_max_age_days"],
        },
        "volume_anomaly": {
            "period_column": "event_year_month",
            "max_deviation": limits["volume_max_deviation"],
            "min_periods": limits["volume_min_periods"],
        },
        "long_tail": {
            "name": "station_long_tail_rate", "column": "station",
            "max_count": limits["long_tail_max_count"], "max_rate": limits["long_tail_max_rate"],
        },
    }
    return bronze, silver


def run_preset(
    bronze: DataFrame, silver: DataFrame, reference_values,
    run_date: dt.date | None = None, limits: Mapping = THRESHOLDS,
    counts: Mapping[str, DataFrame] | None = None,
) -> list[CheckResult]:
    """The ten preset checks: one on bronze, nine on silver.

    With ``counts`` from the cubes, silver is read for the plain aggregates and
    for the duplicates alone.
    """
    bronze_config, silver_config = preset_configs(reference_values, limits)
    columns = [f for f in silver.columns if not f.startswith("partition_")]
    return (run_checks(bronze, bronze_config, run_date)
            + run_checks(silver.select(*columns), silver_config, run_date, counts))


def results_frame(spark: SparkSession, results: Iterable[CheckResult]) -> DataFrame:
    """Check results as rows; numbers are also in ``measured_value``."""
    rows = [
        (r.name, r.layer, bool(r.passed), str(r.measured),
         None if isinstance(r.measured, str) else float(r.measured), r.threshold, r.detail)
        for r in results
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def summarise(results: DataFrame, dataset: str, rows: int) -> DataFrame:
    """One report row: dataset, rows, checks passed and total, and the checks."""
    return results.agg(
        F.lit(dataset).alias("dataset"),
        F.lit(rows).cast("bigint").alias("rows"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
        F.collect_list(F.struct(
            "name", "layer", "passed", "measured", "threshold", "detail")).alias("checks"),
    )


def assert_passed(results: Iterable[CheckResult]) -> None:
    """Stop a publish when any check failed."""
    failed = [f"{r.name} ({r.measured}, limit {r.threshold})" for r in results if not r.passed]
    if failed:
        raise QualityGateError("failed checks: " + "; ".join(failed))


def layer_counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows per layer and how many were rejected or dropped as copies."""
    def counted(df: DataFrame, layer: str) -> DataFrame:
        return df.select(F.lit(layer).alias("layer"))

    both = counted(bronze, "bronze").unionByName(counted(silver, "silver"))
    return both.agg(
        F.count_if(F.col("layer") == "bronze").alias("bronze"),
        F.count_if(F.col("layer") == "silver").alias("silver"),
    ).withColumn("silver_rejects_or_duplicates_removed", F.col("bronze") - F.col("silver"))
