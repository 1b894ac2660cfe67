"""Q1-Q15: the checks, one by one and as suites."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marlstone.config import BRONZE_REQUIRED
from marlstone.operators import quality
from marlstone.registry.base import query
from marlstone.registry.column_queries import bronze, silver_table
from marlstone.registry.inputs import clicks, code_list, shipments, table
from marlstone.registry.sql import over
from marlstone.sources import sinks
from marlstone.sources.readers import reference_codes

RUN_DATE = dt.date(2024, 3, 15)
_RUN = "DATE '2024-03-15'"


def _results(spark, results):
    """Check results without the free-text detail."""
    return quality.results_frame(spark, results).drop("detail")


def _checked(spark, df, config):
    return _results(spark, quality.run_checks(df, config, RUN_DATE))


def _row(name: str, layer: str, rate: str, test: str, threshold: str, source: str) -> str:
    """One result row whose measure is a rounded rate."""
    return f"""
    SELECT '{name}' AS name, '{layer}' AS layer, rate {test} AS passed,
           CAST(round(rate, 4) AS VARCHAR) AS measured, round(rate, 4) AS measured_value,
           '{threshold}' AS threshold
    FROM (SELECT {rate} AS rate FROM {source})"""


_PASSED_SCHEMA = """
    SELECT 'schema_conformance' AS name, '{layer}' AS layer, {present} = {total} AS passed,
           concat({present}, '/{total} required columns present') AS measured,
           CAST(NULL AS DOUBLE) AS measured_value, 'all required columns present' AS threshold"""


def _present(source: str, columns) -> str:
    names = ", ".join(f"'{c}'" for c in columns)
    return f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {source}) WHERE column_name IN ({names}))"


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate", "o_comment")  # there is no o_comment


@query("q1_schema_conformance", _PASSED_SCHEMA.format(
    layer="raw", total=4, present=_present("orders", _ORDER_COLUMNS)))
def schema_conformance(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "orders"), {
        "layer": "raw", "required_columns": list(_ORDER_COLUMNS)})


@query("q2_timestamp_parse_rate", over("typed", _row(
    "timestamp_parse_rate", "bronze", "count(event_ts) / count(*)", ">= 0.99", ">= 0.99", "typed")))
def timestamp_parse_rate(spark, sf_dir):
    text = F.concat("date", F.lit(" "), F.col("time"))
    return _checked(spark, bronze(spark, sf_dir).withColumn("event_text", text), {
        "layer": "bronze", "timestamp_column": "event_text"})


@query("q2_timestamp_parse_rate_typed", _row(
    "timestamp_parse_rate", "dataset", "count(ts) / count(*)", ">= 1.0", ">= 1.0", "events"))
def timestamp_parse_rate_typed(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "events"), {
        "timestamp_column": "ts", "timestamp_parse_min_rate": 1})


@query("q3_blank_rate", over("clicks", _row(
    "station_raw_null_rate", "dataset", "count_if(trim(station_raw) = '') / count(*)",
    "<= 0.01", "<= 0.01", "clicks")))
def blank_rate(spark, sf_dir):
    return _checked(spark, clicks(spark, sf_dir), {"not_blank_max_rates": {"station_raw": 0.01}})


@query("q4_non_negative", over("bronze", """
    SELECT concat('non_negative_', which) AS name, 'bronze' AS layer, n = 0 AS passed,
           CAST(n AS VARCHAR) AS measured, CAST(n AS DOUBLE) AS measured_value, '== 0' AS threshold
    FROM (SELECT 'min_delay' AS which, count_if(TRY_CAST(min_delay AS DOUBLE) < 0) AS n FROM bronze
          UNION ALL
          SELECT 'min_gap', count_if(TRY_CAST(min_gap AS DOUBLE) < 0) FROM bronze)"""))
def non_negative(spark, sf_dir):
    return _checked(spark, bronze(spark, sf_dir), {
        "layer": "bronze", "non_negative_columns": ["min_delay", "min_gap"]})


@query("q5_reference_coverage", over("silver", _row(
    "code_reference_coverage", "silver", "count(code_description) / count(*)",
    ">= 0.9", ">= 0.9", "silver")))
def reference_coverage(spark, sf_dir):
    return _checked(spark, silver_table(spark, sf_dir), {
        "layer": "silver", "reference_coverage": {
            "name": "code_reference_coverage", "column": "code_clean", "min_rate": 0.9,
            "reference_values": reference_codes(code_list(spark, sf_dir))}})


@query("q5_reference_coverage_list", _row(
    "reference_coverage", "dataset", "count_if(event_type IN ('click', 'view', 'purchase')) / count(*)",
    ">= 0.5", ">= 0.5", "events"))
def reference_coverage_list(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "events"), {"reference_coverage": {
        "column": "event_type", "min_rate": 0.5, "reference_values": [" Click", "VIEW ", "purchase"]}})


@query("q5_reference_coverage_large", _row(
    "reference_coverage", "dataset",
    "count_if(doc_id IN (SELECT doc_id FROM labels)) / count(*)", ">= 0.3", ">= 0.3", "documents"))
def reference_coverage_large(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "documents"), {"reference_coverage": {
        "column": "doc_id", "min_rate": 0.3,
        "reference_values": table(spark, sf_dir, "labels").select("doc_id")}})


@query("q6_duplicate_rate", _row(
    "duplicate_rate", "dataset",
    "1.0::DOUBLE * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text FROM documents))) / count(*)",
    "<= 0.01", "<= 0.01", "documents"))
def duplicate_rate(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "documents").select("text"),
                    {"duplicate_max_rate": 0.01})


@query("q6_duplicate_rate_clean", _row(
    "duplicate_rate", "dataset",
    "1.0::DOUBLE * (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders))) / count(*)",
    "<= 0.0", "<= 0.0", "orders"))
def duplicate_rate_clean(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "orders"), {"duplicate_max_rate": 0})


@query("q7_mapped_value_coverage", over("silver", _row(
    "canonical_line_rate", "silver", "count_if(line_canonical <> 'UNKNOWN') / count(*)",
    ">= 0.9", ">= 0.9", "silver")))
def mapped_value_coverage(spark, sf_dir):
    return _checked(spark, silver_table(spark, sf_dir), {
        "layer": "silver", "mapped_value_coverage": {
            "name": "canonical_line_rate", "column": "line_canonical",
            "unknown_values": ["UNKNOWN"], "min_rate": 0.9}})


def _freshness(column: str, source: str, limit: int, layer: str) -> str:
    return f"""
    SELECT 'freshness' AS name, '{layer}' AS layer, age <= {limit} AS passed,
           concat('max {column} ', newest, ', ', age, ' days before run date') AS measured,
           CAST(NULL AS DOUBLE) AS measured_value, '<= {limit} days' AS threshold
    FROM (SELECT newest, date_diff('day', newest, {_RUN}) AS age
          FROM (SELECT CAST(max({column}) AS DATE) AS newest FROM {source}))"""


@query("q8_freshness", _freshness("ts", "events", 75, "dataset"))
def freshness(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "events"),
                    {"freshness": {"date_column": "ts", "max_age_days": 75}})


@query("q8_freshness_stale", _freshness("o_orderdate", "orders", 75, "dataset"))
def freshness_stale(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "orders"),
                    {"freshness": {"date_column": "o_orderdate", "max_age_days": 75}})


def _volume(counts: str, limit: str, layer: str = "dataset") -> str:
    """``counts`` has (period, n); newest is left out, the one before meets the mean before it."""
    return f"""
    SELECT 'volume_anomaly' AS name, '{layer}' AS layer, rate <= {limit} AS passed,
           CAST(round(rate, 4) AS VARCHAR) AS measured, round(rate, 4) AS measured_value,
           '<= {limit}' AS threshold
    FROM (SELECT abs(latest - baseline) / baseline AS rate
          FROM (SELECT CAST(max(CASE WHEN rn = 2 THEN n END) AS DOUBLE) AS latest,
                       avg(CASE WHEN rn BETWEEN 3 AND 8 THEN n END) AS baseline
                FROM (SELECT n, row_number() OVER (ORDER BY period DESC) AS rn
                      FROM ({counts}))))"""


_ORDER_MONTHS = """
    SELECT strftime(o_orderdate, '%Y-%m') AS period, count(*) AS n FROM orders GROUP BY 1"""


@query("q9_volume_anomaly", _volume(_ORDER_MONTHS, "0.6"))
def volume_anomaly(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn(
        "month", F.date_format("o_orderdate", "yyyy-MM"))
    return _checked(spark, orders, {
        "volume_anomaly": {"period_column": "month", "max_deviation": 0.6}})


@query("q9_volume_anomaly_shipments", over("shipments", _volume("""
    SELECT event_year_month AS period, count(*) AS n FROM shipments GROUP BY 1""", "0.05")))
def volume_anomaly_shipments(spark, sf_dir):
    return _checked(spark, shipments(spark, sf_dir), {
        "volume_anomaly": {"period_column": "event_year_month", "max_deviation": 0.05}})


@query("q9_volume_insufficient_history", over("clicks", """
    SELECT 'volume_anomaly' AS name, 'dataset' AS layer, false AS passed,
           'insufficient history' AS measured, CAST(NULL AS DOUBLE) AS measured_value,
           '<= 0.6' AS threshold
    FROM clicks HAVING count(DISTINCT event_year_month) < 7"""))
def volume_insufficient_history(spark, sf_dir):
    return _checked(spark, clicks(spark, sf_dir), {
        "volume_anomaly": {"period_column": "event_year_month", "max_deviation": 0.6}})


def _tail(column: str, source: str, limit: int) -> str:
    return f"""(SELECT sum(n) AS total, sum(CASE WHEN n <= {limit} AND v IS NOT NULL THEN n ELSE 0 END) AS tail
     FROM (SELECT {column} AS v, count(*) AS n FROM {source} GROUP BY 1))"""


@query("q10_long_tail", _row(
    "long_tail_rate", "dataset", "CAST(tail AS DOUBLE) / CAST(total AS DOUBLE)", "<= 0.1", "<= 0.1",
    _tail("o_custkey", "orders", 8)))
def long_tail(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "orders"), {
        "long_tail": {"column": "o_custkey", "max_count": 8, "max_rate": 0.1}})


@query("q10_long_tail_texts", _row(
    "text_long_tail", "dataset", "CAST(tail AS DOUBLE) / CAST(total AS DOUBLE)", "<= 0.95", "<= 0.95",
    _tail("text", "documents", 1)))
def long_tail_texts(spark, sf_dir):
    return _checked(spark, table(spark, sf_dir, "documents"), {
        "long_tail": {"name": "text_long_tail", "column": "text", "max_count": 1, "max_rate": 0.95}})


_MAPPED = "count_if(line_canonical NOT IN ('UNKNOWN', '')) / count(*)"


@query("q11_suite_in_order", over("silver", " UNION ALL ".join([
    _PASSED_SCHEMA.format(layer="silver", total=2, present=_present("silver", ("event_ts", "station"))),
    _row("timestamp_parse_rate", "silver", "count(event_ts) / count(*)", ">= 0.99", ">= 0.99", "silver"),
    _row("station_null_rate", "silver", "count_if(station = '') / count(*)", "<= 0.05", "<= 0.05", "silver"),
    _row("bound_null_rate", "silver", "count_if(bound = '') / count(*)", "<= 0.5", "<= 0.5", "silver"),
    _row("mapped_value_coverage", "silver", _MAPPED, ">= 0.5", ">= 0.5", "silver"),
])))
def suite_in_order(spark, sf_dir):
    """Several checks from one fused pass."""
    return _checked(spark, silver_table(spark, sf_dir), {
        "dataset_name": "incidents", "layer": "silver",
        "required_columns": ["event_ts", "station"], "timestamp_column": "event_ts",
        "not_blank_max_rates": {"station": 0.05, "bound": 0.5},
        "mapped_value_coverage": {"column": "line_canonical", "min_rate": 0.5}})


_DISTINCT_SILVER = "(SELECT count(*) FROM (SELECT DISTINCT * FROM silver))"
_PRESET = over("silver", " UNION ALL ".join([
    _PASSED_SCHEMA.format(
        layer="bronze", total=len(BRONZE_REQUIRED), present=_present("bronze", BRONZE_REQUIRED)),
    _row("timestamp_parse_rate", "silver", "count(event_ts) / count(*)", ">= 0.99", ">= 0.99", "silver"),
    _row("station_null_rate", "silver", "count_if(station = '') / count(*)", "<= 0.01", "<= 0.01", "silver"),
    """
    SELECT 'non_negative_min_delay', 'silver', n = 0, CAST(n AS VARCHAR), CAST(n AS DOUBLE), '== 0'
    FROM (SELECT count_if(min_delay < 0) AS n FROM silver)""",
    _row("code_reference_coverage", "silver", "count(code_description) / count(*)", ">= 0.9", ">= 0.9", "silver"),
    _row("duplicate_rate", "silver", f"1.0::DOUBLE * (count(*) - {_DISTINCT_SILVER}) / count(*)",
         "<= 0.01", "<= 0.01", "silver"),
    _row("canonical_line_rate", "silver", "count_if(line_canonical <> 'UNKNOWN') / count(*)",
         ">= 0.9", ">= 0.9", "silver"),
    _freshness("event_date", "silver", 75, "silver"),
    _volume("""SELECT event_year_month AS period, count(*) AS n FROM silver
               WHERE event_year_month IS NOT NULL GROUP BY 1""", "0.6", "silver"),
    _row("station_long_tail_rate", "silver", "CAST(tail AS DOUBLE) / CAST(total AS DOUBLE)",
         "<= 0.1", "<= 0.1", _tail("station", "silver", 5)),
]))


def _stored_silver(spark, sf_dir):
    """Silver, made once and stored, so that each check or count is a scan of it."""
    path = sinks.work_path(spark, "silver")
    sinks.write_silver(silver_table(spark, sf_dir), path)
    return sinks.read_silver(spark, path)


def _preset(spark, sf_dir, silver):
    """The ten preset checks on stored silver."""
    return quality.run_preset(
        bronze(spark, sf_dir), silver, reference_codes(code_list(spark, sf_dir)), RUN_DATE)


@query("q12_preset_suite", _PRESET)
def preset_suite(spark, sf_dir):
    return _results(spark, _preset(spark, sf_dir, _stored_silver(spark, sf_dir)))


@query("q13_report_summary", over("silver", f"""
    SELECT 'incidents' AS dataset, (SELECT count(*) FROM silver) AS rows,
           CAST(count_if(passed) AS BIGINT) AS checks_passed, count(*) AS checks_total
    FROM ({_PRESET})"""))
def report_summary(spark, sf_dir):
    silver = _stored_silver(spark, sf_dir)
    results = quality.results_frame(spark, _preset(spark, sf_dir, silver))
    return quality.summarise(results, "incidents", silver.count()).drop("checks")


@query("q14_quality_gate", over("shipments", f"""
    SELECT event_date, count(*) AS incidents FROM shipments
    WHERE (SELECT min(min_delay) FROM shipments) >= 0 GROUP BY event_date"""))
def quality_gate(spark, sf_dir):
    """Published only because the checks pass; a failed one would raise here."""
    rows = shipments(spark, sf_dir)
    quality.assert_passed(quality.run_checks(
        rows, {"non_negative_columns": ["min_delay"], "timestamp_column": "event_date"}, RUN_DATE))
    return rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("incidents"))


@query("q15_layer_counts", over("silver", """
    SELECT (SELECT count(*) FROM bronze) AS bronze, (SELECT count(*) FROM silver) AS silver,
           (SELECT count(*) FROM bronze) - (SELECT count(*) FROM silver)
             AS silver_rejects_or_duplicates_removed"""))
def layer_counts(spark, sf_dir):
    return quality.layer_counts(bronze(spark, sf_dir), silver_table(spark, sf_dir))
