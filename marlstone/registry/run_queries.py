"""The whole run from raw files, its report, and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marlstone.config import FeedConfig, SourceSpec
from marlstone.plans import medallion
from marlstone.registry.base import query
from marlstone.registry.column_queries import silver_table
from marlstone.registry.gold_queries import MEAN
from marlstone.registry.inputs import (
    TEXT_FEED, TYPED_FEED, code_list, text_feed, typed_feed,
)
from marlstone.registry.source_queries import write_csv
from marlstone.registry.sql import over
from marlstone.sources import sinks
from marlstone.sources.readers import ROW_ID

RUN_DATE = dt.date(2024, 3, 15)
_SUMS = "count(*) AS incidents, sum(min_delay) AS total_delay_minutes"
_AVERAGE = f"floor({MEAN} * 100 + 0.5) / 100 AS avg_delay_minutes_when_delayed"


def raw_files(spark, sf_dir, root: str | None = None, falling: bool = False) -> FeedConfig:
    """Both feeds and the code list as published files, rows in id order (or the opposite one)."""
    root = root or sinks.work_path(spark, "raw")
    order = F.col(ROW_ID).desc() if falling else F.col(ROW_ID)
    typed = typed_feed(spark, sf_dir).orderBy(order).withColumnRenamed(ROW_ID, "_id")
    typed.write.mode("overwrite").parquet(f"{root}/typed")
    write_csv(text_feed(spark, sf_dir).orderBy(order).withColumnRenamed(ROW_ID, "_id"), f"{root}/text")
    codes = code_list(spark, sf_dir).orderBy("code", ROW_ID).withColumnRenamed(ROW_ID, "_id")
    if not falling:
        write_csv(codes, f"{root}/codes")
    return FeedConfig(
        sources=(SourceSpec(TYPED_FEED, f"{root}/typed", "parquet"), SourceSpec(TEXT_FEED, f"{root}/text")),
        codes=SourceSpec("code_list", f"{root}/codes"),
    )


def _run(spark, sf_dir) -> str:
    cfg = raw_files(spark, sf_dir)
    root = sinks.work_path(spark, "run")
    medallion.run(spark, cfg, root, RUN_DATE)
    return root


@query("l1_medallion_daily_summary", over("silver", f"""
    SELECT event_date, {_SUMS},
           CAST(sum(CASE WHEN min_delay > 0 THEN 1 ELSE 0 END) AS BIGINT) AS incidents_with_delay,
           {_AVERAGE}, count(DISTINCT station) AS stations_affected
    FROM silver GROUP BY event_date"""))
def medallion_daily_summary(spark, sf_dir):
    """Raw files to gold; this is the stored daily table."""
    return spark.read.parquet(_run(spark, sf_dir) + "/gold/daily_summary")


@query("l2_rebuild_twice", over("silver", f"""
    SELECT station, {_SUMS}, {_AVERAGE} FROM silver WHERE station <> '' GROUP BY station"""))
def rebuild_twice(spark, sf_dir):
    """A second run over rewritten files with the same rows rebuilds all months, and counts nothing twice."""
    raw, root = sinks.work_path(spark, "raw"), sinks.work_path(spark, "run")
    for falling in (False, True):
        medallion.run(spark, raw_files(spark, sf_dir, raw, falling), root, RUN_DATE)
    return spark.read.parquet(root + "/gold/delays_by_station")


@query("s18_run_report", over("silver", """
    SELECT (SELECT count(*) FROM bronze) AS bronze, (SELECT count(*) FROM silver) AS silver,
           CAST(10 AS BIGINT) AS checks_total"""))
def run_report(spark, sf_dir):
    report = spark.read.schema(medallion.REPORT_SCHEMA).json(
        _run(spark, sf_dir) + "/reports/latest_run")
    return report.select("row_counts.bronze", "row_counts.silver", "checks_total")


@query("s13_exported_totals", over("silver", f"""
    SELECT CAST(year(event_date) AS INT) AS event_year,
           CASE line_canonical WHEN 'LINE_1_YONGE_UNIVERSITY' THEN 'L1' WHEN 'LINE_2_BLOOR_DANFORTH' THEN 'L2'
                WHEN 'LINE_4_SHEPPARD' THEN 'L4' WHEN 'LINE_3_SCARBOROUGH_RT' THEN 'L3'
                WHEN 'MULTI_LINE_OR_NETWORK' THEN 'ML' ELSE 'UNK' END AS line,
           {_SUMS}, count(DISTINCT station) AS stations
    FROM silver GROUP BY ALL"""))
def exported_totals(spark, sf_dir):
    return spark.read.schema(
        "event_year int, line string, incidents bigint, total_delay_minutes double, stations bigint"
    ).json(_run(spark, sf_dir) + "/export/totals_by_year_line")


@query("l3_reconciliation", over("silver", f"""
    SELECT {_SUMS}, true AS incidents_agree, true AS totals_agree FROM silver"""))
def reconciliation(spark, sf_dir):
    path = sinks.work_path(spark, "silver")
    sinks.write_silver(silver_table(spark, sf_dir), path)
    layout = medallion.Layout(sinks.work_path(spark, "cubes"))
    cubes = medallion.store_cubes(sinks.read_silver(spark, path), layout)
    return medallion.reconcile(cubes)
