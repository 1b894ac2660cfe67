"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated list of query names (or "all").
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from marlstone.registry import catalog  # noqa: E402

HEADLINE = (
    "a1_daily_summary", "a2_monthly_trend", "a3_delays_by_hour", "a4_delays_by_line",
    "a5_delays_by_station", "a6_delays_by_code", "a7_headline", "a8_totals_by_year_line",
    "a10_monthly_by_line", "a11_daily_by_line", "a12_totals_by_quarter_line",
    "t3_top_stations_by_year_line", "t4_top_codes_by_year_line",
    "t5_top_stations_by_quarter_line", "t6_top_codes_by_quarter_line", "t7_rolling_daily",
    "t9_rank_stations_line_all_years", "p1_clean_whole_documents", "p3_canonical_line",
    "p4_mojibake_repair", "p8_number_parse", "p11_silver_projection", "j1_code_lookup",
    "d1_keep_first", "d1_keep_first_without_row_id", "d2_duplicate_rows", "q9_volume_anomaly",
    "q10_long_tail", "q11_suite_in_order", "q12_preset_suite", "s1_text_source",
    "s8_partitioned_bronze", "l1_medallion_daily_summary",
)


RUNS, LONG_SECONDS = 3, 4.0  # the median of three runs; one run of what takes longer


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(catalog.QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("marlstone-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    seconds = {}
    for name in names:
        runs = []
        while not runs or (len(runs) < RUNS and runs[0] < LONG_SECONDS):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
