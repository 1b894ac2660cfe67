"""Check one dataset: load it, run the configured checks, report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from marlstone.operators import quality
from marlstone.sources.readers import load_dataset


def check_dataset(
    spark: SparkSession, path: str, config: Mapping,
    table: str | None = None, run_date: dt.date | None = None,
) -> DataFrame:
    """One report row for a .parquet or .csv path or a catalog table."""
    df = load_dataset(spark, path, table)
    results = quality.run_checks(df, config, run_date)
    name = str(config.get("dataset_name", path))
    return quality.summarise(quality.results_frame(spark, results), name, df.count())
