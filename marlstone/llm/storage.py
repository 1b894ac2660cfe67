"""What outlives a step: tables in the folder that all share, and objects of a worker."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame

from marlstone.sources.sinks import work_path

T = TypeVar("T")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, nothing is recomputed."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once_per_worker(key: tuple, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept by the Python worker for its later tasks.

    This package travels by value, so its own globals are new in every task; the
    worker's ``sys`` module is not.
    """
    kept = sys.__dict__.setdefault("_marlstone_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
