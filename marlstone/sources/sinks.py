"""Sinks: partitioned and plain tables, JSON records, the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.config import PARTITION_COLUMNS, SILVER_SCHEMA

SILVER_ORDER = ("line_canonical", "station")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without one gets a temporary folder: on a cluster every
    executor would write to a disk of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="marlstone-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/marlstone/{label}-{uuid.uuid4().hex}"


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through files in the shared folder."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str] = PARTITION_COLUMNS, gather: bool = True,
    replace: bool = False, order: Sequence[str] = (),
) -> None:
    """Replace only the partitions present in ``df``; others stay unless ``replace``.

    Rows are gathered per partition so that tasks x partitions small files do
    not appear; the rebalance splits a partition that is too big for one task.
    Input already in partition order needs no gathering and so no shuffle.
    ``order`` puts the rows of a file in order: the writer sorts by the
    partition columns anyway.
    """
    rows = df.hint("rebalance", *[F.col(k) for k in keys]) if gather else df
    if order:
        rows = rows.sortWithinPartitions(*keys, *order)
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if replace else "dynamic")
         .partitionBy(*keys).parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    """Full rebuild; an empty frame leaves an empty table, not the old one."""
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """One record per line, ISO dates, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def with_months(silver: DataFrame) -> DataFrame:
    """Silver with the two columns of its layout."""
    return silver.withColumns({
        "partition_year": F.year("event_date"), "partition_month": F.month("event_date"),
    })


def write_silver(df: DataFrame, path: str) -> None:
    """Full rebuild of silver, by month so that period filters prune folders, and within a
    month by line and station, so that a selection skips the row groups of others."""
    write_partitioned(with_months(df), path, replace=True, order=SILVER_ORDER)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver with its fixed schema, then the two layout columns."""
    layout = [T.StructField(key, T.IntegerType()) for key in PARTITION_COLUMNS]
    return spark.read.schema(T.StructType(SILVER_SCHEMA.fields + layout)).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path, as Spark lists files below it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of this library's own that is no longer read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def publish_view(df: DataFrame, name: str = "silver_delays") -> DataFrame:
    """Make a frame visible to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df
