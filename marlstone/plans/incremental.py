"""Rebuilding only the months that changed files touch, with the result of a full run.

Copies of an incident share its timestamp, so a month's silver comes from that
month's rows alone. Rows without a timestamp are the exception: their copies can
lie in any month. All of them stay in a table of their own, and are deduplicated
together; a month is also rebuilt where its share of them comes out otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.config import PARTITION_COLUMNS, SILVER_COLUMNS, FeedConfig
from marlstone.operators import silver as typed_rows
from marlstone.sources import bronze as bronze_layer
from marlstone.sources import manifest as manifests
from marlstone.sources import sinks
from marlstone.sources.readers import ROW_ID, file_address, listed_address, read_source

Month = tuple[int, int]
TIMESTAMP_KEY = "event_ts"


@dataclass(frozen=True)
class Change:
    """What a run has to do anew.

    ``touched`` are addresses of new, changed and gone files, ``files`` those to
    be read: every file that has rows in one of ``months``.
    """

    months: list[Month]
    files: list[str]
    touched: list[str]
    file_months: DataFrame


def supported(cfg: FeedConfig) -> bool:
    """Months can be rebuilt alone if files are known and copies share a timestamp."""
    return all(s.format != "table" for s in cfg.sources) and TIMESTAMP_KEY in cfg.dedupe_keys


def in_months(months: Iterable[Month], columns: Sequence[str] = PARTITION_COLUMNS) -> Column:
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    terms = [(F.col(columns[0]) == year) & F.col(columns[1]).isin(*sorted(found))
             for year, found in sorted(by_year.items())]
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def months_of_files(bronze: DataFrame) -> DataFrame:
    """(logical_name, address, partition_year, partition_month, rows) of bronze rows read from files.

    Rows are counted by file first, so that addresses are decoded once a file and not once a row.
    """
    counted = bronze.groupBy("source_file", F.col(ROW_ID)["file"].alias("_file"), *PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("_rows"))
    return counted.groupBy(
        F.col("source_file").alias("logical_name"), file_address(F.col("_file")).alias("address"),
        *PARTITION_COLUMNS).agg(F.sum("_rows").alias("rows"))


def months_in(file_months: DataFrame) -> list[Month]:
    """The calendar bounds their number."""
    return sorted((r[0], r[1]) for r in file_months.select(*PARTITION_COLUMNS).distinct().collect())


def read_files(spark: SparkSession, cfg: FeedConfig, addresses: Sequence[str]) -> DataFrame:
    """Bronze rows of some files alone, typed as if all had been read."""
    return bronze_layer.unify([(s.name, read_source(spark, s, addresses)) for s in cfg.sources], cfg)


def find_change(
    spark: SparkSession, cfg: FeedConfig, current: DataFrame, previous: DataFrame, file_months: DataFrame,
    work: str,
) -> Change | None:
    """What the files' changes since the last run ask for; None where the code reference is among them.

    Reads the new and changed files, and no others.
    """
    changed, gone = manifests.changed_files(current), manifests.gone_files(current, previous)
    address = listed_address(F.col("source_url"))
    touched = changed.select("logical_name", address.alias("address"), F.lit(True).alias("there")).unionByName(
        gone.select("logical_name", address.alias("address"), F.lit(False).alias("there"))).collect()
    if any(r["logical_name"] not in {s.name for s in cfg.sources} for r in touched):
        return None
    new = [r["address"] for r in touched if r["there"]]
    addresses = [r["address"] for r in touched]
    before = file_months.where(F.col("address").isin(addresses))
    found = months_of_files(read_files(spark, cfg, new))
    path = f"{work}/file_months"
    sinks.write_table(file_months.where(~F.col("address").isin(addresses)).unionByName(found), path)
    after = spark.read.schema(file_months.schema).parquet(path)
    months = sorted({*months_in(before), *months_in(after.where(F.col("address").isin(new)))})
    files = after.where(in_months(months)).select("address").distinct().collect()
    return Change(months, [r["address"] for r in files], addresses, after)


def untimed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(TIMESTAMP_KEY).isNull())


def _digests(silver: DataFrame) -> DataFrame:
    """Per month the number of rows without a timestamp and a digest of them as a bag."""
    hashed = untimed(silver).select(
        F.year("event_date").alias("year"), F.month("event_date").alias("month"), F.xxhash64(*SILVER_COLUMNS).alias("h"))
    return hashed.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"),
        F.bit_xor(F.xxhash64("h")).alias("y"), F.sum(F.shiftright("h", 32)).alias("s"))


def differing_months(before: DataFrame, after: DataFrame) -> list[Month]:
    """Months whose rows without a timestamp are not the same in two states of silver."""
    a, b = _digests(before), _digests(after)
    odd = a.exceptAll(b).unionByName(b.exceptAll(a)).select("year", "month").distinct()
    return sorted((r[0], r[1]) for r in odd.collect())


def replace_months(rows: DataFrame, path: str, months: Iterable[Month], order: Sequence[str] = ()) -> None:
    """The stored ``rows`` take the place of the months' partitions below ``path``.

    A month without rows loses its folder. ``rows`` has the partition columns and
    is not read from ``path``.
    """
    spark = rows.sparkSession
    there = set(months_in(rows))
    sinks.write_partitioned(rows, path, order=order)
    for year, month in set(months) - there:
        sinks.remove(spark, f"{path}/{PARTITION_COLUMNS[0]}={year}/{PARTITION_COLUMNS[1]}={month}")


def stored(df: DataFrame, path: str) -> DataFrame:
    sinks.write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rebuilt_silver(
    typed: DataFrame, change: Change, old_untimed: DataFrame, silver: DataFrame, cfg: FeedConfig, work: str,
) -> tuple[DataFrame, DataFrame, list[Month]]:
    """(silver rows of the months that change, all candidates without a timestamp, those months).

    ``typed`` holds the typed rows of the change's files, all months of them, so
    that the order of one file's rows always comes from one reading of it.
    """
    rows = typed_rows.candidates(typed, cfg)
    dated = rows.withColumns({
        PARTITION_COLUMNS[0]: F.year("event_date"), PARTITION_COLUMNS[1]: F.month("event_date")})
    timed = dated.where(F.col(TIMESTAMP_KEY).isNotNull() & in_months(change.months)).drop(*PARTITION_COLUMNS)
    again = [*change.touched, *change.files]
    pool = stored(
        old_untimed.where(~file_address(F.col(ROW_ID)["file"]).isin(again)).unionByName(untimed(rows)),
        f"{work}/untimed")
    kept = stored(typed_rows.survivors(pool, cfg), f"{work}/untimed_silver")
    months = sorted({*change.months, *differing_months(silver, kept)})
    elsewhere = sorted(set(months) - set(change.months))
    keys = {PARTITION_COLUMNS[0]: F.year("event_date"), PARTITION_COLUMNS[1]: F.month("event_date")}
    parts = [
        typed_rows.survivors(timed, cfg).withColumns(keys),
        silver.where(in_months(elsewhere) & F.col(TIMESTAMP_KEY).isNotNull()),
        kept.withColumns(keys).where(in_months(months)),
    ]
    return stored(reduce(DataFrame.unionByName, parts), f"{work}/silver"), pool, months
