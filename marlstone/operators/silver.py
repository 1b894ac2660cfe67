"""Bronze -> silver: typing, canonical buckets, lookup, quarantine, dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.config import SILVER_COLUMNS, FeedConfig
from marlstone.functions.casting import (
    ISO_DATE, event_hour, event_timestamp, event_year_month, parse_date, parse_number,
)
from marlstone.functions.text import clean_text, map_by_rules, repair_mojibake, strip, strip_upper
from marlstone.operators.joins import lookup
from marlstone.sources.readers import ROW_ID
from marlstone.sources.sinks import reliable_checkpoint, work_path

SOURCE_ORDER = ("source_ord", ROW_ID)
KEY_HASH = "_key_hash"
BROADCAST_KEYS = 1_000_000  # hashes of repeated keys, sixteen bytes each in the hash table


def code_dimension(codes: DataFrame) -> DataFrame:
    """``code_clean -> code_description``, first row per code, encoding repaired."""
    order = F.col(ROW_ID) if ROW_ID in codes.columns else F.col("description")
    return (
        codes.groupBy(strip_upper(F.col("code")).alias("code_clean"))
        .agg(F.min_by("description", order).alias("_description"))
        .select("code_clean", repair_mojibake(F.col("_description")).alias("code_description"))
    )


def type_columns(bronze: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Bronze plus the typed and cleaned columns; raw values stay beside them."""
    iso_only = tuple(cfg.date_formats) == (ISO_DATE,)
    typed = bronze.withColumn("event_date", parse_date(F.col("date"), cfg.date_formats))
    return typed.withColumns({
        "event_ts": event_timestamp(
            F.col("date"), F.col("time"), None if iso_only else F.col("event_date")),
        "station_clean": clean_text(F.col("station")),
        "code_clean": strip_upper(F.col("code")),
        "line_raw": F.col("line"),
        "line_canonical": map_by_rules(F.col("line"), cfg.line_rules, cfg.line_default),
        "min_delay": parse_number(F.col("min_delay")),
        "min_gap": parse_number(F.col("min_gap")),
        "bound_clean": strip_upper(F.col("bound")),
        "vehicle_id": strip(F.col("vehicle")),
    })


def annotate(bronze: DataFrame, dimension: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Typed rows with their code description and ``is_reject``.

    Rejected: no date, no delay or a negative delay. A bad time alone is kept.
    """
    typed = lookup(type_columns(bronze, cfg), dimension, "code_clean")
    usable_delay = F.coalesce(F.col("min_delay") >= 0, F.lit(False))
    return typed.withColumn("is_reject", F.col("event_date").isNull() | ~usable_delay)


def rejects(annotated: DataFrame) -> DataFrame:
    return annotated.where("is_reject").drop("is_reject", KEY_HASH)


def accepted(annotated: DataFrame) -> DataFrame:
    return annotated.where(~F.col("is_reject")).drop("is_reject")


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """One row per key, the first by ``order``; nulls in the key are equal.

    Where a column of the order is missing, all other columns break the ties,
    so that the survivor is the same on every run.

    Keys are first counted by a 64-bit hash, which shuffles sixteen bytes per
    key and task. Only rows whose hash occurs twice can be copies and are
    ranked; all others pass as they are, neither sorted nor shuffled. The
    ranking's filter cuts each key to one row per task before its shuffle, so a
    key copied many times does not reach one reducer. Runs jobs, because how
    many keys are repeated decides whether they can be broadcast; past
    ``broadcast_keys`` all rows are ranked. Rows are stored once, with the hash,
    so that however they are made is done once.
    """
    return first_of_keyed(keyed(df, keys), keys, order, broadcast_keys).select(*df.columns)


def with_key_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(KEY_HASH, F.xxhash64(*keys))


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the hash of its keys, stored: however it is made is done once."""
    path = work_path(df.sparkSession, "keyed")
    with_key_hash(df, keys).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def first_of_keyed(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (), broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """keep_first() of a stored table that has the hash of its keys in KEY_HASH, read column by column."""
    by = [c for c in order if c in rows.columns]
    if not order or len(by) < len(order):
        by += [c for c in rows.columns if c not in keys and c not in by and c != KEY_HASH]
    first = Window.partitionBy(*keys).orderBy(*by)

    def ranked(some: DataFrame) -> DataFrame:
        return some.withColumn("_position", F.row_number().over(first)).where("_position = 1").drop("_position")

    repeated = reliable_checkpoint(
        rows.groupBy(KEY_HASH).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(KEY_HASH))
    found = repeated.count()
    if not found:
        return rows
    if found > broadcast_keys:
        return ranked(rows)
    small = F.broadcast(repeated)
    return rows.join(small, KEY_HASH, "left_anti").unionByName(
        ranked(rows.join(small, KEY_HASH, "left_semi")))


def project_silver(df: DataFrame) -> DataFrame:
    """The 15 silver columns."""
    renamed = df.withColumns({
        "event_hour": event_hour(F.col("event_ts")),
        "event_year_month": event_year_month(F.col("event_ts")),
        "day_of_week": F.col("day"),
        "station": F.col("station_clean"),
        "bound": F.col("bound_clean"),
    })
    return renamed.select(*SILVER_COLUMNS)


def _dedupe_input(df: DataFrame, cfg: FeedConfig) -> list[str]:
    """Only what silver keeps and dedupe needs goes through the shuffle."""
    needed = {
        "event_ts", "event_date", "day", "station_clean", "code_clean", "code_description",
        "min_delay", "min_gap", "bound_clean", "line_raw", "line_canonical", "vehicle_id",
        "source_file", *SOURCE_ORDER, *_physical(cfg.dedupe_keys),
    }
    return [c for c in df.columns if c in needed]


def _physical(keys: Sequence[str]) -> list[str]:
    """Silver key names as they are called before the final projection."""
    names = {"station": "station_clean", "bound": "bound_clean", "day_of_week": "day"}
    return [names.get(k, k) for k in keys]


def dedupe_keys(cfg: FeedConfig = FeedConfig()) -> list[str]:
    """The configured keys as typed rows call them."""
    return _physical(cfg.dedupe_keys)


def candidates(annotated: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Accepted rows of a keyed table, with what silver and dedupe need of them."""
    rows = accepted(annotated)
    return rows.select(*_dedupe_input(rows, cfg), KEY_HASH)


def survivors(rows: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Candidates without copies, in the silver schema.

    The kept columns follow the source order as tie-breaks: a feed read from a
    table has no row position.
    """
    keys = dedupe_keys(cfg)
    ties = [c for c in rows.columns if c not in keys and c not in SOURCE_ORDER and c != KEY_HASH]
    return project_silver(first_of_keyed(rows, keys, (*SOURCE_ORDER, *ties)))


def silver(annotated: DataFrame, cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Accepted rows, copies removed, in the silver schema; stores the rows unless they are keyed."""
    rows = annotated if KEY_HASH in annotated.columns else keyed(annotated, dedupe_keys(cfg))
    return survivors(candidates(rows, cfg), cfg)


def build_silver(
    bronze: DataFrame, codes: DataFrame, cfg: FeedConfig = FeedConfig(),
) -> tuple[DataFrame, DataFrame]:
    """(silver, rejects) from bronze rows and the raw code reference."""
    annotated = keyed(annotate(bronze, code_dimension(codes), cfg), dedupe_keys(cfg))
    return silver(annotated, cfg), rejects(annotated)
