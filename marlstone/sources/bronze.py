"""Bronze: feeds unified as published text, nothing cleaned, replayable."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.config import REQUIRED_COLUMNS, FeedConfig
from marlstone.functions.casting import ISO_DATE, parse_date, published_text
from marlstone.sources.readers import read_source


def union_sources(named: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Bag union in order, tagged with source name and position.

    Columns only some feeds have survive as null elsewhere. Required columns
    are turned to text per feed first, so feeds of different types line up.
    """
    tagged = [
        df.withColumns({"source_file": F.lit(name), "source_ord": F.lit(position)})
        for position, (name, df) in enumerate(named)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``df`` itself, or ValueError naming the columns it lacks. Runs no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the feeds lack required columns: {missing}")
    return df


def unify_text(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``columns`` (those present) as published text, '' for missing."""
    return df.withColumns({
        c: published_text(F.col(c), df.schema[c].dataType) for c in columns if c in df.columns
    })


def _align_extras(named: list[tuple[str, DataFrame]]) -> list[tuple[str, DataFrame]]:
    """Turn columns the feeds type differently into text, so they can be stacked."""
    types: dict[str, set[str]] = {}
    for _, df in named:
        for field in df.schema.fields:
            types.setdefault(field.name, set()).add(field.dataType.simpleString())
    mixed = {c for c, seen in types.items() if len(seen) > 1}
    return [
        (name, df.withColumns({
            c: F.nullif(published_text(F.col(c), df.schema[c].dataType), F.lit(""))
            for c in df.columns if c in mixed
        }))
        for name, df in named
    ]


def partition_keys(df: DataFrame, formats: Sequence[str] = (ISO_DATE,)) -> DataFrame:
    """Year and month of the date text, 0/0 where it does not parse."""
    day = parse_date(F.col("date"), formats)
    return df.withColumns({
        "partition_year": F.coalesce(F.year(day), F.lit(0)),
        "partition_month": F.coalesce(F.month(day), F.lit(0)),
    })


def unify(named: Iterable[tuple[str, DataFrame]], cfg: FeedConfig = FeedConfig()) -> DataFrame:
    """Feeds -> bronze rows."""
    required = cfg.required_columns
    texts = _align_extras([(name, unify_text(df, required)) for name, df in named])
    bronze = require_columns(union_sources(texts), required)
    # a feed without one of the columns contributes '' rather than null
    bronze = bronze.na.fill("", subset=list(required))
    return partition_keys(bronze, cfg.date_formats)


def read_bronze_sources(spark: SparkSession, cfg: FeedConfig) -> DataFrame:
    return unify([(s.name, read_source(spark, s)) for s in cfg.sources], cfg)
