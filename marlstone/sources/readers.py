"""Raw readers: text and typed feeds, header normalisation, check inputs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.config import SourceSpec
from marlstone.functions.text import strip_upper

ROW_ID = "source_row_id"

# Cells that count as missing when a CSV file is checked.
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalise_name(name: str) -> str:
    """' Min  Delay ' -> 'min_delay'."""
    return re.sub(r"\s+", "_", str(name).lstrip("﻿").strip().lower())


def normalise_columns(df: DataFrame) -> DataFrame:
    """Normalised headers, without the publisher's ``_id`` column."""
    return df.toDF(*[normalise_name(c) for c in df.columns]).drop("_id")


def listed_address(file: Column) -> Column:
    """A listed file's address, local ones without a scheme."""
    return F.regexp_replace(file, "^file:/+", "/")


def file_address(file: Column) -> Column:
    """The same address from the rows' own metadata, which escapes it."""
    return listed_address(F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B"))))


def _of_files(df: DataFrame, files: Sequence[str] | None) -> DataFrame:
    """``df`` without the rows of other files, which are then not opened; None takes all."""
    if files is None:
        return df
    return df.where(file_address(F.col("_metadata.file_path")).isin(list(files)) if files else F.lit(False))


def files_by_line_breaks(
    spark: SparkSession, path: str, quote: str = '"', only: Sequence[str] | None = None,
) -> tuple[list[str], list[str]]:
    """(files with a record that spans lines, the other files), from one pass over the text.

    A line then holds an odd number of quotes. Files without any line are in neither list.
    """
    lines = _of_files(spark.read.text(path), only)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    found = lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.max((quotes % 2 == 1).cast("int")).alias("odd")).orderBy("file").collect()
    names = [(unquote(r["file"]), r["odd"] == 1) for r in found]
    return [f for f, odd in names if odd], [f for f, odd in names if not odd]


def has_quoted_line_breaks(spark: SparkSession, path: str, quote: str = '"') -> bool:
    """True when some record spans lines."""
    return bool(files_by_line_breaks(spark, path, quote)[0])


def _with_file_position(df: DataFrame) -> DataFrame:
    """Tag rows with a struct that sorts in file order.

    Splits of one file are not numbered in order, so the split's offset comes
    before the running id.
    """
    return df.select("*", F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias(ROW_ID))


def read_csv_text(
    spark: SparkSession, path: str, multi_line: bool | None = None, only: Sequence[str] | None = None, **options: str,
) -> DataFrame:
    """CSV with a header, every column text; the reader yields null for blanks.

    Multi-line parsing makes a file unsplittable, so unless told the reader
    first looks which files have a record that needs it, and parses only those
    that way. Files of a folder whose headers differ fail instead of being lined
    up by position. ``only`` names the files to be read by their addresses.
    ``options`` go before the reader's own.
    """
    settings = {"header": True, "inferSchema": False, "enforceSchema": False, "quote": '"', "escape": '"', **options}
    if multi_line is None and "multiLine" not in settings:
        broken, plain = files_by_line_breaks(spark, path, settings["quote"], only)
        if broken and plain:
            # folders named key=value below the path are columns of all files alike
            base = {} if set(path) & set("*?[{") else {"basePath": path}
            parts = [spark.read.options(**settings, **base, multiLine=many).csv(files)
                     for many, files in ((False, plain), (True, broken))]
            if parts[0].columns != parts[1].columns:
                raise ValueError(f"the files of {path} have different headers")
            return _with_file_position(parts[0]).unionByName(_with_file_position(parts[1]))
        multi_line = bool(broken)
    settings.setdefault("multiLine", bool(multi_line))
    return _with_file_position(_of_files(spark.read.options(**settings).csv(path), only))


def read_source(spark: SparkSession, spec: SourceSpec, only: Sequence[str] | None = None) -> DataFrame:
    """A raw feed with normalised headers and its file position.

    Text feeds come back with '' for blanks; typed feeds keep their types.
    ``only`` reads no other files than those of these addresses; the columns are
    those of the whole feed all the same.
    """
    if spec.format == "csv":
        return normalise_columns(read_csv_text(spark, spec.path, spec.multi_line, only, **spec.options)).na.fill("")
    if spec.format == "table":
        raw = spark.table(spec.path)
        return normalise_columns(raw)
    raw = _of_files(spark.read.format(spec.format).options(**spec.options).load(spec.path), only)
    return normalise_columns(_with_file_position(raw))


def reference_codes(codes: DataFrame, column: str = "code") -> DataFrame:
    """Distinct trimmed, upper-cased codes in order."""
    return codes.select(strip_upper(F.col(column)).alias(column)).distinct().orderBy(column)


def load_dataset(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Input for the checker: a .parquet or .csv path, or a catalog table.

    A path that ends in .db or .duckdb names a database, so ``table`` is needed.
    """
    suffix = re.search(r"(\.[^./\\]*)?/?$", str(path)).group(1) or ""
    suffix = suffix.lower()
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix == ".csv":
        cells = spark.read.options(
            header=True, inferSchema=True, quote='"', escape='"', preferDate=False,
            multiLine=has_quoted_line_breaks(spark, path),
        ).csv(path)
        return cells.withColumns({
            f.name: F.when(~F.col(f"`{f.name}`").isin(*MISSING_CELLS), F.col(f"`{f.name}`"))
            for f in cells.schema.fields if isinstance(f.dataType, T.StringType)
        })
    if suffix in {".duckdb", ".db"}:
        if not table:
            raise ValueError(f"{path} names a database: say which table")
        return spark.table(table)
    raise ValueError(f"cannot load {suffix!r}: give a .parquet or .csv path or a table")
