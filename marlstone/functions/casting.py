"""Lenient typing: unparseable input becomes null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_DATE = "yyyy-MM-dd"

# Anchors are absolute: $ also matches before a last line separator.
_ISO_DATE = r"\A\d{4}-\d{1,2}-\d{1,2}\z"
_ISO_MINUTE = r"\A\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}\z"
_ISO_INSTANT = (
    r"\A(\d{4}-\d{1,2}-\d{1,2})(?:[ T]+(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?))?"
    r"(?: ?(?:Z|[+-]\d{2}:?\d{2}))?\z"
)
# try_cast alone would take "5d" as 5 and "nan" as NaN, which is not < 0.
_NUMBER = r"(?i)\A\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*\z"


def _wall_clock(instant: Column) -> Column:
    """The zone-free time that an instant shows at offset zero, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def _try_format(c: Column, fmt: str) -> Column:
    """``c`` parsed with ``fmt`` as a zone-free timestamp.

    Parsed at offset zero and rebuilt from the epoch, so the session zone and
    its daylight-saving gaps cannot move a wall-clock value.
    """
    return _wall_clock(F.try_to_timestamp(F.concat(c, F.lit(" +00:00")), F.lit(fmt + " xxx")))


def _iso_instant(c: Column) -> Column:
    day = F.regexp_extract(c, _ISO_INSTANT, 1)
    clock = F.regexp_extract(c, _ISO_INSTANT, 2)
    joined = F.when(clock == "", day).otherwise(F.concat(day, F.lit(" "), clock))
    return joined.try_cast("timestamp_ntz")


def parse_date(c: Column, formats: Sequence[str] = (ISO_DATE,)) -> Column:
    """Date from text: the first format that fits.

    ISO takes the fast cast path, and may be followed by a time of day.
    """
    # most cells are ten characters of this shape, of which the cast takes digits only
    padded = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-") & (
        F.substring(c, 1, 1).between("0", "9")) & F.substring(c, 10, 1).between("0", "9")
    iso = F.coalesce(
        F.when(padded, c.try_cast("date")),
        F.when(c.rlike(_ISO_DATE), c.try_cast("date")).otherwise(_iso_instant(c).cast("date")))
    tries = [
        iso if fmt == ISO_DATE
        else _try_format(c, fmt).cast("date")
        for fmt in formats
    ]
    return F.coalesce(*tries)


def event_timestamp(date: Column, time: Column, event_date: Column | None = None) -> Column:
    """Minute-precision timestamp from date text and time text.

    Pass the parsed ``event_date`` when the feed's dates are not ISO; the time
    is then put on that date instead of on the first ten characters.
    """
    day = F.rtrim(F.substring(date, 1, 10)) if event_date is None else event_date.cast("string")
    text = F.concat(day, F.lit(" "), F.ltrim(F.substring(time, 1, 5)))
    return F.when(text.rlike(_ISO_MINUTE), text.try_cast("timestamp_ntz"))


def parse_timestamp(c: Column, dtype: T.DataType, formats: Sequence[str] = ()) -> Column:
    """Zone-free timestamp of any column.

    Typed columns pass as they are, instants at offset zero, numbers are nanoseconds since the epoch,
    text is read by ISO shape or by ``formats``.
    """
    if isinstance(dtype, T.TimestampType):
        return _wall_clock(c)
    if isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        return c.cast("timestamp_ntz")
    if isinstance(dtype, T.NumericType):
        return F.timestamp_add(
            "MICROSECOND", (c / 1000).try_cast("bigint"),
            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
        )
    if formats:
        return F.coalesce(*[_try_format(c, fmt) for fmt in formats])
    return _iso_instant(c)


def parse_number(c: Column) -> Column:
    """Double from text or number; null unless the whole text is one number that fits."""
    text = c.cast("string")
    value = F.trim(text).try_cast("double")
    fits = (F.abs(value) < float("inf")) | text.rlike("(?i)inf")
    return F.when(text.rlike(_NUMBER) & fits, value)


def event_hour(ts: Column) -> Column:
    return F.hour(ts)


def event_year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def float_text(c: Column) -> Column:
    """Shortest text of a double in positional form between 1e-4 and 1e16.

    Spark switches to 1.0E7 notation early; published files do not, and bronze
    has to hold the value as published.
    """
    shortest = c.cast("string")
    size = F.abs(c.cast("double"))
    positional = F.regexp_replace(
        shortest.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    exponent = F.regexp_replace(shortest, r"\.0E", "E")
    exponent = F.regexp_replace(exponent, r"E(\d)", "e+$1")
    exponent = F.regexp_replace(exponent, "E-", "e-")
    exponent = F.regexp_replace(exponent, r"e([+-])(\d)$", "e$10$2")
    return (
        F.when(F.isnan(c), F.lit(None).cast("string"))
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when(~shortest.contains("E"), shortest)
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(exponent)
    )


def published_text(c: Column, dtype: T.DataType) -> Column:
    """A cell as the text a reader of the published file would see; null is ''."""
    if isinstance(dtype, T.TimestampType):
        text = _wall_clock(c).cast("date").cast("string")
    elif isinstance(dtype, (T.DateType, T.TimestampNTZType)):
        text = c.cast("date").cast("string")
    elif dtype.typeName() == "time":
        text = F.substring(c.cast("string"), 1, 5)
    elif isinstance(dtype, T.BooleanType):
        text = F.initcap(c.cast("string"))
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = float_text(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))
