"""Domain codes, epoch days, rounding and compact JSON rows."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode_domain(c: Column, codes: Mapping[str, str], what: str = "value") -> Column:
    """Look ``c`` up in a closed domain; a value outside it fails the job."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(codes.items())])
    problem = F.concat(F.lit(f"{what} outside its domain: "), F.coalesce(c, F.lit("NULL")))
    return F.coalesce(table[c], F.raise_error(problem).cast("string"))


def decode_domain(c: Column, codes: Mapping[str, str], what: str = "code") -> Column:
    return encode_domain(c, {short: full for full, short in codes.items()}, what)


def epoch_day(c: Column) -> Column:
    return F.unix_date(c)


def from_epoch_day(c: Column) -> Column:
    return F.date_from_unix_date(c.cast("int"))


def round_half_up(c: Column, places: int) -> Column:
    """Half-up rounding of the scaled binary value, for values >= 0.

    F.round works on the decimal text of a double and so rounds 0.575 up;
    scaling first gives 0.57, which is what the SQL models compute.
    """
    scale = float(10 ** places)
    return F.floor(c * scale + 0.5) / F.lit(scale)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double; null on an empty whole."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def shortest_number(c: Column) -> Column:
    """A double as a variant, without the fraction when it has none."""
    whole = c.try_cast("bigint")
    return F.when(c == whole, whole.cast("variant")).otherwise(c.cast("variant"))


def json_row(*cells: Column) -> Column:
    """Variants of any type as one compact JSON array, e.g. [19724,"L1",10]."""
    return F.to_json(F.array(*cells), {"ignoreNullFields": "false"})
