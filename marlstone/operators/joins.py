"""Small-dimension joins with a measured broadcast bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DatetimeType, T.AnyTimeType, T.AnsiIntervalType, T.NullType)


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` in memory, estimated by reading it: variable widths plus row overhead.

    Nested values count as the JSON that spells them out.
    """
    width = F.lit(ROW_OVERHEAD_BYTES + 8 * len(df.columns))
    for field in df.schema.fields:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(value), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0))
        elif not isinstance(field.dataType, _FIXED_WIDTH):
            width = width + F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` marked for broadcast when its measured size allows, else unmarked.

    Unmarked, the join shuffles and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def lookup(fact: DataFrame, dim: DataFrame, key: str, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Left join to a dimension that holds each key once."""
    return fact.join(broadcast_if_small(dim, limit), key, "left")
