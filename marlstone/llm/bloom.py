"""A Bloom filter of bounded size over 64-bit values, built by tasks and broadcast.

It keeps rows from being shuffled for a join they cannot match. It grows with
the values up to a fixed size; past that it lets more rows through, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import mixed

BITS_PER_VALUE = 10
MAX_BITS = 1 << 27  # 16 MB
HASHES = 3
_SEGMENT_BYTES = 4096  # of one bitmap of bitmap_or_agg


def _places(values: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            yield (mixed(values.view(np.uint64) + np.uint64(k * 0x51ED2701)) & np.uint64(bits - 1)).astype(np.int64)


def bloom_filter(df: DataFrame, column: str) -> Broadcast:
    """The broadcast filter over a bigint column."""
    values = df.select(F.col(column).alias("v")).where("v is not null")
    wanted = max(BITS_PER_VALUE * values.count(), _SEGMENT_BYTES * 8)
    bits = min(1 << (wanted - 1).bit_length(), MAX_BITS)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column("v").to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(own, place >> 3, (1 << (place & 7)).astype(np.uint8))
        segments = own.reshape(-1, _SEGMENT_BYTES)
        used = np.flatnonzero(segments.any(axis=1))
        yield pa.record_batch({
            "segment": pa.array(used.astype(np.int32)),
            "bits": pa.array([segments[i].tobytes() for i in used], pa.binary())})

    parts = values.mapInArrow(fill, "segment int, bits binary").groupBy("segment").agg(
        F.bitmap_or_agg("bits").alias("bits")).collect()  # MAX_BITS / 8 bytes at most
    whole = np.zeros((bits // 8 // _SEGMENT_BYTES, _SEGMENT_BYTES), np.uint8)
    for row in parts:
        whole[row["segment"]] = np.frombuffer(row["bits"], np.uint8)
    return df.sparkSession.sparkContext.broadcast(whole.ravel())


def may_contain(own: np.ndarray, values: np.ndarray) -> np.ndarray:
    """True for every value that is in the filter, and for a few that are not."""
    found = np.ones(values.size, bool)
    for place in _places(values, own.size * 8):
        found &= (own[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return found
