"""Numpy over Arrow text: words, hashes and byte-bounded batches, for use inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import SparkSession

BATCH_BYTES = 16 << 20
TEXT_BATCH_BYTES = 8 << 20  # for functions that hold several arrays per word of a text

# byte classes; bytes of multi-byte characters are 0x80 and above
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LETTER_OR_DIGIT = np.zeros(256, bool)
LETTER_OR_DIGIT[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Hand Arrow functions batches of bounded bytes, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def give_back() -> None:
    """Return freed memory to the system, where the C library can.

    A worker idles between its tasks and beside the JVM's sorts and joins; without
    this it goes on holding what its largest batch needed.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, whose worker keeps no freed memory when its task ends."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and their offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets.size == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_slices(
    batch: pa.RecordBatch, column: str, limit: int = 4 << 20,
) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text; a longer text comes alone."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def mixed(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: close inputs get unrelated outputs."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased; all others, and all lengths, stay."""
    return data + ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) * np.uint8(32)


def hash_each(values: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit xxh3 of every binary value."""
    return np.fromiter(
        (xxhash.xxh3_64_intdigest(v, seed) for v in values.to_pylist()), np.uint64, len(values))


class Words(NamedTuple):
    codes: np.ndarray  # per word, the place of its value among the distinct ones
    distinct: pa.Array
    before: np.ndarray  # per text, how many words precede it; one entry more than texts
    starts: np.ndarray  # per word, its first byte in the buffer
    lengths: np.ndarray  # per word, its bytes


def split_words(
    data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray,
) -> Words:
    """Maximal runs of bytes of a class, never across texts."""
    n_texts = len(offsets) - 1
    if not data.size:
        none = np.zeros(0, np.int64)
        return Words(none, pa.array([], pa.large_binary()), np.zeros(n_texts + 1, np.int64), none, none)
    inside = in_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < data.size]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    packed = data[inside]
    word_offsets = np.empty(starts.size + 1, np.int64)
    word_offsets[:-1] = np.cumsum(inside)[starts] - 1
    word_offsets[-1] = packed.size
    words = pa.Array.from_buffers(
        pa.large_binary(), starts.size, [None, pa.py_buffer(word_offsets), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    before = np.searchsorted(starts, offsets)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Words(codes, coded.dictionary, before, starts, np.diff(word_offsets))


def ragged_positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, end to end."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
