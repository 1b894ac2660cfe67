"""Simple-8b in numpy: a 4-bit selector and 60 bits of equally wide values per 64-bit word.

Values are coded in blocks that start on a word of their own, so all blocks are
packed and unpacked side by side. A value of over 60 bits is an escape: its word
holds a number in the list of escapes instead.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 1024
ESCAPE = 0
# Fixed values of the format: selector -> values in a word, bits of each.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
_LOW60 = np.uint64((1 << 60) - 1)


class Packed(NamedTuple):
    words: np.ndarray  # uint64
    offsets: np.ndarray  # uint32, first word of each block
    escapes: np.ndarray  # uint64, values that no word can hold


def _widths(values: np.ndarray) -> np.ndarray:
    high = values >> np.uint64(32)
    low = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    if not high.any():
        return low.astype(np.uint8)
    return np.where(high > 0, np.frexp(high.astype(np.float64))[1] + 32, low).astype(np.uint8)


def _selectors(width: np.ndarray) -> np.ndarray:
    """Per position, the selector that packs most of the values from there on.

    The widest value of every window is built up from that of the next shorter
    window, for all positions at once.
    """
    best = np.full(width.size, ESCAPE, np.int8)
    widest, size = width.copy(), 1
    for selector in range(len(COUNTS) - 1, 0, -1):  # the one with most values is set last
        count = int(COUNTS[selector])
        while size < count:
            step = min(size, count - size)
            widest[:-step] = np.maximum(widest[:-step], widest[step:])
            size += step
        np.copyto(best, np.int8(selector), where=widest <= BITS[selector])
    return best


def pack(values: np.ndarray, block: int = BLOCK) -> Packed:
    values = np.ascontiguousarray(values, np.uint64)
    n = values.size
    n_blocks = -(-n // block)
    if not n:
        return Packed(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64))
    # each block with zeros after it, so that no window reaches into the next
    row = block + int(COUNTS.max())
    padded = np.zeros((n_blocks, row), np.uint64)
    whole = n // block
    padded[:whole, :block] = values[:whole * block].reshape(whole, block)
    padded[whole:, :n - whole * block] = values[whole * block:]
    padded = padded.ravel()
    best = _selectors(_widths(padded))
    # every block steps to its next word at once
    step = COUNTS[best]
    position = np.arange(n_blocks) * row
    ends = position + np.minimum(block, n - np.arange(n_blocks) * block)
    live, steps = np.arange(n_blocks), []
    while live.size:
        at = position[live]
        steps.append(at)
        at = at + step[at]
        position[live] = at
        live = live[at < ends[live]]
    at = np.sort(np.concatenate(steps))
    selector = best[at]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in range(1, len(COUNTS)):
        own = np.flatnonzero(selector == s)
        if own.size:
            total = padded[at[own]]
            for j in range(1, COUNTS[s]):
                total |= padded[at[own] + j] << np.uint64(j * BITS[s])
            words[own] |= total
    escaped = np.flatnonzero(selector == ESCAPE)
    words[escaped] |= np.arange(escaped.size, dtype=np.uint64)
    offsets = np.searchsorted(at, np.arange(n_blocks) * row).astype(np.uint32)
    return Packed(words, offsets, padded[at[escaped]])


def unpack(packed: Packed, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values back, all words of a selector at a time."""
    words = packed.words
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    offsets = packed.offsets.astype(np.int64)
    owner = np.repeat(np.arange(offsets.size), np.diff(np.append(offsets, words.size)))
    before = np.concatenate([[0], np.cumsum(COUNTS[selector])])[:-1]
    first = owner * block + before - before[offsets[owner]]
    stop = np.minimum((owner + 1) * block, n)
    body = words & _LOW60
    for s in range(1, len(COUNTS)):
        own = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for j in range(COUNTS[s] if own.size else 0):
            inside = own[first[own] + j < stop[own]]
            out[first[inside] + j] = (body[inside] >> np.uint64(j * BITS[s])) & mask
    own = np.flatnonzero(selector == ESCAPE)
    out[first[own]] = packed.escapes[body[own].astype(np.int64)]
    return out
