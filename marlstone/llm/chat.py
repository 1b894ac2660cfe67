r"""Chat formatting by columnar byte assembly.

A turn reads ``<turn ROLE>TEXT</turn>`` and a line break. In roles and texts
``\``, ``<`` and ``>`` are written ``\\``, ``\l`` and ``\g``, so no text can hold
a mark of the template, and every text can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import bound_batches, byte_slices, ragged_positions, text_buffer

OPEN, CLOSE_OPEN, CLOSE = b"<turn ", b">", b"</turn>\n"
LEARNED_ROLE = "assistant"
PART_BYTES = 1 << 20  # text that one output row holds; a longer turn is a row of its own

FORMAT_SCHEMA = (
    "conv_id bigint, shard int, part int, n_turns bigint, formatted string, "
    "loss_starts array<bigint>, loss_ends array<bigint>"
)
DIGEST_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint"
)

_CODES = np.zeros(256, np.uint8)
_CODES[[0x5C, 0x3C, 0x3E]] = [0x5C, ord("l"), ord("g")]
_TURN = re.compile(rb"<turn ([^<>]*)>([^<>]*)</turn>\n")
_ESCAPE = re.compile(rb"\\([\\lg])")
_MEANING = {b"\\": b"\\", b"l": b"<", b"g": b">"}


def escape(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Escaped bytes of texts that lie end to end, and their new offsets."""
    code = _CODES[data]
    marked = code > 0
    before = np.concatenate([[0], np.cumsum(marked)])
    out = np.empty(data.size + int(before[-1]), np.uint8)
    place = np.arange(data.size) + before[:-1]
    out[place] = np.where(marked, np.uint8(0x5C), data)
    out[place[marked] + 1] = code[marked]
    return out, offsets + before[offsets]


def unescape(text: bytes) -> bytes:
    return _ESCAPE.sub(lambda m: _MEANING[m[1]], text)


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: bytes, where each turn begins, and where its text begins and ends."""
    role_bytes, role_at = escape(*text_buffer(roles))
    text_bytes, text_at = escape(*text_buffer(texts))
    role_size, text_size = np.diff(role_at), np.diff(text_at)
    segments = [np.full(len(roles), len(OPEN)), role_size, np.full(len(roles), len(CLOSE_OPEN)), text_size,
                np.full(len(roles), len(CLOSE))]
    ends = np.cumsum(np.stack(segments, 1).ravel()).reshape(len(roles), 5) if len(roles) else np.zeros((0, 5), int)
    starts = ends - np.stack(segments, 1) if len(roles) else ends
    out = np.empty(int(ends[-1, 4]) if len(roles) else 0, np.uint8)
    for column, mark in ((0, OPEN), (2, CLOSE_OPEN), (4, CLOSE)):
        out[starts[:, column][:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    out[ragged_positions(starts[:, 1], role_size)] = role_bytes
    out[ragged_positions(starts[:, 3], text_size)] = text_bytes
    return out, starts[:, 0], starts[:, 3], ends[:, 3]


def _format(batch: pa.RecordBatch, shard: int, part: int, learned: str) -> pa.RecordBatch:
    out, turn_start, text_start, text_end = assemble(batch.column("role"), batch.column("text"))
    conv = batch.column("conv_id")
    ids = conv.fill_null(0).to_numpy(zero_copy_only=False)
    null = conv.is_null().to_numpy(zero_copy_only=False)
    new = np.ones(batch.num_rows, bool)
    new[1:] = (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])
    first = np.flatnonzero(new)
    begins = turn_start[first]
    offsets = np.append(begins, out.size).astype(np.int32)
    spoken = np.flatnonzero(np.array([r == learned for r in batch.column("role").to_pylist()], bool))
    owner = np.searchsorted(first, spoken, "right") - 1
    cuts = pa.array(np.searchsorted(owner, np.arange(first.size + 1)).astype(np.int32))

    def spans(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(cuts, pa.array(values[spoken] - begins[owner], pa.int64()))

    return pa.record_batch({
        "conv_id": conv.take(pa.array(first)),
        "shard": pa.array(np.full(first.size, shard, np.int32)),
        "part": pa.array(np.arange(part, part + first.size, dtype=np.int32)),
        "n_turns": pa.array(np.diff(np.append(first, batch.num_rows)).astype(np.int64)),
        "formatted": pa.StringArray.from_buffers(first.size, pa.py_buffer(offsets), pa.py_buffer(out)),
        "loss_starts": spans(text_start), "loss_ends": spans(text_end),
    })


def format_chats(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """Formatted parts of conversations with byte spans of the text under the loss mask.

    ``turns`` has conv_id, turn, role, text. Rows are in order of turn, ties in
    order of role and text, and repeated rows are repeated turns. Null roles and
    texts are empty; rows without conv_id are one conversation of their own.
    A conversation is split between rows where it is long: its parts, in order
    of shard and part, make up its text, so one of a third of all rows is dealt
    to many tasks. Empty tables give no rows; other columns are not read.
    """
    bound_batches(turns.sparkSession)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(
        "conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in byte_slices(batch, "text", PART_BYTES):
                out = _format(piece, shard, part, learned_role)
                part += out.num_rows
                yield out

    return ordered.mapInArrow(run, FORMAT_SCHEMA)


def parse(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """(role, text) of every turn of a formatted text; raises if anything else is in it."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError(f"not a turn at byte {at}")
    return turns


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its formatted parts: turns, digests and sizes.

    A digest runs through a conversation from its first to its last byte, so the
    parts of one conversation stream through one task, part by part.
    """
    columns = ["conv_id", "shard", "part", "formatted", "loss_starts", "loss_ends"]
    ordered = formatted.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "shard", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> pa.RecordBatch:
            n, turns, loss_chars, loss, chars = state
            return pa.record_batch({
                "conv_id": pa.array([current[0]], pa.int64()), "n_turns": pa.array([n], pa.int64()),
                "turns_sha256": [turns.hexdigest()], "loss_chars": pa.array([loss_chars], pa.int64()),
                "loss_sha256": [loss.hexdigest()], "formatted_chars": pa.array([chars], pa.int64())})

        for batch in batches:
            done = []
            for conv, _, _, text, starts, ends in zip(
                    *(batch.column(c).to_pylist() for c in columns), strict=True):
                if current != (conv,):
                    if state is not None:
                        done.append(row())
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                data = text.encode()
                for role, content in parse(data):
                    state[0] += 1
                    state[1].update(role + b"\n" + content + b"\n")
                for a, b in zip(starts, ends, strict=True):
                    learned = unescape(data[a:b])
                    state[2] += len(learned.decode())
                    state[3].update(learned)
                state[4] += len(text)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if state is not None:
            yield row()

    bound_batches(formatted.sparkSession)
    return ordered.mapInArrow(run, DIGEST_SCHEMA)
