"""Merkle manifest of a dataset: a root over all rows, and for each row a proof against it.

A row's leaf is the SHA-256 of its fields. Within a group leaves stand by id; a
run of two consecutive nodes becomes the digest of both (a last node alone the
digest of itself) until one remains, the group's subroot; subroots, by group,
give the root the same way. Leaves get their place from bitmap ranks, not from a
sort, and are put into slot arrays of 4,096 by that place: each array reduces
twelve levels in one task, and the arrays' own roots go into arrays again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import bound_batches
from marlstone.llm.ranks import numbered, ranked
from marlstone.llm.storage import stored

LEVELS = 12
SLOTS = 1 << LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left:boolean,digest:string>>"
SLOT_ARRAYS = "grp string, block bigint, total bigint, n int, digests binary, ids array<bigint>, claims array<binary>"


def leaf(*values: Column) -> Column:
    """SHA-256, as hex, of the values end to end: '-' for null, else UTF-8 bytes, ':', value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def _levels(nodes: np.ndarray, alone: bool) -> list[np.ndarray]:
    """A block's digests level by level, the given ones first; ``nodes`` holds hex digests.

    A block that is all of its tree stops at one node; any other goes up all
    levels, as its tree has further nodes.
    """
    found = [nodes]
    while nodes.size > 1 or (not alone and len(found) <= LEVELS):
        paired = nodes.size // 2
        data = nodes.tobytes()
        # an odd last node is a shorter slice, so it is hashed alone
        nodes = np.array([sha256(data[i:i + 128]).hexdigest().encode() for i in range(0, len(data), 128)], "S64")
        assert nodes.size in (paired, paired + 1)
        found.append(nodes)
    return found


def _hex(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests.hex().encode(), "S64")


def _steps(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per node and level: is the other node on the left, and which is it (empty if none)."""
    at = np.arange(levels[0].size)
    left, other = [], []
    for nodes in levels[:-1]:
        sibling = at ^ 1
        left.append((at & 1).astype(bool))
        other.append(np.where(sibling < nodes.size, nodes[np.minimum(sibling, nodes.size - 1)], b""))
        at = at >> 1
    shape = (levels[0].size, 0)
    return (np.stack(left, 1) if left else np.zeros(shape, bool)), (
        np.stack(other, 1) if other else np.zeros(shape, "S64"))


def _path_array(left: np.ndarray, other: np.ndarray) -> pa.Array:
    """Rows of steps as an Arrow list; an empty digest is null."""
    n, depth = left.shape
    flat = np.ascontiguousarray(other).ravel()
    none = flat == b""
    sizes = np.where(none, 0, 64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    packed = flat[~none].astype("S64").tobytes()
    digests = pa.Array.from_buffers(pa.string(), flat.size, [
        pa.py_buffer(np.packbits(~none, bitorder="little")), pa.py_buffer(offsets), pa.py_buffer(packed)])
    steps = pa.StructArray.from_arrays([pa.array(left.ravel()), digests], ["left", "digest"])
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * depth, pa.int32()), steps)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block follow each other in any order; each goes to the slot of its position."""
    held: list[pa.RecordBatch] = []
    key = None

    def block() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        slots = rows.column("position").to_numpy() & (SLOTS - 1)
        digests = np.empty((rows.num_rows, 32), np.uint8)
        digests[slots] = np.frombuffer(b"".join(rows.column("digest").to_pylist()), np.uint8).reshape(-1, 32)
        back = pa.array(np.argsort(slots))
        return pa.record_batch({
            "grp": pa.array([key[0]], pa.string()), "block": pa.array([key[1]], pa.int64()),
            "total": rows.column("total").slice(0, 1).combine_chunks(), "n": pa.array([rows.num_rows], pa.int32()),
            "digests": [digests.tobytes()],
            "ids": pa.array([rows.column("id").take(back).to_pylist()], pa.list_(pa.int64())),
            "claims": pa.array([rows.column("claim").take(back).to_pylist()], pa.list_(pa.binary()))})

    for batch in batches:
        codes = batch.column("grp").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        blocks = batch.column("block").to_numpy()
        begins = np.flatnonzero(np.append(True, (np.diff(codes) != 0) | (np.diff(blocks) != 0)))
        for a, b in zip(begins, np.append(begins[1:], batch.num_rows), strict=True):
            own = (batch.column("grp")[a].as_py(), int(blocks[a]))
            if own != key and held:
                yield block()
                held.clear()
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield block()


def _slot_arrays(nodes: DataFrame, totals: DataFrame) -> DataFrame:
    """(grp, position, digest, id, claim) rows as stored slot arrays, one row each."""
    keyed = nodes.join(totals, "grp").withColumn("block", F.shiftright("position", LEVELS))
    dealt = keyed.repartition("grp", "block").sortWithinPartitions("grp", "block")
    return stored(dealt.mapInArrow(_gathered, SLOT_ARRAYS), "merkle-slots")


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        tops = [_levels(_hex(r["digests"]), r["total"] <= SLOTS)[-1][0] for r in rows]
        yield pa.record_batch({
            "grp": batch.column("grp"), "position": batch.column("block"),
            "digest": pa.array([bytes.fromhex(t.decode()) for t in tops], pa.binary())})


class Tree:
    """Slot arrays of every round, lowest first, and one (grp, digest) per group."""

    def __init__(self, nodes: DataFrame, totals: DataFrame) -> None:
        totals = stored(totals, "merkle-totals")
        self.rounds: list[DataFrame] = []
        most = totals.agg(F.max("total")).first()[0] or 0
        while True:
            self.rounds.append(_slot_arrays(nodes, totals))
            nodes = self.rounds[-1].select("grp", "block", "total", "digests").mapInArrow(
                _reduced, "grp string, position bigint, digest binary").withColumns({
                    "id": F.lit(None).cast("bigint"), "claim": F.lit(None).cast("binary")})
            totals = totals.withColumn("total", F.ceil(F.col("total") / SLOTS).cast("bigint"))
            most = -(-most // SLOTS)
            if most <= 1:
                break
        self.roots = stored(nodes.select("grp", "digest"), "merkle-roots")

    def paths(self, above: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Rows of the lowest slot arrays with the path from each to the root.

        ``above`` has (grp, path) from each group's subroot on, and ``columns``
        (strings) that every row of the group gets.
        """
        path = above.select("grp", F.lit(0).cast("bigint").alias("block"), "path", *columns)
        for arrays in reversed(self.rounds):
            last = arrays is self.rounds[0]
            schema = f"grp string, position bigint, id bigint, digest binary, claim binary, path {PATH}"
            found = arrays.join(path, ["grp", "block"]).mapInArrow(
                _with_paths(columns), schema + "".join(f", {c} string" for c in columns))
            if last:
                return found
            path = stored(found.select("grp", F.col("position").alias("block"), "path", *columns), "merkle-paths")


def _with_paths(columns: Sequence[str]) -> Callable:
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                left, other = _steps(_levels(_hex(row["digests"]), row["total"] <= SLOTS))
                upper_left = np.array([s["left"] for s in row["path"]], bool)
                upper = np.array([(s["digest"] or "").encode() for s in row["path"]], "S64")
                left = np.hstack([left, np.broadcast_to(upper_left, (n, upper_left.size))])
                other = np.hstack([other, np.broadcast_to(upper, (n, upper.size))])
                yield pa.record_batch({
                    "grp": pa.array([row["grp"]] * n, pa.string()),
                    "position": pa.array(row["block"] * SLOTS + np.arange(n), pa.int64()),
                    "id": pa.array(row["ids"], pa.int64()),
                    "digest": pa.array([row["digests"][i:i + 32] for i in range(0, 32 * n, 32)], pa.binary()),
                    "claim": pa.array(row["claims"], pa.binary()), "path": _path_array(left, other),
                    **{c: pa.array([row[c]] * n, pa.string()) for c in columns}})

    return expand


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
    claim: Column | None = None,
) -> DataFrame:
    """Per row of ``docs``: id, group, position, leaf, subroot, root, path, and claim.

    path lists, from the leaf to the root, the other node of each run and whether
    it stands on the left; digest is null where a node is alone. fold() leads a
    leaf along it. ``claim`` is another leaf of the row, carried along to be
    folded (null if none is given).

    Nulls in any field have their own form in the leaf. Rows without id stand
    before all others of their group, rows of equal id in the order of their
    leaves; equal rows get neighbouring places. A null group is a group, the
    first. An empty table gives no rows. Other columns are not read.
    """
    bound_batches(docs.sparkSession)
    other = F.lit(None).cast("string") if claim is None else claim
    rows = stored(docs.select(
        # a null group is before every other, the empty string included
        F.when(F.col(group_col).isNull(), F.lit("")).otherwise(
            F.concat(F.lit("="), F.col(group_col).cast("string"))).alias("grp"),
        F.col(id_col).cast("bigint").alias("id"), F.unhex(leaf(*[F.col(c) for c in fields])).alias("digest"),
        F.unhex(other).alias("claim"), F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    placed, totals = ranked(rows, ["digest"], "id bigint, digest binary, claim binary")
    groups = Tree(placed, totals)
    order = numbered(groups.roots, "grp")
    tops = groups.roots.join(order, "grp").select(
        F.lit("").alias("grp"), F.col("number").alias("position"), "digest", F.col("number").alias("id"),
        F.lit(None).cast("binary").alias("claim"))
    top = Tree(tops, tops.groupBy("grp").agg(F.count(F.lit(1)).alias("total")))
    start = top.roots.select("grp", F.array().cast(PATH).alias("path"), F.lower(F.hex("digest")).alias("root"))
    above = stored(top.paths(start, ["root"]).select(
        F.col("id").alias("number"), "path", F.lower(F.hex("digest")).alias("subroot"), "root"), "merkle-tops")
    found = groups.paths(order.join(above, "number").drop("number"), ["subroot", "root"])
    return found.select(
        "id", F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("group"), "position",
        F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", "path", F.lower(F.hex("claim")).alias("claim"))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, start, lambda node, step: F.sha2(
        F.when(step["digest"].isNull(), node).when(step["left"], F.concat(step["digest"], node)).otherwise(
            F.concat(node, step["digest"])), 256))


def siblings(path: Column) -> Column:
    """The path's digests, level by level."""
    return F.filter(F.transform(path, lambda step: step["digest"]), lambda digest: digest.isNotNull())
