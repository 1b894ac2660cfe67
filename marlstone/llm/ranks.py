"""Ranks of rows by id within a group, from merged bitmaps instead of a sort.

Ids are dealt to buckets of 4,096. Every task makes a bitmap of the ids it sees
in each bucket (a list of positions where there are few); bitmaps of one bucket
are merged, and a rank is the count of all ids in earlier buckets plus the count
of bits before the id's own, read from a directory of popcounts. An id that
occurs more than once adds its other occurrences to the ranks behind it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.arrays import bound_batches
from marlstone.llm.storage import stored

BITS = 12
SPAN = 1 << BITS
BITMAP_BYTES = SPAN // 8
HELD_ROWS = 1 << 20  # rows that a task gathers before it writes their bitmaps
NO_ID = -(1 << (63 - BITS)) - 1  # the bucket before all others, for rows without id

BITMAPS = ("grp string, bucket bigint, n bigint, bits binary, repeated binary, extra binary")


def pack(positions: np.ndarray) -> bytes:
    """Ascending distinct positions as two bytes each, or as a bitmap where that is smaller."""
    if 2 * positions.size < BITMAP_BYTES:
        return positions.astype("<u2").tobytes()
    flags = np.zeros(SPAN, np.uint8)
    flags[positions] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def unpack(bits: bytes) -> np.ndarray:
    if len(bits) < BITMAP_BYTES:
        return np.frombuffer(bits, "<u2").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))


def ranks(bits: bytes, positions: np.ndarray) -> np.ndarray:
    """How many of the bitmap's positions are smaller than each of the given ones."""
    if len(bits) < BITMAP_BYTES:
        return np.searchsorted(np.frombuffer(bits, "<u2"), positions)
    words = np.frombuffer(bits, "<u8")
    directory = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    at = positions >> 6
    below = words[at] & ((np.uint64(1) << (positions & 63).astype(np.uint64)) - np.uint64(1))
    return directory[at] + np.bitwise_count(below)


def extra_before(repeated: bytes, extra: bytes, positions: np.ndarray) -> np.ndarray:
    """Further occurrences of repeated ids below each position."""
    total = np.concatenate([[0], np.cumsum(np.frombuffer(extra, "<i8"))])
    return total[np.searchsorted(np.frombuffer(repeated, "<u2"), positions)]


def bucket_of(id_col: str = "id") -> Column:
    return F.coalesce(F.shiftright(id_col, BITS), F.lit(NO_ID))


def _row(grp: str, bucket: int, positions: np.ndarray, counts: np.ndarray) -> dict:
    more = counts > 1
    return {
        "grp": grp, "bucket": bucket, "n": int(counts.sum()), "bits": pack(positions),
        "repeated": positions[more].astype("<u2").tobytes(), "extra": (counts[more] - 1).astype("<i8").tobytes()}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"grp": pa.string(), "bucket": pa.int64(), "n": pa.int64()}
    return pa.record_batch({
        name: pa.array([r[name] for r in rows], kinds.get(name, pa.binary()))
        for name in ("grp", "bucket", "n", "bits", "repeated", "extra")})


def _own_bitmaps(table: pa.Table) -> Iterator[pa.RecordBatch]:
    coded = table.column("grp").combine_chunks().dictionary_encode()
    groups, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = table.column("id").combine_chunks()
    blank = ids.is_null().to_numpy(zero_copy_only=False)
    low = pc.fill_null(ids, 0).to_numpy()
    buckets, low = np.where(blank, NO_ID, low >> BITS), low & (SPAN - 1)
    order = np.lexsort((low, buckets, codes))
    codes, buckets, low = codes[order], buckets[order], low[order]
    new_bucket = np.ones(low.size, bool)
    new_bucket[1:] = (np.diff(codes) != 0) | (np.diff(buckets) != 0)
    new_id = new_bucket.copy()
    new_id[1:] |= np.diff(low) != 0
    firsts = np.flatnonzero(new_id)
    counts = np.diff(np.append(firsts, low.size))
    begins = np.flatnonzero(new_bucket)
    edges = np.append(np.searchsorted(firsts, begins), firsts.size)
    rows = []
    for k, at in enumerate(begins):
        own = slice(edges[k], edges[k + 1])
        rows.append(_row(groups[codes[at]], int(buckets[at]), low[firsts[own]], counts[own]))
        if len(rows) == 4096:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD_ROWS:
            yield from _own_bitmaps(pa.Table.from_batches(held))
            held, rows = [], 0
    if rows:
        yield from _own_bitmaps(pa.Table.from_batches(held))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of one bucket follow each other; at most one bucket's counts are held."""
    counts = np.zeros(SPAN, np.int64)
    key, single, ready = None, None, []

    def add(row: dict) -> None:
        counts[unpack(row["bits"])] += 1
        counts[np.frombuffer(row["repeated"], "<u2")] += np.frombuffer(row["extra"], "<i8")

    def finished() -> dict:
        if single is not None:
            return single
        positions = np.flatnonzero(counts)
        row = _row(*key, positions, counts[positions])
        counts[positions] = 0
        return row

    for batch in batches:
        for row in batch.to_pylist():
            own = (row["grp"], row["bucket"])
            if own != key:
                if key is not None:
                    ready.append(finished())
                key, single = own, row
            else:
                if single is not None:
                    add(single)
                    single = None
                add(row)
            if len(ready) >= 1024:
                yield _batch(ready)
                ready = []
    if key is not None:
        ready.append(finished())
    if ready:
        yield _batch(ready)


def merged_bitmaps(rows: DataFrame) -> DataFrame:
    """(grp, id) rows as one bitmap a group and bucket; ids may repeat or be null."""
    partial = rows.select("grp", "id").mapInArrow(_partial, BITMAPS)
    return partial.repartition("grp", "bucket").sortWithinPartitions("grp", "bucket").mapInArrow(_merge, BITMAPS)


def rows_before(counts: DataFrame, within: Sequence[str], levels: Sequence[str], name: str = "before") -> DataFrame:
    """``counts`` (one row per ``within`` and ``levels``, with n) and the sum of n of all earlier ones.

    Levels are nested, coarse to fine, and each is summed over the rows of its
    own parent alone, so a window holds no more rows than one parent has children.
    """
    out = counts
    for depth, level in enumerate(levels):
        keys = [*within, *levels[:depth]]
        earlier = Window.partitionBy(*keys).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        nodes = counts.groupBy(*keys, level).agg(F.sum("n").alias("n")).select(
            *keys, level, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(f"{name}_{depth}"))
        out = out.join(nodes, [*keys, level])
    total = sum((F.col(f"{name}_{d}") for d in range(1, len(levels))), F.col(f"{name}_0"))
    return out.withColumn(name, total).drop(*[f"{name}_{d}" for d in range(len(levels))])


def with_bases(bitmaps: DataFrame) -> DataFrame:
    """Stored bitmaps with ``base``, the rows of their group in earlier buckets."""
    upper = {f"upper_{k}": F.shiftright("bucket", k * BITS) for k in (3, 2, 1)}
    counts = bitmaps.select("grp", "bucket", "n").withColumns(upper)
    before = rows_before(counts, ["grp"], [*upper, "bucket"], "base").select("grp", "bucket", "base")
    return bitmaps.join(before, ["grp", "bucket"])


REPEATS = "grp string, id bigint, first bigint, copies bigint"


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            positions = np.frombuffer(row["repeated"], "<u2").astype(np.int64)
            first = row["base"] + ranks(row["bits"], positions) + extra_before(row["repeated"], row["extra"], positions)
            blank = row["bucket"] == NO_ID
            ids = [None] if blank else ((row["bucket"] << BITS) + positions).tolist()
            yield pa.record_batch({
                "grp": pa.array([row["grp"]] * positions.size, pa.string()), "id": pa.array(ids, pa.int64()),
                "first": pa.array(first, pa.int64()),
                "copies": pa.array(np.frombuffer(row["extra"], "<i8") + 1, pa.int64())})


def repeated_ids(bitmaps: DataFrame) -> DataFrame:
    """(grp, id, first, copies) of every id that occurs more than once, from bitmaps with bases."""
    return bitmaps.where(F.length("repeated") > 0).mapInArrow(_repeats, REPEATS)


def _lookup(payload: Sequence[str]):
    """Streams rows of a bucket behind its bitmap and gives each its rank."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap: dict = {}
        for batch in batches:
            asks = batch.column("bits").is_null().to_numpy(zero_copy_only=False)
            codes = batch.column("grp").dictionary_encode().indices.to_numpy(zero_copy_only=False)
            buckets = batch.column("bucket").to_numpy()
            places = pc.fill_null(batch.column("id"), 0).to_numpy() & (SPAN - 1)
            new = np.ones(batch.num_rows, bool)
            new[1:] = (np.diff(codes) != 0) | (np.diff(buckets) != 0) | ~asks[1:]
            begins = np.flatnonzero(new)
            found = np.zeros(batch.num_rows, np.int64)
            for a, b in zip(begins, np.append(begins[1:], batch.num_rows), strict=True):
                if not asks[a]:
                    bitmap = {k: batch.column(k)[a].as_py() for k in ("bits", "repeated", "extra", "base")}
                    a += 1
                if a < b:
                    own = places[a:b]
                    found[a:b] = bitmap["base"] + ranks(bitmap["bits"], own) + extra_before(
                        bitmap["repeated"], bitmap["extra"], own)
            out = batch.append_column("position", pa.array(found)).filter(pa.array(asks))
            if out.num_rows:
                yield out.select(["grp", "position", *payload])

    return answer


def ranked(rows: DataFrame, order: Sequence[str], payload: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a stored table (grp, id, row, ``order`` and other columns) with their position, and (grp, total).

    Positions count from 0 within ``grp`` by id, rows without id first; rows of
    equal id by ``order``, and equal ones of those by ``row``, a number that no two
    rows share. ``payload`` is the schema of the columns to be kept.
    """
    bound_batches(rows.sparkSession)
    bitmaps = stored(with_bases(stored(merged_bitmaps(rows), "rank-bitmaps")), "rank-directory")
    totals = bitmaps.groupBy("grp").agg(F.sum("n").alias("total"))
    names = [part.split()[0] for part in payload.split(", ")]
    repeats = stored(repeated_ids(bitmaps), "rank-repeats")
    any_repeats = bool(repeats.take(1))
    same = [F.col("q.grp") == F.col("r.grp"), F.col("q.id").eqNullSafe(F.col("r.id"))]
    single = rows.alias("q").join(repeats.alias("r"), same, "left_anti") if any_repeats else rows
    asked = single.withColumn("bucket", bucket_of()).unionByName(
        bitmaps.select("grp", "bucket", "base", "bits", "repeated", "extra"), allowMissingColumns=True)
    found = asked.repartition("grp", "bucket").sortWithinPartitions("grp", "bucket", F.col("bits").isNull()).mapInArrow(
        _lookup(names), f"grp string, position bigint, {payload}")
    if not any_repeats:
        return found, totals
    ties = rows.alias("q").join(repeats.alias("r"), same).select("q.*", "first")
    # the writer's task number is in the upper bits of row: a window holds one task's equal rows at most
    deep = [F.hex(F.substring(F.col(order[0]).cast("binary"), 1, 2)).alias("prefix"), *order,
            F.shiftright("row", 33).alias("writer")]
    ties = ties.select("*", F.coalesce("id", F.lit(0)).alias("tie_id"), F.col("id").isNull().alias("tie_blank"),
                       deep[0], deep[-1])
    within = ["grp", "tie_blank", "tie_id"]
    levels = ["prefix", *order, "writer"]
    counts = ties.groupBy(*within, *levels).agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(*within, *levels).orderBy("row")
    placed = ties.withColumn("nth", F.row_number().over(own) - 1).join(
        rows_before(counts, within, levels).drop("n"), [*within, *levels])
    repeated = placed.select("grp", (F.col("first") + F.col("before") + F.col("nth")).alias("position"), *names)
    return found.unionByName(repeated), totals


def numbered(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their number from 0 in ascending order, null first.

    The order is cut into ranges, numbered within each, so no task holds all.
    """
    ordered = values.select(column).distinct().repartitionByRange(F.col(column).asc_nulls_first()).sortWithinPartitions(
        F.col(column).asc_nulls_first())
    kept = stored(ordered.select(
        column, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(
            "nth")), "rank-values")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    bases = kept.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return kept.join(F.broadcast(bases), "part").select(column, (F.col("base") + F.col("nth")).alias("number"))
