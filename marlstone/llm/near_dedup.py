"""Near-duplicates by HyperMinHash registers, banding, estimate and exact verification.

A document's shingles fall into 512 buckets by hash. A bucket's register keeps
the leading zeros of its smallest hash and the three bits after them, 8 bits in
all; an empty bucket takes the register of the first filled one in an order
fixed for it. Documents that agree on a band of six of the first 384 registers
are candidates. The agreement of the other 128, less the share expected of
chance collisions, estimates their similarity; those that may reach the
threshold are compared on their full shingle sets.

Documents of equal sets are one class from the start. Within a bucket of a band
all members are first compared with its smallest id, which is linear. Only
members left in different components are then compared further, each against
blocks of the others, so a large group of near copies is never paired out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import (
    NOT_SPACE, TEXT_BATCH_BYTES, bound_batches, byte_slices, giving_back, hash_each, lowered, mixed, split_words,
    text_buffer,
)
from marlstone.llm.bloom import bloom_filter, may_contain
from marlstone.llm.components import components
from marlstone.llm.storage import stored
from marlstone.operators.joins import broadcast_if_small

SHINGLE_WORDS = 5
THRESHOLD = (80, 100)  # shared * 100 >= united * 80

BUCKET_BITS = 9
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 3
# At similarity 0.8 a band agrees with probability 0.8 ** 6, so all 64 fail for
# one pair in 10 ** 8.
BANDS, BAND_ROWS = 64, 6
BANDED = BANDS * BAND_ROWS
PROBES = BUCKETS - BANDED  # registers that bands do not use, for the estimate
# Standard deviations that an estimate may lie below the threshold.
SLACK = 6.0
SLICE_BYTES = 1 << 20  # of text hashed at once: a word takes some hundred bytes while it is
BLOCK = 256  # documents that one task holds while others stream past them

FEATURES_SCHEMA = "id bigint, n bigint, k1 bigint, k2 bigint, registers binary, probes binary"


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and where each text begins.

    Texts are lower-cased in A-Z and split at ASCII white space. A text of fewer
    words than a shingle is one shingle; one without words has none.
    """
    data, offsets = text_buffer(texts)
    found = split_words(lowered(data), offsets, NOT_SPACE)
    hashes = hash_each(found.distinct)[found.codes] if found.codes.size else np.zeros(0, np.uint64)
    n_words = np.diff(found.before)
    n_all = np.where(n_words == 0, 0, np.maximum(1, n_words - words + 1))
    text = np.repeat(np.arange(len(n_words)), n_all)
    first = np.arange(text.size) - np.repeat(np.cumsum(n_all) - n_all, n_all) + found.before[:-1][text]
    size = np.minimum(words, n_words)[text]
    total = np.zeros(text.size, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(words):
            inside = j < size
            part = hashes[np.where(inside, first + j, 0)] if hashes.size else total
            total = np.where(inside, mixed(total + part + np.uint64(j)), total)
    order = np.lexsort((total, text))
    total, text = total[order], text[order]
    new = np.ones(total.size, bool)
    new[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    return total[new], np.searchsorted(text[new], np.arange(len(n_words) + 1))


def _probe_order() -> np.ndarray:
    """For every bucket, the rank of every other one in the order it borrows in."""
    rng = np.random.default_rng(20240607)
    return np.argsort(rng.random((BUCKETS, BUCKETS)), axis=1).astype(np.uint16)


def registers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of 512 8-bit registers per text; rows of texts without shingles are 0."""
    n_texts = len(starts) - 1
    text = np.repeat(np.arange(n_texts), np.diff(starts))
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    # sorted within a text, so the first of a bucket is its smallest
    first = np.ones(hashes.size, bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    rest_bits = 64 - BUCKET_BITS
    rest = hashes[first] & np.uint64((1 << rest_bits) - 1)
    low = np.frexp((rest >> np.uint64(rest_bits - 53)).astype(np.float64))[1]
    zeros = np.minimum(53 - low, 31)  # leading zeros, exact as 53 bits fit a double
    shift = np.maximum(rest_bits - 1 - zeros - MANTISSA_BITS, 0).astype(np.uint64)
    mantissa = (rest >> shift) & np.uint64((1 << MANTISSA_BITS) - 1)
    out = np.zeros((n_texts, BUCKETS), np.uint8)
    filled = np.zeros((n_texts, BUCKETS), bool)
    out[text[first], bucket[first]] = (zeros.astype(np.uint8) << np.uint8(MANTISSA_BITS)) | mantissa.astype(np.uint8)
    filled[text[first], bucket[first]] = True
    ranks = _probe_order()
    for i in np.flatnonzero(filled.any(axis=1) & ~filled.all(axis=1)):
        own = np.flatnonzero(filled[i])
        empty = np.flatnonzero(~filled[i])
        out[i, empty] = out[i, own[ranks[np.ix_(empty, own)].argmin(axis=1)]]
    return out


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = rows.reshape(len(rows), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for j in range(BAND_ROWS):
        key = mixed(key + (parts[:, :, j] << np.uint64(8)) + np.uint64(j))
    return key.view(np.int64)


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of registers of unrelated sets of n and m shingles that agree by chance.

    The smallest hashes of a bucket with a and b shingles are about exponential
    with these rates; summed over the cells of a register with r mantissa bits
    they meet with probability 0.17 * 2 ** -r * 4ab / (a + b) ** 2, as published
    for HyperMinHash.
    """
    a, b = np.maximum(n / BUCKETS, 1.0), np.maximum(m / BUCKETS, 1.0)
    return 0.169919487159739 * 4 * a * b / (a + b) ** 2 / (1 << MANTISSA_BITS)


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of the sets behind two stacks of registers, corrected for collisions."""
    agree = (left == right).mean(axis=1)
    chance = expected_collisions(n, m)
    return (agree - chance) / (1 - chance)


def features(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per document: set size, a 128-bit key of the set, and its registers."""
    bound_batches(docs.sparkSession, TEXT_BATCH_BYTES)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                hashes, starts = shingles(part.column("text"), words)
                padded = np.concatenate([hashes, np.zeros(1, np.uint64)])
                own = np.minimum(starts[:-1], hashes.size)
                some = np.diff(starts) > 0
                with np.errstate(over="ignore"):
                    k1 = np.where(some, np.add.reduceat(padded, own), np.uint64(0))
                    k2 = np.where(some, np.add.reduceat(mixed(padded ^ np.uint64(0x5BF03635)), own), np.uint64(0))
                own = registers(hashes, starts)
                yield pa.record_batch({
                    "id": part.column("id"), "n": pa.array(np.diff(starts)),
                    "k1": pa.array(k1.view(np.int64)), "k2": pa.array(k2.view(np.int64)),
                    "registers": pa.array([r.tobytes() for r in own[:, :BANDED]], pa.binary()),
                    "probes": pa.array([r.tobytes() for r in own[:, BANDED:]], pa.binary())})

    return rows.mapInArrow(giving_back(compute), FEATURES_SCHEMA)


def _register_rows(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), size)


def band_rows(classes: DataFrame, wanted: Broadcast | None = None) -> DataFrame:
    """(key, id) per class and band; with a filter of keys, only those that may be in it."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_register_rows(batch.column("registers"), BANDED)).ravel()
            ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), BANDS)
            if wanted is not None:
                keep = may_contain(wanted.value, keys)
                keys, ids = keys[keep], ids[keep]
            yield pa.record_batch({"key": pa.array(keys), "id": pa.array(ids)})

    return classes.select("id", "registers").mapInArrow(giving_back(explode), "key bigint, id bigint")


def likely(pairs: DataFrame, classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Candidate pairs (a, b) whose sizes and estimated similarity allow a link."""
    least = threshold[0] / threshold[1]
    side = classes.select("id", "n", "probes")
    both = (
        pairs.join(side.toDF("a", "n_a", "r_a"), "a").join(side.toDF("b", "n_b", "r_b"), "b")
        .where(F.least("n_a", "n_b") * threshold[1] >= F.greatest("n_a", "n_b") * threshold[0]))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
            left, right = (_register_rows(batch.column(c), PROBES) for c in ("r_a", "r_b"))
            near = estimate(left, right, n, m)
            spread = np.sqrt(least * (1 - least) / np.minimum(np.minimum(n, m), PROBES))
            yield batch.select(["a", "b"]).filter(pa.array(near >= least - SLACK * spread))

    return both.mapInArrow(giving_back(keep), "a bigint, b bigint")


def shingle_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, set) of the documents named in ``ids``, and a few more: sorted 64-bit shingle hashes.

    The names are a broadcast filter, so that no text is shuffled.
    """
    named = bloom_filter(ids, "id")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"),
    ).where("id is not null")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = may_contain(named.value, batch.column("id").to_numpy(zero_copy_only=False))
            for part in byte_slices(batch.filter(pa.array(keep)), "text", SLICE_BYTES):
                hashes, starts = shingles(part.column("text"), words)
                yield pa.record_batch({"id": part.column("id"), "set": pa.ListArray.from_arrays(
                    pa.array(starts.astype(np.int32)), pa.array(hashes.view(np.int64)))})

    # rows that repeat an id are one document
    return rows.mapInArrow(giving_back(compute), "id bigint, set array<bigint>").dropDuplicates(["id"])


def verified(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    shared = F.size(F.array_intersect("s_a", "s_b"))
    united = F.size("s_a") + F.size("s_b") - shared
    return (
        pairs.join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
        .where(shared * threshold[1] >= united * threshold[0]).select("a", "b"))


def _further(
    members: DataFrame, comps: DataFrame, sets_of, threshold: tuple[int, int],
) -> DataFrame:
    """Links between members of one bucket that are still in different components.

    ``members`` is (key, id) of buckets of three and more. In each bucket the
    largest component is the target of all other members, once per component
    however many buckets they share; the other members are compared with each
    other per bucket. Targets are dealt into blocks, which one task holds while
    the others stream past, so no pair is ever a row unless it is a link.
    """
    tagged = members.join(comps.toDF("id", "comp"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    sizes = comps.groupBy("component").count().toDF("comp", "comp_size")
    in_bucket = tagged.groupBy("key", "comp").count().join(sizes, "comp", "left").withColumn(
        "comp_size", F.coalesce("comp_size", F.lit(1)))
    mains = in_bucket.groupBy("key").agg(
        F.max(F.struct("comp_size", "comp")).alias("main"), F.count(F.lit(1)).alias("n_comps"),
    ).where("n_comps > 1").select("key", F.col("main.comp").alias("main"), F.col("main.comp_size").alias("main_size"))
    others = stored(
        tagged.join(mains, "key").where((F.col("comp") != F.col("main")) | (F.col("main_size") == 1)), "near-others")
    # against the main component, if it has more than one document
    to_main = others.where("main_size > 1").select(F.col("main").alias("goal"), "id", "comp").distinct()
    goals = to_main.select("goal").distinct()
    in_goals = comps.join(goals, comps["component"] == goals["goal"]).select(
        "goal", F.col("node").alias("id"), F.col("goal").alias("comp"))
    # among each other: the bucket is the goal
    buckets = others.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("goal"))
    among = others.select(F.col("key").alias("goal"), "id", "comp").join(buckets, "goal")
    held = in_goals.withColumn("kind", F.lit(0)).unionByName(among.withColumn("kind", F.lit(1)))
    asked = to_main.withColumn("kind", F.lit(0)).unionByName(among.withColumn("kind", F.lit(1)))
    blocks = held.groupBy("kind", "goal").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    held = held.join(blocks, ["kind", "goal"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("role", F.lit(0))
    asked = asked.join(blocks, ["kind", "goal"]).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("role", F.lit(1))
    columns = ["kind", "goal", "block", "role", "id", "comp"]
    rows = stored(held.select(*columns).unionByName(asked.select(*columns)), "near-blocks")
    sets = stored(sets_of(rows.select("id").distinct()), "near-sets")
    dealt = rows.join(sets, "id").repartition("kind", "goal", "block").sortWithinPartitions(
        "kind", "goal", "block", "role", "id")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, comp, size, owner, values = None, [], [], [], [], []
        table = None
        for batch in batches:
            found_a, found_b = [], []
            keys = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            lists = batch.column("set")
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)
            for i, (kind, goal, number, role, doc, own) in enumerate(keys):
                if (kind, goal, number) != block:
                    block, ids, comp, values, table = (kind, goal, number), [], [], [], None
                mine = flat[bounds[i]:bounds[i + 1]]
                if role == 0:
                    ids.append(doc)
                    comp.append(own)
                    values.append(mine.copy())
                    table = None
                    continue
                if not ids:
                    continue
                if table is None:
                    size = np.array([v.size for v in values])
                    every = np.concatenate(values)
                    order = np.argsort(every, kind="stable")
                    table = (every[order], np.repeat(np.arange(len(ids)), size)[order], np.array(ids), np.array(comp))
                ordered, owner, id_row, comp_row = table
                at = np.searchsorted(ordered, mine, "left")
                upto = np.searchsorted(ordered, mine, "right")
                spans = upto - at
                total = int(spans.sum())
                if not total:
                    continue
                ends = np.cumsum(spans)
                place = np.arange(total) + np.repeat(at - (ends - spans), spans)
                shared = np.bincount(owner[place], minlength=len(ids))
                united = size + mine.size - shared
                linked = (shared * threshold[1] >= united * threshold[0]) & (comp_row != own)
                for other in id_row[linked].tolist():
                    found_a.append(min(doc, other))
                    found_b.append(max(doc, other))
            yield pa.record_batch({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    bound_batches(dealt.sparkSession, TEXT_BATCH_BYTES)
    return dealt.select(*columns, "set").mapInArrow(giving_back(compare), "a bigint, b bigint").where("a <> b").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
    threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """Per row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept.

    Null and empty texts have no shingles and are alone. Rows of equal id are one
    document, whose texts should agree; rows without id are alone too, with
    a null component, and are kept. An empty table gives no rows. Other columns
    are not read, whatever their names.
    """
    all_rows = stored(features(docs, id_col, text_col, words), "near-features")
    usable = all_rows.where("n > 0 and id is not null")
    same = usable.groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"))
    # smallest id of each set; most sets are their own
    reps = same.select(F.col("rep").alias("id")).distinct()
    classes = stored(usable.join(reps, "id", "left_semi").dropDuplicates(["id"]), "near-classes")

    bands = band_rows(classes)
    groups = bands.groupBy("key").agg(
        F.min("id").alias("lead"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = stored(groups, "near-groups")
    crowded = groups.where("n > 2").select("key", "lead")
    members = stored(band_rows(classes, bloom_filter(crowded, "key")).join(crowded, "key"), "near-members")
    stars = groups.where("n = 2").select(F.col("lead").alias("a"), F.col("last").alias("b")).unionByName(
        members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b"))).distinct()
    hopeful = stored(likely(stars, classes, threshold), "near-likely")

    def sets_of(ids: DataFrame) -> DataFrame:
        return shingle_sets(docs, ids, id_col, text_col, words)

    ends = hopeful.select(F.col("a").alias("id")).unionByName(hopeful.select(F.col("b").alias("id"))).distinct()
    links = stored(verified(hopeful, stored(sets_of(ends), "near-sets"), threshold), "near-links")
    first = components(links, "near-components")
    more = stored(_further(members.select("key", "id"), stored(first, "near-first"), sets_of, threshold), "near-more")
    final = components(links.unionByName(more), "near-components")

    labelled = same.join(final.toDF("rep", "component"), "rep", "left").select(
        "n", "k1", "k2", F.coalesce("component", "rep").alias("component"))
    usable_rows = usable.select("id", "n", "k1", "k2").join(labelled, ["n", "k1", "k2"]).select("id", "n", "component")
    alone = all_rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component"))
    return usable_rows.unionByName(alone).select(
        "id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each group of near copies; all columns stay."""
    gone = near_duplicates(docs, id_col=id_col, **options).where("not kept").select(
        F.col("id").alias("__gone_id")).distinct()
    gone = broadcast_if_small(stored(gone, "near-gone"))  # measured; beyond its bound the join shuffles
    return docs.join(gone, docs[id_col] == gone["__gone_id"], "left_anti")
