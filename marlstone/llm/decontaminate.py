"""Benchmark decontamination: token windows of documents against a broadcast set of test n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import (
    LETTER_OR_DIGIT, TEXT_BATCH_BYTES, Words, bound_batches, byte_slices, giving_back, lowered, mixed,
    ragged_positions, split_words, text_buffer,
)
from marlstone.llm.spans import text_key
from marlstone.llm.storage import stored
from marlstone.operators.joins import broadcast_if_small

WINDOW = 10
# Items are indexed in blocks of about this many bytes of text; each block is
# one broadcast, so a larger benchmark means more blocks, not a larger one. An
# index takes about five bytes for each of its text.
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 1 << 20  # of text compared at once: a word takes some hundred bytes while it is

HITS = ("starts", "ends", "byte_starts", "byte_ends", "items")
HITS_SCHEMA = (
    "id bigint, k1 bigint, k2 bigint, n_words bigint, starts array<bigint>, ends array<bigint>, "
    "byte_starts array<bigint>, byte_ends array<bigint>, items array<string>"
)


@dataclass(frozen=True)
class Windows:
    """Distinct windows of one length, by rising hash.

    ``places`` are where each stands in the items' words, to verify a hit with;
    ``first`` is where its items begin among ``owners``.
    """

    seed: int
    hashes: np.ndarray
    places: np.ndarray
    first: np.ndarray
    owners: np.ndarray


@dataclass(frozen=True)
class Index:
    vocabulary: pa.Array
    words: np.ndarray  # of all items end to end, as places in the vocabulary
    names: list[str]
    lengths: dict[int, Windows]


def _words(texts: pa.Array) -> Words:
    data, offsets = text_buffer(texts)
    return split_words(lowered(data), offsets, LETTER_OR_DIGIT)


def _gram_hash(columns, seed: int) -> np.ndarray:
    total = None
    with np.errstate(over="ignore"):
        for j, codes in enumerate(columns):
            part = mixed(codes.astype(np.uint64) + np.uint64((j + 1) << 40) + np.uint64(seed << 56))
            total = part if total is None else total + part
    return total


def window_set(ids: list, texts: pa.Array, window: int = WINDOW) -> Index:
    """The items' windows; an item of fewer words, but not none, is one window."""
    words = _words(texts)
    codes = words.codes.astype(np.int32)
    found: dict[int, list] = {}
    for item, (a, b) in enumerate(zip(words.before[:-1], words.before[1:], strict=True)):
        size = min(window, b - a)
        if size:
            starts = np.arange(a, b - size + 1)
            found.setdefault(int(size), []).append((starts, np.full(starts.size, item)))
    lengths = {}
    for size, parts in found.items():
        starts, items = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        grams = codes[starts[:, None] + np.arange(size)]
        grams, first_at, place = np.unique(grams, axis=0, return_index=True, return_inverse=True)
        owners = np.unique(np.stack([place.ravel(), items], 1), axis=0)
        seed = 0
        while True:  # another seed for as long as two windows share a hash
            hashes = _gram_hash(grams.T, seed)
            order = np.argsort(hashes)
            if np.all(hashes[order][1:] > hashes[order][:-1]):
                break
            seed += 1
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        owners = owners[np.argsort(rank[owners[:, 0]], kind="stable")]
        first = np.searchsorted(rank[owners[:, 0]], np.arange(len(order) + 1))
        lengths[size] = Windows(
            seed, hashes[order], starts[first_at][order].astype(np.int32), first.astype(np.int32),
            owners[:, 1].astype(np.int32))
    return Index(words.distinct, codes, ["" if i is None else str(i) for i in ids], lengths)


def window_hits(index: Index, words: Words) -> Iterator[tuple]:
    """Per window length: word positions and numbers of the windows that stand there, and those windows."""
    known = pc.fill_null(pc.index_in(words.distinct, index.vocabulary), -1)
    table = known.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = table[words.codes] if table.size else words.codes
    unknown = np.concatenate([[0], np.cumsum(codes < 0)])
    text_end = np.repeat(words.before[1:], np.diff(words.before))
    for size, windows in index.lengths.items():
        start = np.arange(max(0, codes.size - size + 1))
        start = start[(unknown[start + size] == unknown[start]) & (start + size <= text_end[start])]
        if not start.size:
            continue
        own = _gram_hash((codes[start + j] for j in range(size)), windows.seed)
        place = np.minimum(np.searchsorted(windows.hashes, own), len(windows.hashes) - 1)
        keep = windows.hashes[place] == own
        start, place = start[keep], place[keep]
        # verified word by word: an equal hash is not enough
        keep = np.ones(start.size, bool)
        for j in range(size):
            keep &= codes[start + j] == index.words[windows.places[place] + j]
        yield size, start[keep], place[keep], windows


def _scan(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text")
    words = _words(texts)
    n, n_docs = words.codes.size, batch.num_rows
    cover = np.zeros(n + 1, np.int64)
    doc_of = np.repeat(np.arange(n_docs), np.diff(words.before))
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for size, start, place, windows in window_hits(index, words):
        np.add.at(cover, start, 1)
        np.add.at(cover, start + size, -1)
        begin = windows.first[place].astype(np.int64)
        many = windows.first[place + 1] - begin
        pairs.append((np.repeat(doc_of[start], many), windows.owners[ragged_positions(begin, many)]))
    hit = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
    # a run of hit words ends at a text's end too
    at_start = np.zeros(n + 1, bool)
    at_start[words.before[:-1]] = True
    opens = np.flatnonzero(hit[1:-1] & (~hit[:-2] | at_start[:n]))
    closes = np.flatnonzero(hit[1:-1] & (~hit[2:] | at_start[1:n + 1]))
    run_doc = doc_of[opens]
    cuts = np.searchsorted(run_doc, np.arange(n_docs + 1))
    data_start = text_buffer(texts)[1]
    items: list[list[str]] = [[] for _ in range(n_docs)]
    if pairs:
        met = np.unique(np.stack([np.concatenate([p[k] for p in pairs]) for k in (0, 1)], 1), axis=0)
        for doc, item in met.tolist():
            if index.names[item]:
                items[doc].append(index.names[item])

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(cuts.astype(np.int32), pa.array(values.astype(np.int64)))

    base, byte_base = words.before[run_doc], data_start[run_doc]
    return pa.record_batch({
        "id": batch.column("id"), "k1": batch.column("k1"), "k2": batch.column("k2"),
        "n_words": np.diff(words.before),
        "starts": lists(opens - base), "ends": lists(closes + 1 - base),
        "byte_starts": lists(words.starts[opens] - byte_base),
        "byte_ends": lists(words.starts[closes] + words.lengths[closes] - byte_base),
        "items": pa.array(items, pa.list_(pa.string())),
    })


def find_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Runs of hit words per document and block of items, and the items that occur in it.

    ``starts``/``ends`` count words, ``byte_starts``/``byte_ends`` UTF-8 bytes
    of the text. Words are runs of letters, digits and non-ASCII characters,
    A-Z lower-cased. An item with fewer words than ``window`` is one window; an
    item or document without words, or null, hits nothing. Items of equal id
    are one item; an item without id still marks words. Empty tables are fine.
    There is one row per row of ``docs``, with the two hashes of its text (k1,
    k2); ids may repeat or be null. Where the items take several blocks, each
    reads the documents once, and only the texts that it hits are brought together.
    """
    spark = docs.sparkSession
    bound_batches(spark, TEXT_BATCH_BYTES)
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"),
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).select(
        "id", *text_key(F.col("text")), "text")

    def scanned(block: int) -> DataFrame:
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        got = own.toArrow()
        index = spark.sparkContext.broadcast(
            window_set(got.column("item").to_pylist(), got.column("text").combine_chunks(), window))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in byte_slices(batch, "text", SLICE_BYTES):
                    yield _scan(index.value, part)

        return rows.mapInArrow(giving_back(scan), HITS_SCHEMA)

    if blocks == 1:
        return scanned(0)
    first = stored(scanned(0), "window-hits")
    hit = first.where(F.size("starts") > 0).select("k1", "k2", *HITS).dropDuplicates(["k1", "k2"])
    for block in range(1, blocks):
        more = stored(scanned(block).where(F.size("starts") > 0).select("k1", "k2", *HITS), "window-hits")
        hit = hit.unionByName(more.dropDuplicates(["k1", "k2"]))
    texts = stored(hit.groupBy("k1", "k2").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in HITS]), "window-texts")  # a list of at most one entry a block
    kinds = dict(first.dtypes)
    return first.drop(*HITS).join(broadcast_if_small(texts), ["k1", "k2"], "left").select(
        "id", "k1", "k2", "n_words",
        *[F.coalesce(F.col(c), F.array().cast(kinds[c])).alias(c) for c in HITS])


def report(hits: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit (words inside any window) and its sorted items."""
    def covered(acc: Column, run: Column) -> Column:
        new = F.greatest(run["ends"] - F.greatest(run["starts"], acc["last"]), F.lit(0))
        return F.struct(F.greatest(acc["last"], run["ends"]).alias("last"), (acc["total"] + new).alias("total"))

    none = F.struct(F.lit(0).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("total"))
    return hits.select(
        "id", "n_words", F.aggregate(F.array_sort(F.arrays_zip("starts", "ends")), none, covered)["total"].alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """``docs`` without documents that hold a window of the benchmark; all columns stay.

    Rows are told apart by their texts, so ids may repeat or be null.
    """
    text_col = names.get("text_col", "text")
    hits = find_hits(docs, benchmark, **names).where(F.size("starts") > 0)
    gone = broadcast_if_small(stored(hits.select("k1", "k2").distinct(), "contaminated"))
    k1, k2 = text_key(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(gone, (k1 == gone["k1"]) & (k2 == gone["k2"]), "left_anti")


def cut_spans(text: bytes, starts: list[int], ends: list[int]) -> bytes:
    """``text`` with every run of hit words replaced by one line break."""
    out, last = [], 0
    for a, b in sorted(zip(starts, ends, strict=True)):
        if a > last or not out:
            out.append(text[last:a])
        last = max(last, b)
    return b"\n".join([*out, text[last:]]) if out else text


def remove_spans(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """``docs`` with the hit passages cut out of the text; rows without hits pass as they are.

    Rows are told apart by their texts, so ids may repeat or be null.
    """
    text_col = names.get("text_col", "text")
    hits = stored(find_hits(docs, benchmark, **names).where(F.size("starts") > 0).select(
        "k1", "k2", "byte_starts", "byte_ends").dropDuplicates(["k1", "k2"]), "hit-texts")
    hits = broadcast_if_small(hits)
    k1, k2 = text_key(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    joined = docs.join(hits, (k1 == hits["k1"]) & (k2 == hits["k2"]), "left")

    @F.pandas_udf("string")
    def cut(text, starts, ends):
        return text.combine(starts, lambda t, s: (t, s)).combine(
            ends, lambda ts, e: ts[0] if ts[1] is None or ts[0] is None
            else cut_spans(ts[0].encode(), list(ts[1]), list(e)).decode())

    put = F.when(hits["k1"].isNull(), docs[text_col]).otherwise(
        cut(docs[text_col].cast("string"), hits["byte_starts"], hits["byte_ends"]))
    return joined.select(*[put.alias(c) if c == text_col else docs[c] for c in docs.columns])
