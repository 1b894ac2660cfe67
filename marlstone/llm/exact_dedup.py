"""Exact dedup: a two-pass Bloom filter finds the rows that may repeat; only those shuffle.

Built from DataFrame functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import stored
from marlstone.operators.joins import broadcast_if_small
from marlstone.sources.sinks import work_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BITS_PER_ROW = 8
# The two filters that are broadcast take this many bits each at most (64 MB), enough
# for 67 million rows. More rows take several passes, each over the digests of its own
# range with filters of its own, so that the share of suspect rows does not grow. Past
# the last pass's room (a billion rows) the filters fill up, so more rows are suspect
# and shuffle, as an id and a digest: slower, never wrong.
MAX_FILTER_BITS = 1 << 29
MAX_PASSES = 16
# A digest of more rows than this, or than this share of all, is hot: there are at
# most 10,000 of them, so they are broadcast and their rows never shuffle.
HOT_ROWS, HOT_SHARE = 1000, 10_000
_SEGMENT_BITS = 32768  # bits of one bitmap of bitmap_construct_agg


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, nothing else; lower() is faster and enough where all is ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def fingerprints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"), F.sha2(lower_ascii(text).cast("binary"), 256).alias("digest"))


def _position(k: int, bits: int) -> Column:
    return F.pmod(F.xxhash64("digest", F.lit(k)), F.lit(bits)) + 1


def repeated_bits(prints: DataFrame, bits: int) -> DataFrame:
    """Pass one: per filter, the bits that two or more rows fall on, as bitmaps.

    Counts are combined before the shuffle, so a digest that a third of the
    rows share arrives as one count per task.
    """
    positions = prints.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("filter"), _position(k, bits).alias("position")) for k in (0, 1)
    ])).alias("p")).select("p.*")
    repeated = positions.groupBy("filter", "position").count().where("count > 1")
    return repeated.groupBy(
        "filter", F.bitmap_bucket_number("position").alias("segment"),
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bits"))


def _bit_is_set(bits: Column, position: Column) -> Column:
    at = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("bigint"), (at % 8).cast("int")) == 1, F.lit(False))


def with_suspicion(prints: DataFrame, filters: DataFrame, bits: int) -> DataFrame:
    """Pass two: a row is suspect when both of its bits are hit repeatedly."""
    rows, suspect = prints, F.lit(True)
    for k in (0, 1):
        segment, own = f"segment{k}", f"bits{k}"
        part = filters.where(F.col("filter") == k).select(
            F.col("segment").alias(segment), F.col("bits").alias(own))
        rows = rows.withColumn(segment, F.bitmap_bucket_number(_position(k, bits)))
        # at most MAX_FILTER_BITS / 8 bytes
        rows = rows.join(F.broadcast(part), segment, "left")
        suspect = suspect & _bit_is_set(F.col(own), _position(k, bits))
    return rows.select("id", "digest", suspect.alias("suspect"))


def flagged_rows(prints: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of stored prints with their suspicion, pass by pass; stored."""
    passes = min(max(1, -(-BITS_PER_ROW * n // MAX_FILTER_BITS)), MAX_PASSES)
    bits = min(1 << (max(BITS_PER_ROW * -(-n // passes), _SEGMENT_BITS) - 1).bit_length(), MAX_FILTER_BITS)
    if passes == 1:
        return stored(with_suspicion(prints, repeated_bits(prints, bits), bits), "exact-flagged")
    # rows of one pass lie together in every file, so that a pass reads little of the others'
    ranged = stored(prints.withColumn("pass", F.pmod(F.xxhash64("digest", F.lit("pass")), F.lit(passes)).cast(
        "int")).sortWithinPartitions("pass"), "exact-ranged")
    path = work_path(prints.sparkSession, "exact-flagged")
    for k in range(passes):
        own = ranged.where(F.col("pass") == k).drop("pass")
        found = with_suspicion(own, repeated_bits(own, bits), bits)
        found.write.parquet(f"{path}/pass={k}")
    return prints.sparkSession.read.schema(found.schema).parquet(path).select(*found.columns)


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty, and empty texts equal each other. Of equal texts the largest id
    stays. Rows that repeat both id and text share their verdict; a row without
    id stays only where no equal text has one. An empty table gives no rows.
    Other columns of ``docs`` are not looked at, whatever their names.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "exact-prints")
    n = prints.count()
    flagged = flagged_rows(prints, n)
    suspects = flagged.where("suspect").select("id", "digest")
    groups = stored(suspects.groupBy("digest").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "exact-groups")
    is_hot = F.col("group_size") > max(HOT_ROWS, n // HOT_SHARE)
    hot = F.broadcast(groups.where(is_hot))

    def alone(rows: DataFrame) -> DataFrame:
        return rows.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "digest")

    columns = ["id", "keep_id", "group_size", "digest"]
    cold = suspects.join(hot, "digest", "left_anti").join(
        groups.where(~is_hot).withColumnsRenamed({"keep_id": "k", "group_size": "g"}), "digest", "left").select(
        "id", F.when(F.col("g").isNull(), F.col("id")).otherwise(F.col("k")).alias("keep_id"),
        F.coalesce("g", F.lit(1).cast("bigint")).alias("group_size"), "digest")
    every = alone(flagged.where("not suspect")).unionByName(
        suspects.join(hot, "digest").select(*columns)).unionByName(cold)
    return every.select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose equal text has a larger id; all columns stay.

    No column may be named __gone_id or __gone_digest.
    """
    gone = duplicates(docs, id_col, text_col).where("not kept").select(
        F.col("id").alias("__gone_id"), F.col("digest").alias("__gone_digest")).distinct()
    gone = broadcast_if_small(stored(gone, "exact-gone"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.sha2(lower_ascii(text).cast("binary"), 256)
    return docs.join(
        gone, docs[id_col].eqNullSafe(gone["__gone_id"]) & (own == gone["__gone_digest"]), "left_anti")
