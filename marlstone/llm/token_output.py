"""Token ids of all documents in id order, as Simple-8b segments in a Parquet dataset.

A segment is a row: the documents in it, their token counts, and the packed ids.
Its shard is the number of the range partition that wrote it, and ``shard_start``
counts the ids before it in that shard, so any document's place is known from
one running sum over shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm import simple8b
from marlstone.llm.arrays import TEXT_BATCH_BYTES, bound_batches, byte_slices, giving_back
from marlstone.llm.tokens import worker_encoder

SEGMENT_BYTES = 4 << 20  # text of a segment; a longer text is one segment

SEGMENT_SCHEMA = (
    "shard int, segment int, shard_start bigint, n_ids bigint, doc_ids array<bigint>, "
    "doc_tokens array<bigint>, block_offsets binary, words binary, escapes binary"
)
READ_SCHEMA = "shard int, shard_start bigint, id bigint, n_tokens bigint, ids_crc32 bigint"


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """``end_id`` put after the ids of every document."""
    out = np.full(ids.size + counts.size, end_id, np.int64)
    out[np.arange(ids.size) + np.repeat(np.arange(counts.size), counts)] = ids
    return out


def segments(
    docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    order: Sequence[str] = (),
) -> DataFrame:
    """Segments of the documents in ascending id order, or in that of the columns ``order``.

    Null text is empty: only its end id is written. Rows of equal id follow each
    other in the order of their texts; rows without id come first. An empty
    table gives no segment. Other columns are not read.
    """
    bound_batches(docs.sparkSession, TEXT_BATCH_BYTES)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[F.col(c).alias(f"order{k}") for k, c in enumerate(order)])
    given = [f"order{k}" for k in range(len(order))]
    # the text is in the range as well, so that a repeated id can be split
    ordered = rows.repartitionByRange(*given, "id", F.substring("text", 1, 64)).sortWithinPartitions(
        *given, "id", "text").select("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = worker_encoder(tokenizer), TaskContext.get().partitionId()
        segment = start = 0
        for batch in batches:
            for part in byte_slices(batch, "text", SEGMENT_BYTES):
                ids, counts = encoder.encode(part.column("text"))
                ids, counts = _with_end(ids, counts, end_id), counts + 1
                packed = simple8b.pack(ids)
                yield pa.record_batch({
                    "shard": pa.array([shard], pa.int32()), "segment": pa.array([segment], pa.int32()),
                    "shard_start": pa.array([start], pa.int64()), "n_ids": pa.array([ids.size], pa.int64()),
                    "doc_ids": pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                    "doc_tokens": pa.array([counts], pa.list_(pa.int64())),
                    "block_offsets": [packed.offsets.astype("<u4").tobytes()],
                    "words": [packed.words.astype("<u8").tobytes()],
                    "escapes": [packed.escapes.astype("<u8").tobytes()],
                })
                segment, start = segment + 1, start + ids.size

    return ordered.mapInArrow(giving_back(encode), SEGMENT_SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    """Write the dataset; Spark's committer makes a lost executor's files vanish."""
    segments(docs, tokenizer, **options).write.mode("overwrite").option("compression", "none").parquet(path)


def segment_ids(row: dict) -> np.ndarray:
    packed = simple8b.Packed(
        np.frombuffer(row["words"], "<u8"), np.frombuffer(row["block_offsets"], "<u4"),
        np.frombuffer(row["escapes"], "<u8"))
    return simple8b.unpack(packed, row["n_ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: id, start, n_tokens, crc32 of its ids."""
    stored = spark.read.parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = segment_ids(row).astype("<u4")
                ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
                starts = ends - np.array(row["doc_tokens"], np.int64)
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                yield pa.record_batch({
                    "shard": pa.array([row["shard"]] * len(crcs), pa.int32()),
                    "shard_start": pa.array(row["shard_start"] + starts, pa.int64()),
                    "id": pa.array(row["doc_ids"], pa.int64()),
                    "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                })

    bound_batches(spark, TEXT_BATCH_BYTES)
    # one row per task that wrote, so a sum over all of them is small
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base"))
    docs = stored.mapInArrow(giving_back(decode), READ_SCHEMA)
    return docs.join(F.broadcast(bases), "shard").select(
        "id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
