"""Token counts: only lengths leave the encoder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import bound_batches, byte_slices
from marlstone.llm.tokens import worker_encoder

SCHEMA = "id bigint, n_bytes bigint, n_tokens bigint"
SLICE_BYTES = 4 << 20


def token_counts(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, UTF-8 bytes and tokens of the whole text.

    Counts are those of the library without added special tokens, truncation or
    padding; special strings inside a text are handled as the file says. Null
    and empty texts have none; ids may repeat or be null; other columns are not
    read. The work runs in batches of about equal bytes, and a text longer than
    a batch is encoded piece by piece (a tokenizer without safe boundaries gets
    it whole).
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                texts = part.column("text")
                yield pa.record_batch({
                    "id": part.column("id"), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                    "n_tokens": pa.array(encoder.counts(texts))})

    return rows.mapInArrow(count, SCHEMA)
