"""The corpus pipeline: documents in, packed token ids out, every step a table.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.
Its result is written as Parquet and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import decontaminate, mixing, near_dedup, quality, token_output
from marlstone.llm.queries import tokenizer_path
from marlstone.llm.registry import table
from marlstone.llm.storage import stored
from marlstone.sources.sinks import work_path

MIX_SEED = 20240607


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    model = quality.train(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.select_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8."""
    return near_dedup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources level off, in random order."""
    return mixing.mix(docs, mixing.source_rates(docs), seed=MIX_SEED).drop("mix_copy", "mix_key")


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in id order; per document what the files hold of it."""
    path = work_path(spark, "pipeline-tokens")
    token_output.write_tokens(docs, path, tokenizer_path())
    return token_output.read_tokens(spark, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", keep_quality),
    ("near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("source mixing", mix_sources),
    ("token output", write_ids),
]

# a fitted model decides the first stage, which SQL cannot say
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
