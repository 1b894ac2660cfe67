"""File manifest: what arrived, and what changed since the last run."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources import sinks

# A file is hashed in pieces of this many bytes, whatever its size.
CHUNK_BYTES = 8 * 1024 * 1024
TASK_BYTES = 256 * 1024 * 1024

MANIFEST_SCHEMA = (
    "logical_name string, filename string, source_url string, bytes bigint, "
    "modified timestamp, sha256 string, status string"
)
_SCAN_SCHEMA = (
    "logical_name string, filename string, source_url string, bytes bigint, "
    "modified timestamp, sha256 string"
)


def _relative_name(spark: SparkSession, url: Column, root: str) -> Column:
    """The file's path below the part of ``root`` before any wildcard; its base name where ``root`` is the file.

    Files of sibling folders may share a base name, so that alone is no key. An
    address that is not below the root, as behind a link, is its own key.
    """
    wild = re.search(r"[*?\[{]", root)
    fixed = root[:root.rfind("/", 0, wild.start()) + 1] or "." if wild else root
    folder = sinks.qualified(spark, fixed).rstrip("/") + "/"
    return F.when(url.startswith(folder), F.substring(url, len(folder) + 1, F.length(url))).when(
        url == folder[:-1], F.element_at(F.split(url, "/"), -1)).otherwise(url)


def with_digests(listing: DataFrame) -> DataFrame:
    """``listing`` with the SHA-256 of every file, read as a stream by the task that has its row."""
    chunk = CHUNK_BYTES

    def digests(batches):
        import hashlib
        import re

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            found = []
            for url in batch.column("source_url").to_pylist():
                if re.match(r"(file:)?/", url):
                    store, path = fs.LocalFileSystem(), re.sub(r"^file:(//)?(?=/)", "", url)
                else:
                    root = re.match(r"[^:]+://[^/]*", url)[0]
                    store, _ = fs.FileSystem.from_uri(root + "/")
                    # object stores name the bucket in the path, file systems in the root
                    path = url[len(root):] if root.startswith(("hdfs", "viewfs")) else url.split("://", 1)[1]
                digest = hashlib.sha256()
                with store.open_input_stream(path, compression=None) as stream:
                    while piece := stream.read(chunk):
                        digest.update(piece)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "sha256"])

    return listing.mapInArrow(digests, _SCAN_SCHEMA)


def scan_files(spark: SparkSession, files: Mapping[str, str]) -> DataFrame:
    """One row per file of each logical source: size, modification time, SHA-256.

    Spark lists the files without reading them; each is then hashed by one task
    in pieces, so memory does not grow with a file. A task takes about
    TASK_BYTES of files, so that many small ones do not become as many tasks. A
    file that a pattern of the root names twice is one row.
    """
    scanned = None
    for name, path in files.items():
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        url = F.col("path")
        part = listing.select(
            F.lit(name).alias("logical_name"), _relative_name(spark, url, path).alias("filename"),
            url.alias("source_url"), F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"))
        scanned = part if scanned is None else scanned.unionByName(part)
    listing = scanned.dropDuplicates(["logical_name", "filename"])
    count, size = listing.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(count, max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))))
    return with_digests(listing.repartition(tasks))


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def compare(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Status per file: unchanged_skipped when its content is the one seen last time."""
    before = previous.select("logical_name", "filename", F.col("sha256").alias("_sha256"))
    unchanged = F.col("sha256") == F.col("_sha256")
    return current.join(before, ["logical_name", "filename"], "left").select(
        *current.columns,
        F.when(unchanged, "unchanged_skipped").otherwise("downloaded").alias("status"),
    )


def changed_files(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.col("status") != "unchanged_skipped")


def gone_files(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Files of the previous manifest that are no longer there."""
    return previous.join(current, ["logical_name", "filename"], "left_anti")
