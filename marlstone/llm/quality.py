"""Quality by ordinal cumulative-link regression on graded ratings.

One weight per hashed text feature gives a score; ordered thresholds cut it into
grades: P(grade >= k) = sigmoid(score - threshold_k). Selection uses the
probability of the top grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import (
    NOT_SPACE, TEXT_BATCH_BYTES, bound_batches, byte_slices, giving_back, split_words, text_buffer,
)
from marlstone.llm.storage import stored

FEATURE_BITS = 24
HEADS = (4, 5, 6, 7)  # characters of a word's beginning, which its inflections share
# Labelled rows that the model is fitted on: the first so many by hash of their id.
SAMPLE_ROWS = 8000
MIN_DOCS = 4  # of the sample, that a feature must occur in
# Association with the grade that a feature must show, as chi-square and as chi-square
# per document: words of single documents would only be learned by heart.
LEAST_CHI2, LEAST_CHI2_SHARE = 15.0, 0.0075
ROUNDS, RATE, L2 = 1000, 0.1, 1e-5

SCORE_SCHEMA = "id bigint, expected_grade double, top_probability double"

_SHAPES = np.arange(256, dtype=np.uint8)
_SHAPES[0x41:0x5B], _SHAPES[0x61:0x7B], _SHAPES[0x30:0x3A], _SHAPES[0x80:] = ord("X"), ord("x"), ord("9"), ord("x")
_SHAPE_TABLE = bytes(_SHAPES)
_EDGES = bytes(b for b in range(0x21, 0x80) if not chr(b).isalnum())


class Model(NamedTuple):
    features: np.ndarray  # sorted hashed features with a weight
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades


def _hash(kind: bytes, value: bytes) -> int:
    return xxhash.xxh3_64_intdigest(kind + value) >> (64 - FEATURE_BITS)


def _shape(token: bytes) -> bytes:
    shape = token.translate(_SHAPE_TABLE)
    return bytes(b for i, b in enumerate(shape) if i == 0 or b != shape[i - 1])


def text_features(texts: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value): words and word beginnings present, share of each token shape, repetition.

    With ``known``, of words only those features. Texts without a token have none.
    """
    data, offsets = text_buffer(texts)
    words = split_words(data, offsets, NOT_SPACE)
    n_texts, counts = len(offsets) - 1, np.diff(words.before)
    doc = np.repeat(np.arange(n_texts), counts)
    distinct = words.distinct.to_pylist()
    plain = [t.strip(_EDGES).decode().lower() for t in distinct]
    stems = np.fromiter((_hash(b"w", w.encode()) for w in plain), np.int64, len(distinct))
    heads = [np.fromiter((_hash(b"h", w[:n].encode()) for w in plain), np.int64, len(distinct)) for n in HEADS]
    shapes = np.fromiter((_hash(b"s", _shape(t)) for t in distinct), np.int64, len(distinct))
    if not doc.size:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    base = np.int64(1 << FEATURE_BITS)
    parts = []
    for kind in (stems, *heads):
        if known is None:
            parts.append(doc * base + kind[words.codes])
        else:
            here = np.isin(kind, known)[words.codes]
            parts.append(doc[here] * base + kind[words.codes[here]])
    present = np.unique(np.concatenate(parts))
    shaped, times = np.unique(doc * base + shapes[words.codes], return_counts=True)
    share = np.sqrt(times / counts[shaped // base])
    variety = np.bincount(np.unique(doc * np.int64(len(distinct)) + words.codes) // len(distinct), minlength=n_texts)
    filled = np.flatnonzero(counts)
    ratio = np.minimum((variety[filled] * 10) // counts[filled], 9)
    length = np.minimum(np.log2(counts[filled]).astype(np.int64), 12)
    numeric = np.array([[_hash(b"r", bytes([r, n])) for n in range(13)] for r in range(10)])
    return (np.concatenate([present // base, shaped // base, filled]),
            np.concatenate([present % base, shaped % base, numeric[ratio, length]]),
            np.concatenate([np.ones(present.size), 3 * share, np.ones(filled.size)]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def associated(sample: DataFrame) -> np.ndarray:
    """Features whose documents have other grades than the rest, by a chi-square test.

    ``sample`` has a grade and a list of features per document. Counting stays on
    the executors; only features that pass come to the driver.
    """
    shares = {r["grade"]: r["count"] for r in sample.groupBy("grade").count().collect()}
    n = sum(shares.values())
    per_grade = [F.sum((F.col("grade") == g).cast("bigint")).alias(f"g{g}") for g in shares]
    counts = sample.select("grade", F.explode(F.array_distinct("features")).alias("feature")).groupBy("feature").agg(
        F.count(F.lit(1)).alias("total"), *per_grade)
    expected = {g: F.col("total") * share / n for g, share in shares.items()}
    chi2 = sum((F.pow(F.col(f"g{g}") - expected[g], 2) / expected[g] for g in shares), F.lit(0.0))
    least = max(LEAST_CHI2, LEAST_CHI2_SHARE * n)
    kept = counts.where((F.col("total") >= MIN_DOCS) & (chi2 >= least)).select("feature")
    return np.array(sorted(r["feature"] for r in kept.collect()), np.int64)


def fit_model(rows: np.ndarray, features: np.ndarray, values: np.ndarray, grades: np.ndarray) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over all rows."""
    n_docs, n_grades = len(grades), int(grades.max(initial=0)) + 1
    if n_grades < 2 or len(np.unique(grades)) < 2:
        # nothing to tell apart: everything is of the one grade seen
        return Model(np.zeros(0, np.int64), np.zeros(0), np.full(1, -40.0))
    kinds, column = np.unique(features, return_inverse=True)
    weights = np.zeros(kinds.size)
    # thresholds start at the shares of the grades; later ones are kept above by steps' logs
    above = np.array([max(1, (grades >= k).sum()) / n_docs for k in range(1, n_grades)])
    cuts = -np.log(above / (1 - above + 1e-6) + 1e-9)
    shift = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    params = np.concatenate([weights, shift])
    mean, square = np.zeros(params.size), np.zeros(params.size)
    at = np.arange(n_docs)
    for step in range(1, ROUNDS + 1):
        weights, shift = params[:kinds.size], params[kinds.size:]
        thresholds = np.cumsum(np.concatenate([shift[:1], np.exp(shift[1:])]))
        score = np.bincount(rows, weights[column] * values, n_docs)
        tail = _sigmoid(score[:, None] - thresholds)
        tail = np.concatenate([np.ones((n_docs, 1)), tail, np.zeros((n_docs, 1))], 1)
        chance = np.maximum(tail[at, grades] - tail[at, grades + 1], 1e-9)
        slope = tail * (1 - tail)
        d_score = -(slope[at, grades] - slope[at, grades + 1]) / chance / n_docs
        d_cuts = np.zeros(n_grades + 1)
        np.add.at(d_cuts, grades, slope[at, grades] / chance / n_docs)
        np.add.at(d_cuts, grades + 1, -slope[at, grades + 1] / chance / n_docs)
        d_cuts = d_cuts[1:-1]
        later = np.cumsum(d_cuts[::-1])[::-1]
        d_shift = np.concatenate([later[:1], later[1:] * np.exp(shift[1:])])
        grad = np.concatenate([np.bincount(column, d_score[rows] * values, kinds.size) + L2 * weights, d_shift])
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        params = params - RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    weights, shift = params[:kinds.size], params[kinds.size:]
    return Model(kinds, weights, np.cumsum(np.concatenate([shift[:1], np.exp(shift[1:])])))


def score_texts(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and probability of the top grade. A text without a token gets 0 and 0."""
    rows, features, values = text_features(texts, model.features)
    n = len(texts)
    if model.features.size:
        place = np.minimum(np.searchsorted(model.features, features), model.features.size - 1)
        known = model.features[place] == features
        score = np.bincount(rows[known], model.weights[place[known]] * values[known], n)
    else:
        score = np.zeros(n)
    tail = _sigmoid(score[:, None] - model.thresholds)
    filled = np.bincount(rows, minlength=n) > 0
    return np.where(filled, tail.sum(axis=1), 0.0), np.where(filled, tail[:, -1], 0.0)


def graded(labels: DataFrame) -> DataFrame:
    """(id, grade) from the given ratings: 0 poor, 1 good but toxic, 2 good.

    A document rated more than once has its lowest grade; one without id or
    quality has none, and a missing toxic rating is not toxic.
    """
    return labels.where("doc_id is not null and quality is not null").groupBy(
        F.col("doc_id").cast("bigint").alias("id")).agg(F.min(
            F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) != 0, 1).otherwise(2)).alias("grade"))


def train(
    docs: DataFrame, grades: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text",
) -> Model:
    """Fit on at most ``sample_rows`` graded documents; their features are counted on executors."""
    bound_batches(docs.sparkSession, TEXT_BATCH_BYTES)
    sample = grades.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample), "id")  # at most sample_rows ids

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text"):
                doc, feature, value = text_features(part.column("text"))
                order = np.argsort(doc, kind="stable")
                cuts = pa.array(np.searchsorted(doc[order], np.arange(part.num_rows + 1)).astype(np.int32))
                yield pa.record_batch({
                    "id": part.column("id"), "grade": part.column("grade"),
                    "features": pa.ListArray.from_arrays(cuts, pa.array(feature[order].astype(np.int32))),
                    "vals": pa.ListArray.from_arrays(cuts, pa.array(value[order].astype(np.float32)))})

    counted = stored(rows.mapInArrow(
        giving_back(extract), "id bigint, grade int, features array<int>, vals array<float>"), "quality-sample")
    known = associated(counted)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            bounds, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            keep = np.isin(flat, known)
            cuts = pa.array(np.concatenate([[0], np.cumsum(keep)])[bounds].astype(np.int32))
            cuts = pc.subtract(cuts, cuts[0])
            inside = keep.copy()
            inside[:bounds[0]] = inside[bounds[-1]:] = False
            yield pa.record_batch({
                "id": batch.column("id"), "grade": batch.column("grade"),
                "features": pa.ListArray.from_arrays(cuts, pa.array(flat[inside])),
                "vals": pa.ListArray.from_arrays(
                    cuts, pa.array(batch.column("vals").values.to_numpy(zero_copy_only=False)[inside]))})

    got = counted.mapInArrow(select, counted.schema).toArrow().combine_chunks()
    if not got.num_rows:
        return fit_model(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0, int))
    got = got.sort_by("id").combine_chunks()
    lists = got.column("features").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return fit_model(
        np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy().astype(np.int64),
        got.column("vals").combine_chunks().flatten().to_numpy().astype(float),
        got.column("grade").to_numpy().astype(np.int64))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, expected grade, probability of the top grade.

    Null, empty and blank texts get 0 and 0. A model fitted on fewer than two
    grades gives every other text the top grade. Ids may repeat or be null.
    """
    bound_batches(docs.sparkSession, TEXT_BATCH_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))  # bounded by the sample
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for part in byte_slices(batch, "text"):
                expected, top = score_texts(own, part.column("text"))
                yield pa.record_batch({
                    "id": part.column("id"), "expected_grade": pa.array(expected), "top_probability": pa.array(top)})

    return rows.mapInArrow(giving_back(run), SCORE_SCHEMA)


def select_good(
    docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text",
) -> DataFrame:
    """``docs`` whose probability of the top grade is at least ``least``; all columns stay."""
    bound_batches(docs.sparkSession, TEXT_BATCH_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for part in byte_slices(batch, text_col):
                _, top = score_texts(own, part.column(text_col))
                yield part.filter(pa.array(top >= least))

    return docs.mapInArrow(giving_back(run), docs.schema)
