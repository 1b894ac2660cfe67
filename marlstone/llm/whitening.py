"""Whitening of embeddings: leading eigenpairs of their covariance by Jacobi-Davidson.

The covariance is never formed. Each step asks for its product with a block of
vectors, which tasks sum over their own rows, centred first, and only sums of
that size come to the driver. A block of corrections is found by MINRES on the
projected equations, all in step so that they share their products; the search
space gives new estimates, and pairs are locked, the largest first, when their
residual is down to rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import bound_batches
from marlstone.llm.storage import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 62  # scaled entries stop here, so that they stay long
BLOCK_ROWS = 4096
SPARE = 4  # vectors sought beyond those asked for, so that the last ones have a gap behind them
INNER_STEPS, OUTER_STEPS = 6, 100
BASIS = 6  # the search space holds so many blocks before it is cut back to two
ZERO = 1e-12  # share of the largest eigenvalue up to which another counts as none

OUTPUT = ("id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")
Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    n: int  # distinct vectors
    sums: list[int]  # of their scaled entries, by dimension
    values: np.ndarray  # eigenvalues, falling
    components: np.ndarray  # unit eigenvectors as columns
    trace: float
    identity_error: float


def scaled(vector: Column) -> Column:
    """Each entry c as the long floor(64 c) + 1000000, held within 2^62."""
    def entry(c: Column) -> Column:
        bounded = F.greatest(F.least(F.floor(c * SCALE), F.lit(LARGEST)), F.lit(-LARGEST))
        return bounded.cast("bigint") + SHIFT
    return F.transform(vector.cast("array<double>"), entry)


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows whose vector is whole.

    Left out are vectors that are null, empty, or hold a null or non-finite entry,
    and those of another length than most (of equally frequent lengths the longest).
    """
    vector = F.col(vector_col).cast("array<double>")
    whole = rows.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall(
            "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))))
    most = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return whole.where(F.size("v") == (most["d"] if most else 0)).select("id", scaled(F.col("v")).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n x - S, exact; as Python integers where a long would not do."""
    most = n * (max(int(np.abs(x).max(initial=0)), 1)) + max(map(abs, sums.tolist()), default=0)
    if most < LARGEST:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(np.float64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch)
        for at in range(0, len(x), BLOCK_ROWS):
            part = x[at:at + BLOCK_ROWS]
            exact = part if int(np.abs(part).max()) < LARGEST // BLOCK_ROWS else part.astype(object)
            yield pa.record_batch({
                "n": pa.array([len(part)], pa.int64()), "block": [part.astype("<i8").tobytes()],
                "sums": pa.array([[str(s) for s in exact.sum(axis=0)]], pa.list_(pa.string()))})


def _summed(blocks: DataFrame, n: int, sums: np.ndarray, measure: Product, size: int) -> np.ndarray:
    """The sum over all blocks of ``size`` numbers that ``measure`` takes from centred rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            for block in batch.column("block").to_pylist():
                x = np.frombuffer(block, "<i8").reshape(-1, len(sums))
                total += measure(_centred(x, n, sums)).ravel()
                seen = True
        if seen:
            yield pa.record_batch({"cell": pa.array(np.arange(size), pa.int32()), "value": pa.array(total)})

    cells = blocks.select("block").mapInArrow(add, "cell int, value double").groupBy("cell").agg(
        F.sum("value").alias("value")).collect()  # ``size`` rows
    found = np.zeros(size)
    for cell, value in cells:
        found[cell] = value
    return found


def _minres(apply: Product, right: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Column by column, the solutions of apply(X) = right; every step applies once to all columns."""
    tiny = np.finfo(float).tiny

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(b > tiny, a / np.maximum(b, tiny), 0.0)

    x = np.zeros_like(right)
    older = newer = np.zeros_like(right)  # the last two directions
    before, current = np.zeros_like(right), right.copy()  # the last two Lanczos vectors, not scaled
    beta_before, beta = np.ones(right.shape[1]), np.linalg.norm(right, axis=0)
    start, left = beta.copy(), beta.copy()
    cosine, sine = -np.ones_like(beta), np.zeros_like(beta)
    carried, far = np.zeros_like(beta), np.zeros_like(beta)
    for step in range(steps):
        v = over(current, beta)
        y = apply(v)
        if step:
            y = y - over(beta, beta_before) * before
        alpha = np.sum(v * y, axis=0)
        y = y - over(alpha, beta) * current
        before, current = current, y
        beta_before, beta = beta, np.linalg.norm(y, axis=0)
        far_before = far
        delta, gamma_bar = cosine * carried + sine * alpha, sine * carried - cosine * alpha
        far, carried = sine * beta, -cosine * beta
        gamma = np.hypot(gamma_bar, beta)
        cosine, sine = over(gamma_bar, gamma), over(beta, gamma)
        direction = over(v - far_before * older - delta * newer, gamma)
        older, newer = newer, direction
        x = x + cosine * left * direction
        left = sine * left
        if np.all(left <= enough * start):
            break
    return x


def _away(vectors: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of what is left of the given ones beside the bases."""
    sizes = np.linalg.norm(vectors, axis=0)
    vectors = vectors[:, sizes > 0] / sizes[sizes > 0]
    for _ in range(2):  # the second time mends the rounding of the first
        for basis in bases:
            vectors = vectors - basis @ (basis.T @ vectors)
        norms = np.linalg.norm(vectors, axis=0)
        vectors = vectors[:, norms > 1e-10] / norms[norms > 1e-10]
        if not vectors.size:
            return vectors
        u, s, _ = np.linalg.svd(vectors, full_matrices=False)
        vectors = u[:, s > 1e-8]
    return vectors


def leading(product: Product, d: int, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric operator, falling, and their vectors.

    Raises if a residual stays above rounding.
    """
    wanted = min(wanted, d)
    width = min(d, wanted + SPARE)
    basis = _away(np.random.default_rng(seed).standard_normal((d, width)))
    image = product(basis)
    locked, values = np.zeros((d, 0)), []
    for _ in range(OUTER_STEPS):
        inner = basis.T @ image
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        scale = max([*values, abs(theta[0]), np.finfo(float).tiny])
        done = np.linalg.norm(residual, axis=0) <= max(450, 4 * d) * np.finfo(float).eps * scale
        ready = int(np.argmin(done)) if not done.all() else done.size
        ready = min(ready, wanted - len(values))
        values.extend(theta[:ready])
        locked = np.hstack([locked, basis[:, :ready]])
        basis, image, theta, residual = basis[:, ready:], image[:, ready:], theta[ready:], residual[:, ready:]
        if len(values) == wanted:
            order = np.argsort(values)[::-1]
            return np.array(values)[order], locked[:, order]
        if basis.shape[1] > BASIS * width:
            basis, image = basis[:, :2 * width], image[:, :2 * width]
        sought = min(width - len(values), theta.size)
        u, shift = basis[:, :sought], theta[:sought]

        def aside(t: np.ndarray, u: np.ndarray = u, locked: np.ndarray = locked) -> np.ndarray:
            t = t - locked @ (locked.T @ t)
            return t - u * np.sum(u * t, axis=0)

        def corrected(t: np.ndarray, shift: np.ndarray = shift, aside: Product = aside) -> np.ndarray:
            t = aside(t)
            return aside(product(t) - t * shift)

        steps = _minres(corrected, -aside(residual[:, :sought]), INNER_STEPS, 0.05)
        # a space that is whole gains nothing more: its own residuals are mended by another product
        new = _away(steps, locked, basis)
        basis = np.hstack([basis, new])
        image = np.hstack([image, product(new)]) if new.size else product(basis)
    raise RuntimeError("the eigenvectors did not converge to double precision")


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors in column x; None for an empty table.

    There are fewer components than asked for where the vectors span fewer
    dimensions, none for a single vector.
    """
    bound_batches(x.sparkSession)
    blocks = stored(x.select("x").distinct().mapInArrow(_blocks, "n bigint, block binary, sums array<string>"),
                    "whitening-blocks")
    n = blocks.agg(F.sum("n")).first()[0]
    if not n:
        return None
    totals = blocks.select(F.posexplode("sums").alias("dim", "s")).groupBy("dim").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("dim").collect()  # one row a dimension
    sums = np.array([int(r["s"]) for r in totals], dtype=object)
    d = len(sums)

    def covariance(vectors: np.ndarray) -> np.ndarray:
        return _summed(blocks, n, sums, lambda y: y.T @ (y @ vectors), vectors.size).reshape(d, -1) / n

    trace = float(_summed(blocks, n, sums, lambda y: np.sum(y * y, axis=0), d).sum()) / n
    none = Whitening(n, sums.tolist(), np.zeros(0), np.zeros((d, 0)), trace, 0.0)
    if n == 1 or trace == 0:
        return none
    values, vectors = leading(covariance, d, min(components, d, n - 1))
    kept = values > ZERO * values[0]
    values, vectors = values[kept], vectors[:, kept]
    # of either sign, that with its largest entry above zero
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(values.size)])
    project = vectors / np.sqrt(values)
    k = values.size
    mean = _summed(blocks, n, sums, lambda y: (y @ project).sum(axis=0), k) / n

    def spread(y: np.ndarray) -> np.ndarray:
        w = y @ project - mean
        return w.T @ w

    own = _summed(blocks, n, sums, spread, k * k).reshape(k, k) / n
    return Whitening(n, sums.tolist(), values, vectors, trace, float(np.abs(own - np.eye(k)).max()))


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """Rows (id, x) as one row a component; deviation is null where no long holds it."""
    n, sums = model.n, np.array(model.sums, dtype=object)
    project, k = model.components / np.sqrt(model.values), model.values.size
    explained = model.values / model.trace if k else model.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not k:
                continue
            far = _differences(_matrix(batch), n, sums)
            small = far.dtype != object and float(np.abs(far).max()) ** 2 * far.shape[1] < LARGEST
            squares = (far * far if small else far.astype(object) ** 2).sum(axis=1).tolist()
            whitened = (far / n).astype(np.float64) @ project
            yield pa.record_batch({
                "id": batch.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                "n": pa.array(np.full(m * k, n), pa.int64()),
                "deviation": pa.array([s if s < 1 << 63 else None for s in squares], pa.int64()).take(
                    pa.array(np.repeat(np.arange(m), k))),
                "whitened": pa.array(whitened.ravel()), "explained": pa.array(np.tile(explained, m)),
                "identity_error": pa.array(np.full(m * k, model.identity_error))})

    bound_batches(rows.sparkSession)
    return rows.mapInArrow(run, OUTPUT)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that usable() leaves out give no rows, nor does a table without two
    different vectors. Ids may repeat or be null; equal vectors count once in
    the fit and each get their rows; other columns are not read.
    """
    kept = usable(rows, id_col, vector_col)
    model = fit(kept)
    return rows.sparkSession.createDataFrame([], OUTPUT) if model is None else transform(kept, model)
