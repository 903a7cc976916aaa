"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The rows of vectors, centred, are a tall matrix X that stays spread over tasks. The bidiagonalisation alternates the
products X v and X^T u. Every left vector is X p for a short vector p, so it is never written: one pass over the rows forms
X p and, while a row is at hand, adds it to X^T (X p). Inner products of left vectors are inner products with these sums,
too, so both sides are reorthogonalised in full without another pass. The singular value decomposition of the small
bidiagonal matrix gives components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.llm.common import map_arrow
from regiobank.sources.scratch import stage

COMPONENTS = 32
SEED = 7

#: A component of a vector becomes floor(SCALE * it) + SHIFT; larger ones than LARGEST would not be exact. Fixed values.
SCALE = 64
SHIFT = 1_000_000
LARGEST = 2.0**46

EPS = float(np.finfo(np.float64).eps)
HALF = 26  # bits of a number's lower half, for sums that cannot overflow


class Rows(NamedTuple):
    """The vectors that take part: vec_id and y, their whole numbers without SHIFT, and what all of them have in common."""

    table: DataFrame
    n: int
    sums: list[int]  # of y, per dimension

    @property
    def mean(self) -> np.ndarray:
        return np.array([total / self.n for total in self.sums])


class Components(NamedTuple):
    vectors: np.ndarray  # one per column, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("y")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(table: DataFrame, work: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> list:
    """Sum over all rows of what `work` makes of a batch of them: an array of fixed length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = work(_matrix(batch))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "value"])

    parts = map_arrow(table.select("y"), add, f"i int, value {kind}")
    # a row per entry of that array
    rows = parts.groupBy("i").agg(F.sum(F.col("value").cast("decimal(38,0)") if kind == "bigint" else F.col("value")).alias("value")).collect()
    return [row["value"] for row in sorted(rows, key=lambda row: row["i"])]


def usable_rows(vectors: DataFrame) -> Rows:
    """Rows whose vector has only finite numbers (see `whiten`), written once."""
    whole = F.col("embedding").cast("array<double>")
    fine = F.forall(whole, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(fine, F.lit(False)))
    y = F.transform(whole, lambda c: F.floor(c * SCALE))
    table = stage(kept.select(F.col("vec_id").cast("long").alias("vec_id"), y.alias("y")), "vectors")
    # the lengths that occur, by falling number of rows: one row unless vectors of several models are mixed
    lengths = table.groupBy(F.size("y").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("length")).limit(2).collect()
    if not lengths:
        return Rows(table, 0, [])
    if len(lengths) > 1:
        table = stage(table.where(F.size("y") == lengths[0]["length"]), "vectors")
    halves = _summed(table, lambda y: np.concatenate([(y >> HALF).sum(0), (y & ((1 << HALF) - 1)).sum(0)]), "bigint")
    size = lengths[0]["length"]
    return Rows(table, lengths[0]["n"], [(int(high) << HALF) + int(low) for high, low in zip(halves[:size], halves[size:])])


def _orthogonal(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """A vector less its parts along an orthonormal basis; twice, as once leaves rounding errors."""
    for _ in range(2):
        if basis:
            matrix = np.array(basis)
            vector = vector - matrix.T @ (matrix @ vector)
    return vector


def bidiagonalise(
    product: Callable[[np.ndarray], np.ndarray], size: int, enough: Callable[[np.ndarray, np.ndarray, float], bool], seed: int = SEED
) -> tuple[np.ndarray, np.ndarray]:
    """V (size x k, orthonormal columns) and the bidiagonal B with X V = U B. `product(p)` is X^T (X p).

    It goes on for `size` steps, which span everything whatever eigenvalues coincide, unless `enough(V, B, next)` says
    that no more are wanted.
    """
    random = np.random.default_rng(seed)

    def start() -> np.ndarray:
        while True:
            vector = _orthogonal(random.standard_normal(size), right)
            if np.linalg.norm(vector) > 1e-6:
                vector = _orthogonal(vector / np.linalg.norm(vector), right)
                return vector / np.linalg.norm(vector)

    right: list[np.ndarray] = []  # v_j
    left: list[np.ndarray] = []  # p_j, where u_j = X p_j
    back: list[np.ndarray] = []  # X^T u_j
    alphas, betas, largest = [], [], 0.0
    v, beta = start(), 0.0
    while True:
        right.append(v)
        p = v - beta * left[-1] if beta else v
        g = product(p)
        for _ in range(2):
            if left:
                along = np.array(left) @ g
                p, g = p - np.array(left).T @ along, g - np.array(back).T @ along
        alpha = float(np.sqrt(max(p @ g, 0.0)))
        largest = max(largest, alpha, beta)
        if alpha <= size * EPS * largest:
            # X v lies among the left vectors so far
            alpha, p, g = 0.0, np.zeros(size), np.zeros(size)
        else:
            p, g = p / alpha, g / alpha
        left.append(p)
        back.append(g)
        alphas.append(alpha)
        if len(right) == size:
            break
        rest = _orthogonal(g - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        matrix = np.diag(alphas) + np.diag(betas, 1) if betas else np.diag(alphas)
        if enough(np.array(right).T, matrix, beta):
            break
        if beta <= size * EPS * largest:
            beta, v = 0.0, start()
        else:
            v = _orthogonal(rest / beta, right)
            v = v / np.linalg.norm(v)
        betas.append(beta)
    return np.array(right).T, np.diag(alphas) + (np.diag(betas[: len(alphas) - 1], 1) if len(alphas) > 1 else 0.0)


def find_components(rows: Rows, most: int = COMPONENTS) -> Components:
    """Unit eigenvectors of the covariance (divisor n) with eigenvalues over 0, the `most` largest."""
    mean, size = rows.mean, len(rows.sums)

    def product(p: np.ndarray) -> np.ndarray:
        def work(y: np.ndarray) -> np.ndarray:
            centred = y - mean
            return (centred @ p) @ centred

        return np.array(_summed(rows.table, work))

    trace = float(sum(_summed(rows.table, lambda y: ((y - mean) ** 2).sum(0))))

    def enough(v: np.ndarray, matrix: np.ndarray, beta: float) -> bool:
        # all wanted ones have converged, and what is left in the trace cannot hold another as large
        left, sigma, _ = np.linalg.svd(matrix)
        if len(sigma) < most or sigma[most - 1] == 0:
            return False
        errors = beta * np.abs(left[-1, :most])
        return bool(np.all(errors <= EPS * sigma[0]) and trace - float(np.sum(sigma[:most] ** 2)) < sigma[most - 1] ** 2 * (1 - 1e-6))

    if not trace:
        return Components(np.zeros((size, 0)), np.zeros(0), np.zeros(0))
    v, matrix = bidiagonalise(product, size, enough)
    _, sigma, right = np.linalg.svd(matrix)
    kept = sigma[:most] > max(rows.n, size) * EPS * sigma[0]
    vectors = (v @ right.T)[:, :most][:, kept]
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    power = sigma[:most][kept] ** 2
    return Components(vectors, power / rows.n, power / trace)


def identity_error(rows: Rows, found: Components) -> float:
    """The largest absolute entry of the covariance of all whitened rows less the identity."""
    mean, to = rows.mean, found.vectors / np.sqrt(found.eigenvalues)
    size = to.shape[1]

    def work(y: np.ndarray) -> np.ndarray:
        white = (y - mean) @ to
        return np.concatenate([(white.T @ white).ravel(), white.sum(0)])

    sums = np.array(_summed(rows.table, work)) / rows.n
    covariance = sums[: size * size].reshape(size, size) - np.outer(sums[size * size :], sums[size * size :])
    return float(np.abs(covariance - np.eye(size)).max())


def _deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n y - S)^2 over the dimensions, per row; null if it does not fit into 64 bits."""
    most = n * max(abs(int(y.min())), abs(int(y.max()))) + max(abs(total) for total in sums)
    if most < 1 << 62 and most * most * len(sums) < 1 << 63:
        return ((y * n - np.array(sums, dtype=np.int64)) ** 2).sum(1).tolist()
    exact = ((y.astype(object) * n - np.array(sums, dtype=object)) ** 2).sum(1)
    return [value if value < 1 << 63 else None for value in exact.tolist()]


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """A row per usable row of `vectors` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened,
    explained, identity_error.

    Entries c become x = floor(64 c) + 1000000. Rows take part whose vector is not null or empty and has only finite
    entries below 2^46 in size, so that x is exact; if vectors differ in length, those of the commonest length do (the
    longest of equally common ones). All of them are the fit list: n rows with sums S. component counts the unit
    eigenvectors of the covariance (divisor n) from 1 by falling eigenvalue e, up to `most`; whitened is the centred x
    along it over sqrt(e), explained e over the covariance's trace. deviation is the sum of (n x - S)^2 over the
    dimensions, null if it does not fit into 64 bits; identity_error the largest entry, by size, of the covariance of
    whitened less the identity.

    Directions without variance, up to rounding, are no components: there are fewer than `most` if the vectors span
    fewer, and the result is empty if all of them are equal or the table is empty. Equal eigenvalues give orthogonal
    components in no particular order. Rows that repeat count each time, a null vec_id stays null, and other columns are
    ignored.
    """
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    rows = usable_rows(vectors)
    found = find_components(rows, most) if rows.n else None
    if found is None or not len(found.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, found)
    n, sums, mean, explained = rows.n, rows.sums, rows.mean, found.explained
    to = found.vectors / np.sqrt(found.eigenvalues)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = to.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch)
            at = np.repeat(np.arange(batch.num_rows), size)
            columns = [
                batch.column("vec_id").take(pa.array(at)),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(at), n, dtype=np.int64)),
                pa.array(_deviations(y, n, sums), pa.int64()).take(pa.array(at)),
                pa.array(((y - mean) @ to).ravel()),
                pa.array(np.tile(explained, batch.num_rows)),
                pa.array(np.full(len(at), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(rows.table.select("vec_id", "y"), project, schema)
