"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi rotations.

Entries become whole numbers, so sums and the scatter of the vectors about their mean are exact
whatever the order in which tasks add them up: vectors are centred on the whole number next to
the mean before they are multiplied, and what the mean differs from it by is taken off as an
exact fraction. The covariance, one matrix of the width of a vector, is factored on the driver:
Cholesky with the largest remaining variance as pivot gives a triangular factor, Jacobi
rotations make the columns of that factor orthogonal to each other. The squared norms of the
rotated columns are the eigenvalues, the normalised columns the components.

Defined results: vectors that are null, hold a null, NaN or infinite entry, or differ in length
from most vectors (of equally frequent lengths the greatest counts) are dropped; repeated rows
count row by row; directions without variance give no component, so there may be fewer than
asked for, and equal vectors give none at all; an empty table gives an empty result; null ids
are ids like others; only the id and vector columns are read, so other columns cannot clash.
Entries beyond ``LARGEST`` are refused. The driver holds a few matrices of the squared width of
a vector, which does not grow with the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.llm.common import query, table

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0 ** 21
COMPONENTS = 8
# Whole numbers up to here are exact in double precision, and sums up to here in 64 bits.
EXACT, ROOM = 2 ** 53, 2 ** 62
EPS = float(np.finfo(float).eps)
BIG = "decimal(38,0)"


def finite(vector: Column) -> Column:
    """Whether a vector is there and has nothing but finite entries."""
    return F.coalesce(F.forall(vector, lambda c: F.abs(c) < float("inf")), F.lit(False))


def whole(vectors: pd.Series) -> np.ndarray:
    """Vectors of one length as rows of whole numbers."""
    entries = np.stack(vectors.to_list()).astype(float)
    if entries.size and np.abs(entries).max() > LARGEST:
        raise ValueError(f"an entry lies beyond {LARGEST:.0f}")
    return np.floor(SCALE * entries).astype(np.int64) + SHIFT


def gram(rows: np.ndarray) -> np.ndarray:
    """Exact products of all pairs of columns, added up over the rows."""
    if rows.size and int(np.abs(rows).max()) ** 2 * len(rows) >= EXACT:
        wide = rows.astype(object)
        return wide.T @ wide
    exact = rows.astype(float)
    return (exact.T @ exact).astype(np.int64)


class Total:
    """Exact sum of arrays of whole numbers."""

    def __init__(self, shape: tuple[int, ...]):
        self.near, self.far = np.zeros(shape, np.int64), np.zeros(shape, object)
        self.bound = 0

    def add(self, part: np.ndarray) -> None:
        most = int(np.abs(part).max()) if part.size else 0
        if part.dtype == object or self.bound + most >= ROOM:
            self.far, self.bound = self.far + self.near, 0
            self.near = np.zeros_like(self.near)
        if part.dtype == object or most >= ROOM:
            self.far = self.far + part
        else:
            self.near, self.bound = self.near + part, self.bound + most

    def rows(self) -> pd.DataFrame:
        values = (self.far + self.near).ravel()
        return pd.DataFrame({"k": np.arange(len(values)), "v": [Decimal(int(v)) for v in values]})


def _added(df: DataFrame, work) -> list[int]:
    """Totals by place of what the tasks yield as rows ``(k, v)``."""
    sums = df.mapInPandas(work, f"k int, v {BIG}").groupBy("k").agg(F.sum("v").alias("v"))
    return [int(r["v"]) for r in sorted(sums.collect())]


def sums(vectors: DataFrame, width: int) -> list[int]:
    """Exact sum of every entry."""
    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Total((width,))
        for frame in frames:
            if len(frame):
                total.add(whole(frame["vector"]).sum(axis=0))
        yield total.rows()

    return _added(vectors, work)


def scatter(vectors: DataFrame, centre: np.ndarray) -> list[list[int]]:
    """Exact products of the entries about a centre of whole numbers."""
    width = len(centre)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = Total((width, width))
        for frame in frames:
            if len(frame):
                total.add(gram(whole(frame["vector"]) - centre))
        yield total.rows()

    flat = _added(vectors, work)
    return [flat[i * width:(i + 1) * width] for i in range(width)]


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """Factor f with f f' equal to the matrix, a column for each pivot.

    Rows stay in the order of the matrix; in the order of the pivots the factor is lower
    triangular. It ends where what is left is rounding error.
    """
    width = len(matrix)
    factor, left = np.zeros((width, width)), np.diag(matrix).copy()
    least = width * EPS * left.max(initial=0.0)
    for k in range(width):
        pivot = int(left.argmax())
        if left[pivot] <= least:
            return factor[:, :k]
        column = matrix[:, pivot] - factor[:, :k] @ factor[pivot, :k]
        done = left < 0
        factor[:, k] = np.where(done, 0.0, column / np.sqrt(left[pivot]))
        factor[pivot, k] = np.sqrt(left[pivot])
        left = np.where(done, left, np.maximum(left - factor[:, k] ** 2, 0.0))
        left[pivot] = -1.0
    return factor


def rounds(columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns, in rounds of pairs that do not touch each other."""
    places = list(range(columns + columns % 2))
    half, out = len(places) // 2, []
    for _ in range(len(places) - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(places[:half], places[:half - 1:-1])]
        pairs = [p for p in pairs if p[1] < columns]
        if pairs:
            out.append(tuple(np.array(pairs).T))
        places = [places[0], places[-1], *places[1:-1]]
    return out


def jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate the columns of a factor until all are orthogonal to each other.

    Of every pair the longer column comes first, which makes the rotations small.
    """
    f = factor.copy()
    pairs = rounds(f.shape[1])
    for _ in range(sweeps):
        worst = 0.0
        for p, q in pairs:
            a, b = (f[:, p] ** 2).sum(axis=0), (f[:, q] ** 2).sum(axis=0)
            swap = a < b
            f[:, p[swap]], f[:, q[swap]] = f[:, q[swap]], f[:, p[swap]]
            a, b = np.maximum(a, b), np.minimum(a, b)
            c = (f[:, p] * f[:, q]).sum(axis=0)
            size = np.sqrt(a * b)
            off = np.divide(np.abs(c), size, out=np.zeros_like(c), where=size > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > EPS
            safe = np.where(turn, c, 1.0)
            zeta = (b - a) / (2 * safe)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cos = np.where(turn, 1 / np.sqrt(1 + t * t), 1.0)
            sin = np.where(turn, cos * t, 0.0)
            left, right = f[:, p], f[:, q]
            f[:, p], f[:, q] = cos * left - sin * right, sin * left + cos * right
        if worst <= 4 * EPS:
            break
    return f


@dataclass
class Whitening:
    """Mean, components (one a column), eigenvalues by size, and trace of the covariance."""
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers next to the mean."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def moved(self, rows: np.ndarray) -> np.ndarray:
        """Rows less the mean."""
        rest = [(s - self.n * int(c)) / self.n for s, c in zip(self.sums, self.centre)]
        return (rows - self.centre) - np.array(rest)

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        return self.moved(rows) @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Squared distance of n times each row to the sums, exact."""
        far = np.abs(self.n * self.moved(rows)).max(initial=0.0) + 1
        if far * far * max(1, rows.shape[1]) < ROOM:
            apart = self.n * (rows - self.centre) - np.array(
                [s - self.n * int(c) for s, c in zip(self.sums, self.centre)], np.int64)
            return (apart * apart).sum(axis=1).tolist()
        apart = self.n * rows.astype(object) - np.array(self.sums, object)
        return [int(v) for v in (apart * apart).sum(axis=1)]


def decompose(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding error, falling, and their components as columns."""
    rotated = jacobi(pivoted_cholesky(covariance))
    values = (rotated ** 2).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values, rotated = values[order], rotated[:, order]
    components = rotated / np.sqrt(values)
    if components.size:
        leading = components[np.abs(components).argmax(axis=0), np.arange(len(values))]
        components = components * np.where(leading < 0, -1.0, 1.0)
    return values, components


def chosen(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int, int]:
    """Rows ``(id, vector)`` that count, their number and the length of their vectors."""
    vector = F.col(vector_col).cast("array<double>")
    named = rows.select(F.col(id_col).alias("id"), vector.alias("vector")).filter(
        finite(F.col("vector")))
    size = F.size("vector")
    common = (named.groupBy(size.alias("width")).agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), F.desc("width")).limit(1).first())
    width, n = (common["width"], common["n"]) if common else (0, 0)
    return named.filter(size == width), n, width


def fit(vectors: DataFrame, n: int, width: int, components: int = COMPONENTS) -> Whitening:
    """Components of ``n`` rows with a column ``vector`` of one width."""
    if not n or not width:
        return Whitening(n, [0] * width, np.zeros((width, 0)), np.zeros(0), 0.0)
    model = Whitening(n, sums(vectors, width), np.zeros((width, 0)), np.zeros(0), 0.0)
    products = scatter(vectors, model.centre)
    rest = [s - n * int(c) for s, c in zip(model.sums, model.centre)]
    # Quotients of whole numbers, each rounded once.
    covariance = np.array([[(n * products[i][j] - rest[i] * rest[j]) / (n * n)
                            for j in range(width)] for i in range(width)])
    values, vectors_ = decompose(covariance)
    model.trace = float(np.trace(covariance))
    model.eigenvalues, model.components = values[:components], vectors_[:, :components]
    return model


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, second = np.zeros(k), np.zeros((k, k))
        for frame in frames:
            if len(frame):
                white = shared.value.whiten(whole(frame["vector"]))
                first, second = first + white.sum(axis=0), second + white.T @ white
        yield pd.DataFrame({"k": np.arange(k + k * k), "v": np.append(first, second)})

    sums_ = vectors.mapInPandas(work, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    flat = np.array([r["v"] for r in sorted(sums_.collect())])
    mean, second = flat[:k] / model.n, flat[k:].reshape(k, k) / model.n
    # Whitened rows are centred already: what is left of the mean is rounding error.
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component.

    Columns: id, component from 1 on, n, deviation (squared distance of n times the row to the
    sums, a decimal), whitened, explained, identity_error.
    """
    vectors, n, width = chosen(rows, id_col, vector_col)
    model = fit(vectors, n, width, components)
    error = identity_error(vectors, model)
    explained = model.eigenvalues / model.trace if model.trace else model.eigenvalues
    # A matrix of the width of a vector by the few components.
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(f"deviation {BIG}, white array<double>")
    def project(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"deviation": [], "white": []})
        numbers = whole(column)
        return pd.DataFrame({
            "deviation": [Decimal(v) for v in shared.value.deviations(numbers)],
            "white": list(shared.value.whiten(numbers))})

    out = vectors.select("id", project("vector").alias("p")).select(
        "id", "p.deviation", F.posexplode("p.white").alias("at", "whitened"))
    share = F.array(*[F.lit(float(v)) for v in explained]).cast("array<double>")
    return out.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings")).withColumn(
        "deviation", F.col("deviation").cast("long"))
