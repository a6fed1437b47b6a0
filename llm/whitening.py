"""Whitening of vectors by shifted CholeskyQR.

Rows are centred exactly in whole numbers.  Each pass over them gives the Gram matrix of the rows
orthogonalised so far; its Cholesky factor orthogonalises them further, by a triangular solve
per row.  The first pass shifts the Gram matrix, so that it can be factored whatever its
condition.  The product of all factors, R, has the singular values and right vectors of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.scratch import Scratch
from llm.vectors import commonest_length, matrix, whole_numbers

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Gram passes at most; three are enough for rows of full rank.
PASSES = 5
_EPS = np.finfo(float).eps
# Largest entry of the Gram matrix minus the identity at which rows count as orthonormal.
_ORTHONORMAL = 1e-13
# Rows of a batch that are taken at once.
_SLICE = 8_192


@dataclass(frozen=True)
class Whitening:
    """Mean and components of `n` rows: axes[:, k] has variance variances[k], the largest first.

    Directions without variance (to double precision) are no components.
    """

    n: int
    sums: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total_variance: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n times what rows differ from the mean, exactly; Python integers if need be."""
        if len(x) and self.n * int(np.abs(x).max()) >= 1 << 61:
            x = x.astype(object)
        return x * self.n - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n

    def squared_deviations(self, x: np.ndarray) -> np.ndarray:
        """Exact sums over the squared deviations of each row."""
        z = self.deviations(x)
        if len(z) and int(np.abs(z).max()) ** 2 * z.shape[1] >= 1 << 62:
            z = z.astype(object)
        return (z * z).sum(axis=1)

    def whitened(self, x: np.ndarray, components: int) -> np.ndarray:
        return self.centred(x) @ self.axes[:, :components] / np.sqrt(self.variances[:components])


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Q with Q @ upper = rows, column by column from the left."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def factored(gram: np.ndarray, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor of `gram`, plus a shift if asked for or needed.

    The shift is a small multiple of the rounding error of the largest eigenvalue.
    """
    d = len(gram)
    shift = 11 * d * (d + 1) * _EPS * max(np.trace(gram), np.finfo(float).tiny)
    added = shift if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + added * np.eye(d)).T
        except np.linalg.LinAlgError:
            added = max(10 * added, shift)


def _slices(batches: Iterator[pa.RecordBatch], dims: int, at: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for i in range(0, batch.num_rows, _SLICE):
            yield matrix(batch.column(at).slice(i, _SLICE), dims)


def _sums(rows: DataFrame, dims: int) -> np.ndarray:
    """Exact sums per dimension, as Python integers."""

    def run(batches):
        total = np.zeros(dims, object)
        for x in _slices(batches, dims, 0):
            fits = not len(x) or int(np.abs(x).max()) * len(x) < 1 << 62
            total += (x if fits else x.astype(object)).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([str(t) for t in total])], names=["j", "s"]
        )

    parts = rows.select("x").mapInArrow(run, "j int, s string")
    sums = parts.groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found = {r["j"]: int(r["s"]) for r in sums.collect()}
    return np.array([found[j] for j in range(dims)], object)


def _gram(rows: DataFrame, dims: int, size: int, mapped) -> tuple[np.ndarray, np.ndarray]:
    """(sums of products, sums) of the rows that `mapped` makes of rows of `x`.

    Each task adds up its rows; what comes to the driver is one number per pair of dimensions.
    """

    def run(batches):
        total, sums = np.zeros((size, size)), np.zeros(size)
        for x in _slices(batches, dims, 0):
            made = mapped(x)
            total += made.T @ made
            sums += made.sum(axis=0)
        both = np.vstack([total, sums])
        offsets = pa.array(range(0, both.size + 1, size), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(size + 1), pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array(both.ravel())),
            ],
            names=["i", "row"],
        )

    parts = rows.select("x").mapInArrow(run, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v"))
    out = np.zeros((size + 1, size))
    for cell in cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[cell["i"], cell["j"]] = cell["v"]
    return out[:-1], out[-1]


def fit(rows: DataFrame, dims: int, n: int) -> Whitening:
    """The whitening of `rows` (x: `dims` whole numbers each, `n` rows)."""
    context = rows.sparkSession.sparkContext
    sums = _sums(rows, dims)
    nothing = Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0)
    factors: list[np.ndarray] = []
    for _ in range(PASSES):
        held = context.broadcast((nothing, tuple(factors)))

        def orthogonalised(x, held=held):
            centre, solved_by = held.value
            q = centre.centred(x)
            for upper in solved_by:
                q = solved(q, upper)
            return q

        gram = _gram(rows, dims, dims, orthogonalised)[0] / n
        gram = (gram + gram.T) / 2
        if factors and np.abs(gram - np.eye(dims)).max() <= _ORTHONORMAL:
            break
        if len(factors) == PASSES - 1 or not gram.any():
            break
        factors.append(factored(gram, shifted=not factors))
    # What is left of the last Gram matrix is split symmetrically: it may be singular.
    left, vectors = np.linalg.eigh(gram)
    r = np.sqrt(np.maximum(left, 0))[:, None] * vectors.T
    for upper in reversed(factors):
        r = r @ upper
    _, singular, right = np.linalg.svd(r)
    rank = int((singular > 4 * dims * _EPS * singular[0]).sum()) if singular[0] > 0 else 0
    axes = right[:rank].T
    # Either direction of a component will do; the largest entry is made positive.
    top = np.abs(axes).argmax(axis=0)
    axes = axes * np.where(axes[top, np.arange(rank)] < 0, -1.0, 1.0)
    variances = singular**2
    return Whitening(n, sums, axes, variances[:rank], float(variances.sum()))


def identity_error(rows: DataFrame, model: Whitening, components: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, from a pass over them."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    dims = len(model.sums)
    products, sums = _gram(rows, dims, components, lambda x: held.value.whitened(x, components))
    mean = sums / model.n
    return float(np.abs(products / model.n - np.outer(mean, mean) - np.eye(components)).max())


SCHEMA = (
    "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double,"
    " identity_error double"
)


def whitened(
    vectors: DataFrame,
    components: int = COMPONENTS,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector and component (from 1, by falling variance), at most `components`.

    Vectors are taken as whole numbers x = floor(64 * entry) + 1000000.  n: their number;
    deviation: sum over dimensions of (n * x - sum)^2, exact (an error beyond 64 bits); whitened:
    the centred vector on the component over its standard deviation; explained: the component's share of all
    variance; identity_error: how far the covariance of all whitened rows is from the identity.

    Null vectors, those with null, NaN or infinite entries, empty ones, and those whose length is
    not the commonest one (of equals the longer) are left out of everything.  Components end
    at the rank of the data: fewer vectors than dimensions, constant or dependent dimensions give fewer
    components, and vectors that are all equal, or none, give no rows.  Equal variances leave
    the choice of axes open.  Ids may repeat or be null; each row is a vector.  Further columns,
    whatever their names, are not read.

    Memory: a task holds slices of rows and square matrices of the dimension; so does the driver.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    named = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(vector_column).alias("embedding")
    )
    rows = scratch.write(whole_numbers(named, "embedding", SCALE, OFFSET, ["vec_id"]))
    schema = SCHEMA.format(named.schema["vec_id"].dataType.simpleString())
    dims, n = commonest_length(rows)
    rows = rows.filter(F.size("x") == dims)
    if not n:
        return spark.createDataFrame([], schema)
    model = fit(rows, dims, n)
    k = min(components, len(model.variances))
    if not k:
        return spark.createDataFrame([], schema)
    error = identity_error(rows, model, k)
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _SLICE):
                part = batch.slice(i, _SLICE)
                x = matrix(part.column("x"), dims)
                made = held.value.whitened(x, k)
                offsets = pa.array(range(0, made.size + 1, k), pa.int32())
                deviation = pa.array(held.value.squared_deviations(x).tolist(), pa.int64())
                lists = pa.ListArray.from_arrays(offsets, pa.array(made.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), deviation, lists],
                    names=["vec_id", "deviation", "whitened"],
                )

    kind = schema.split(",")[0]
    wide = rows.mapInArrow(run, f"{kind}, deviation bigint, whitened array<double>")
    share = F.array(*[F.lit(float(v / model.total_variance)) for v in model.variances[:k]])
    return wide.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
