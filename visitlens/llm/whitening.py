"""Embedding whitening, with the principal components from FEAST contour integration.

1. Entries become whole numbers; their sums are exact. Each task adds up the products of its centred rows, and the
   tasks' covariance rows are summed in Spark. Only the d x d covariance reaches the driver (d is the vectors' length).
2. Inertia counts: the signs of the pivots of a symmetric factorisation of ``V - s I`` (Sylvester) say how many eigenvalues lie
   above ``s``. They divide the spectrum, from the top, into intervals of few eigenvalues each (:func:`spectrum_intervals`).
3. FEAST for each interval: the projector onto its eigenvectors is the contour integral of ``(z I - V)^-1`` around it, approximated
   by a quadrature of a few complex shifted solves applied to random vectors. A Rayleigh-Ritz step on the filtered subspace
   gives eigenpairs; both are repeated until the residuals are those of double precision (:func:`contour_components`).
4. The number found in an interval must equal its inertia count, so no component is missed.
5. Rows are projected in parallel, and the whitened covariance is measured over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Points of the quadrature on the half circle, rounds of filtering, and eigenvalues of one interval.
POINTS, ROUNDS, INTERVAL = 8, 40, 12
#: Shares of the matrix norm: eigenvalues below the first are zero in double precision (whitened, their rounding errors would exceed 1e-4);
#: no eigenvalue is nearer than the second to a border between intervals.
ZERO, BORDER = 1e-11, 1e-12
SALT = 64


# --- the eigenvalue problem on the driver: one d x d matrix -----------------------------------------------

def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``v`` exceed ``shift``: positive pivots of ``v - shift I`` with 1x1 and 2x2
    pivots of the largest entries. A 2x2 pivot has one eigenvalue of each sign."""
    a = v - shift * np.eye(len(v))
    above = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        r = int(diagonal.argmax())
        p, q = divmod(int(size.argmax()), len(a))
        if diagonal[r] >= 0.64 * size[p, q]:  # (1 + sqrt 17) / 8, the bound that keeps the factors small
            if a[r, r] == 0:
                break  # what is left is zero: eigenvalues equal to the shift
            above += a[r, r] > 0
            keep = np.arange(len(a)) != r
            column = a[keep, r]
            a = a[np.ix_(keep, keep)] - np.outer(column, column) / a[r, r]
        else:
            above += 1
            keep = np.ones(len(a), bool)
            keep[[p, q]] = False
            left = a[np.ix_(keep, [p, q])]
            a = a[np.ix_(keep, keep)] - left @ np.linalg.solve(a[np.ix_([p, q], [p, q])], left.T)
    return int(above)


def spectrum_intervals(v: np.ndarray, wanted: int, most: int = INTERVAL) -> list[tuple[float, float, int]]:
    """Intervals ``(low, high, eigenvalues)`` from the top down that hold the ``wanted`` largest eigenvalues above rounding, each with
    ``most`` eigenvalues at most unless no border can be drawn between them. The last interval may hold more than are wanted."""
    bound = float(np.abs(v).sum(axis=1).max())  # no eigenvalue lies outside +-bound
    if not bound:
        return []
    low, high = ZERO * bound, bound * (1 + 1e-9)
    todo = [(low, high, eigenvalues_above(v, low))]
    found, n = [], 0
    while todo and n < wanted:
        low, high, count = todo.pop()
        if not count:
            continue
        border = None
        if count > most:
            for share in (0.5, 0.4, 0.6, 0.3, 0.7, 0.2, 0.8, 0.1, 0.9):
                at = low + share * (high - low)
                above = eigenvalues_above(v, at + BORDER * bound)
                if above == eigenvalues_above(v, at - BORDER * bound):
                    border, upper = at, above - eigenvalues_above(v, high)
                    break
        if border is None or high - low < 100 * BORDER * bound:
            found.append((low, high, count))
            n += count
        else:
            todo += [(low, border, count - upper), (border, high, upper)]
    return found


def contour_components(v: np.ndarray, low: float, high: float, count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` in ``(low, high]``, falling, and their unit eigenvectors as columns."""
    d, scale = len(v), float(np.abs(v).sum(axis=1).max())
    edge = BORDER * scale
    pad = max((high - low) * 0.05, edge)  # an eigenvalue on the border stays well inside the contour
    centre, radius = (low + high) / 2, (high - low) / 2 + pad
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(-0.5j * np.pi * (nodes - 1))
    shifted = [(centre + radius * t) * np.eye(d) - v for t in turn]
    block = rng.standard_normal((d, min(d, max(2 * count, count + 8))))
    before = np.inf
    for _ in range(ROUNDS):
        filtered = sum(w / 2 * (radius * t * np.linalg.solve(m, block)).real for w, t, m in zip(weights, turn, shifted, strict=True))
        basis, _ = np.linalg.qr(filtered)
        values, mixes = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz in the subspace
        block = basis @ mixes
        # Of the values inside, those of true pairs have the least residuals: the filter leaves noise in the block's other directions,
        # whose Ritz values may fall anywhere. A border may be missed by a rounding.
        residuals = np.abs(v @ block - block * values).max(axis=0)
        near = np.flatnonzero((values > low - edge) & (values <= high + edge))
        near = near[np.argsort(residuals[near], kind="stable")]
        if len(near) >= count:
            residual = residuals[near[:count]].max()
            if residual <= 1e-14 * scale or (residual <= 1e-11 * scale and residual > before / 2):  # no better in double precision
                others = near[count:]
                if ((residuals[others] <= 1e-8 * scale) & (values[others] > low + edge) & (values[others] < high - edge)).any():
                    raise ArithmeticError(f"{count} eigenvalues counted in ({low}, {high}], but the contour finds {np.sort(values[near])}")
                inside = np.sort(near[:count])[::-1]
                return values[inside], block[:, inside]
            before = residual
    raise ArithmeticError(f"the contour integral around ({low}, {high}] does not converge")


def principal_components(v: np.ndarray, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding and their eigenvectors (columns), numbered by falling eigenvalue."""
    rng, parts = np.random.default_rng(seed), []
    for low, high, count in spectrum_intervals(v, wanted):
        parts.append(contour_components(v, low, high, count, rng))
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    values, vectors = (np.concatenate(x, axis=-1) for x in zip(*parts, strict=True))
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


# --- the passes over the rows ---------------------------------------------------------------------------------

def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, vec array<double>)`` without null vectors and vectors with null, NaN or infinite entries."""
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return df.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).where(F.col("vec").isNotNull() & ~bad)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A batch's vectors as whole numbers, one row each."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE).reshape(-1, dim)
    if values.size and np.abs(values).max() >= 2.0 ** 53:
        raise ArithmeticError("entries beyond 2**47 have no exact whole number")
    return values.astype(np.int64) + SHIFT


def _sum_rows(parts: DataFrame, kind: str) -> list[np.ndarray]:
    """Sums of the tasks' rows ``(i, part, row binary)`` by ``i``, in two steps, so that no task adds more than its share."""

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("row"):
                row = np.frombuffer(raw.as_buffer(), kind)
                total = row.copy() if total is None else total + row
        yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "row"])

    some = parts.groupBy("i", "part").applyInArrow(add, "i int, row binary")
    rows = some.groupBy("i").applyInArrow(add, "i int, row binary").collect()  # a row for each dimension
    return [np.frombuffer(r.row, kind) for r in sorted(rows)]


def _partial(vectors: DataFrame, dim: int, kind: str, size: int, products) -> list[np.ndarray]:
    """``size`` rows of numbers added up over all batches; ``products(batch matrix)`` gives a batch's."""

    def compute(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                found = products(matrix(batch.column(0), dim))
                total = found if total is None else total + found
        if total is not None:
            yield pa.record_batch([pa.array(range(size), pa.int32()), pa.array([row.tobytes() for row in total], pa.binary())], names=["i", "row"])

    rows = vectors.select("vec").mapInArrow(tidy(compute), "i int, row binary")
    return _sum_rows(rows.withColumn("part", F.spark_partition_id() % SALT), kind)


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: row count, exact sums, eigenvalues, eigenvectors as columns, the covariance's trace and
    the measured distance of the whitened covariance from the identity."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n``; whole parts are subtracted as whole numbers."""
        base = self.sums // self.n
        return (x - base) - (self.sums - self.n * base) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """``sum((n x - S)**2)`` exactly; None where it does not fit a long."""
        base = self.sums // self.n
        rest = self.sums - self.n * base
        if x.size and (float(np.abs(x - base).max()) + 1) * self.n < 2.0 ** 31 / max(1, x.shape[1]) ** 0.5:
            return ((self.n * (x - base) - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(a) - int(b)) ** 2 for a, b in zip(row, rest, strict=True)) for row in (x - base).tolist()]
        return [value if value < 1 << 63 else None for value in exact]


def fit(vectors: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors (vec_id, vec)`` of length ``dim``; None without rows."""
    sums = _partial(vectors, dim, "<i8", 1, lambda x: np.concatenate([x.sum(axis=0), [len(x)]])[None])
    if not sums:
        return None
    n, sums = int(sums[0][-1]), sums[0][:-1]
    plain = Whitening(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        centred = plain.centred(x)
        return centred.T @ centred

    v = np.array(_partial(vectors, dim, "<f8", dim, products)) / n
    v = (v + v.T) / 2
    values, found = principal_components(v, components)
    made = Whitening(n, sums, values, found, float(np.trace(v)))
    if not len(values):
        return made

    def white(x: np.ndarray) -> np.ndarray:
        rows = made.whiten(x)
        return rows.T @ rows

    measured = np.array(_partial(vectors, dim, "<f8", len(values), white)) / n
    return Whitening(n, sums, values, found, made.trace, float(np.abs(measured - np.eye(len(values))).max()))


def whiten_embeddings(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row for each valid vector and component.

    Vectors that are null or hold null or non-finite entries are dropped, and so are those whose length is not the most frequent
    one (of equally frequent, the longest) or is 0. Components with an eigenvalue of zero up to rounding have no whitened
    value and are left out: fewer than ``components`` where the covariance has a lower rank, none for a single or only equal vectors.
    ``deviation`` is null where it does not fit a long. Repeated rows and null ids are kept as they are. An empty table
    gives an empty result; other columns are ignored.
    """
    schema = "vec_id {}, deviation long, whitened array<double>"
    valid = valid_vectors(df, id_col, vec_col)
    kind = valid.schema["vec_id"].dataType.simpleString()
    length = valid.where(F.size("vec") > 0).groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = length["dim"] if length else 0
    vectors = valid.where(F.size("vec") == dim) if dim else valid.where(F.lit(False))
    model = fit(vectors, dim, components) if dim else None
    explained = (model.values / model.trace).tolist() if model is not None and len(model.values) else []

    def compute(batches):
        for batch in batches:
            x = matrix(batch.column(1), dim)
            yield pa.record_batch([batch.column(0), pa.array(model.deviations(x), pa.int64()), pa.array(list(model.whiten(x)), pa.list_(pa.float64()))],
                                  names=["vec_id", "deviation", "whitened"])

    rows = vectors.mapInArrow(tidy(compute), schema.format(kind)) if explained else vectors.selectExpr(
        "vec_id", "cast(null as long) deviation", "cast(array() as array<double>) whitened").where(F.lit(False))
    shares = F.array(*map(F.lit, explained)) if explained else F.lit(None).cast("array<double>")
    return (rows.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
            .select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("k")).alias("explained"),
                    F.lit(model.identity_error if model else float("nan")).alias("identity_error")))
