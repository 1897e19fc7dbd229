"""Whitening of vectors by refined eigenvectors of their distributed covariance.

Tasks sum vectors and centred cross products; only dimensions, not rows, decide
what comes to the driver. Eigenvectors are found in float32 and corrected by
Ogita and Aishima's iteration, which is matrix products only, in extended
precision (numpy's long double). Eigenvalues too close for it are solved again
inside their cluster, in the cluster's own small matrix, and the iteration goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

WIDE = np.longdouble
#: Numbers of vectors that are multiplied at once.
PIECE = 1 << 20


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    fine = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def _matrices(column: pa.Array, dims: int) -> Iterator[np.ndarray]:
    """The vectors in pieces, as rows."""
    step = max(1, PIECE // max(dims, 1))
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        yield np.asarray(pc.list_flatten(part)).reshape(len(part), dims)


def column_sums(vectors: DataFrame, col: str, dims: int) -> tuple[int, list]:
    """The number of rows and the sum of each dimension: exact for integers, else in double."""
    whole = isinstance(vectors.schema[col].dataType.elementType, T.IntegralType)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (dims + 1)
        for batch in batches:
            total[dims] += batch.num_rows
            for m in _matrices(batch.column(0), dims):
                if whole and len(m) and max(abs(int(m.max())), abs(int(m.min()))) >= (1 << 62) // len(m):
                    part = m.astype(object).sum(axis=0)
                else:
                    part = m.astype(np.int64 if whole else np.float64).sum(axis=0)
                total[:dims] = [a + b for a, b in zip(total, part.tolist())]
        kind = pa.decimal128(38, 0) if whole else pa.float64()
        total = [Decimal(t) if whole else float(t) for t in total]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), pa.array(total, kind)], ["i", "s"])

    kind = "decimal(38,0)" if whole else "double"
    rows = vectors.select(col).mapInArrow(add, f"i int, s {kind}").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = [0] * (dims + 1)
    for r in rows:
        out[r["i"]] = int(r["s"]) if whole else r["s"]
    return int(out[dims]), out[:dims]


def cross_products(vectors: DataFrame, col: str, dims: int, centre: np.ndarray, project: np.ndarray | None = None):
    """Sums and products of the vectors less ``centre``, times ``project`` if given, over all rows.

    A task adds up its rows and gives one row per number, which Spark adds up
    over the tasks.
    """
    width = dims if project is None else project.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            for m in _matrices(batch.column(0), dims):
                y = m.astype(np.float64) - centre
                if project is not None:
                    y = y @ project
                total[:width] += y.T @ y
                total[width] += y.sum(axis=0)
        at = np.arange(total.size)
        for a in range(0, total.size, 1 << 16):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[a : a + (1 << 16)]), pa.array(total.ravel()[a : a + (1 << 16)])], ["at", "v"]
            )

    rows = vectors.select(col).mapInArrow(multiply, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros((width + 1) * width)
    for r in rows.toLocalIterator():
        out[r["at"]] = r["v"]
    out = out.reshape(width + 1, width)
    return out[width], out[:width]


def refine(matrix: np.ndarray, vectors: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of a symmetric matrix, from approximate eigenvectors.

    ``matrix`` and the results are long doubles. Each round is Ogita and
    Aishima's correction: with R = I - X'X and S = X'AX, X becomes X + XE, where
    E divides by the differences of eigenvalues. Where these are below the
    error of the round, the eigenvectors of the cluster are found anew from
    X'(A - m)X of the cluster's columns, m being its mean eigenvalue.
    """
    a = np.asarray(matrix, WIDE)
    x = np.asarray(vectors, WIDE)
    n = len(a)
    one = np.eye(n, dtype=WIDE)
    size = np.sqrt((a * a).sum())
    tiny = n * np.finfo(WIDE).eps
    before = np.inf
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2  # so that rounding turns vectors, but keeps right angles
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > error
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        order = np.argsort(-values, kind="stable")
        values, x = values[order], x[:, order]
        start, solved = 0, False
        for end in range(1, n + 1):
            if end < n and values[end - 1] - values[end] <= error:
                continue
            if end - start > 1:
                own = x[:, start:end]
                middle = values[start:end].mean()
                small = own.T @ (a @ own - middle * own)
                small = (small + small.T) / 2
                scale = np.abs(small).max()
                if scale > tiny * size:
                    solved = True
                    low, turn = np.linalg.eigh((small / scale).astype(np.float64))
                    x[:, start:end] = own @ turn[:, ::-1].astype(WIDE)
            start = end
        step = np.abs(e).max()
        if not solved and (step <= tiny or step > before / 2):
            break
        before = step
    for _ in range(2):  # a turn inside a narrow cluster, linear in E, bends right angles a little
        x = x + x @ (one - x.T @ x) / 2
    values = ((a @ x) * x).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


@dataclass(frozen=True)
class Whitening:
    """What was learned: ``n`` rows, ``sums`` by dimension, falling ``values`` and their ``components``."""

    n: int
    dims: int
    sums: list
    centre: np.ndarray
    shift: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        """Components whose variance is more than rounding."""
        return int((self.values > self.dims * np.finfo(float).eps * max(self.trace, 0.0)).sum())

    def projection(self, k: int) -> np.ndarray:
        """Components over the square roots of their variances; 0 for a component without variance."""
        k = min(k, self.dims)
        roots = np.zeros(k)
        used = min(k, self.rank)
        roots[:used] = 1 / np.sqrt(self.values[:used])
        return np.asarray(self.components[:, :k] * roots, np.float64)

    def explained(self, k: int) -> list[float]:
        """Share of the variance by component; 0 where there is none."""
        k = min(k, self.dims)
        return [float(max(v, 0) / self.trace) if self.trace > 0 else 0.0 for v in self.values[:k]]

    def transform(self, vectors: DataFrame, col: str, k: int, out: str = "whitened") -> DataFrame:
        """``vectors`` with the first ``k`` whitened coordinates in ``out``, an array of doubles."""
        project, dims, centre, shift = self.projection(k), self.dims, self.centre, self.shift
        k = project.shape[1]
        names = vectors.columns
        at = names.index(col)
        schema = T.StructType([*vectors.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts = [(m.astype(np.float64) - centre - shift) @ project for m in _matrices(batch.column(at), dims)]
                flat = np.concatenate(parts).ravel() if parts else np.zeros(0)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(batch.num_rows + 1) * k, pa.int32()), pa.array(flat)
                )
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*names, out])

        return vectors.mapInArrow(apply, schema)

    def identity_error(self, vectors: DataFrame, col: str, k: int) -> float:
        """The largest entry of the whitened rows' covariance less the identity, over all rows."""
        k = min(k, self.rank)
        if k == 0 or self.n == 0:
            return 0.0
        total, products = cross_products(vectors, col, self.dims, self.centre + self.shift, self.projection(k))
        mean = total / self.n
        return float(np.abs(products / self.n - np.outer(mean, mean) - np.eye(k)).max())


def fit(vectors: DataFrame, col: str) -> Whitening:
    """The whitening of all rows of ``vectors``, whose arrays are ``usable`` and of one length.

    Two passes over the column: sums, then cross products of the vectors less
    their mean. Integers are summed exactly. A vector of another length than the
    rest ends the job with an error; see ``same_length``. An empty table has no
    component. Rows that repeat count each. The covariance matrix, dims by dims,
    is what the driver holds.
    """
    one = vectors.select(F.size(col).alias("d")).first()
    dims = one["d"] if one else 0
    if dims <= 0:
        none = np.zeros(0)
        return Whitening(0, 0, [], none, none, none, np.zeros((0, 0)), 0.0)
    n, sums = column_sums(vectors, col, dims)
    # few bits, so that subtracting it leaves nothing to round
    mean = np.array([WIDE(s) / WIDE(n) for s in sums], WIDE)
    centre = mean.astype(np.float32).astype(np.float64)
    _, products = cross_products(vectors, col, dims, centre)
    shift = mean - centre.astype(WIDE)
    covariance = products.astype(WIDE) / WIDE(n) - np.outer(shift, shift)
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    scale = max(float(np.abs(covariance).max()), np.finfo(float).tiny)
    _, rough = np.linalg.eigh((covariance / WIDE(scale)).astype(np.float32))
    values, components = refine(covariance / WIDE(scale), rough[:, ::-1])
    # one sign for each: its largest coordinate is positive
    top = np.abs(components).argmax(axis=0)
    components = components * np.where(components[top, np.arange(dims)] < 0, -1, 1)
    return Whitening(
        n, dims, sums, centre, shift.astype(np.float64), (values * WIDE(scale)).astype(np.float64), components.astype(np.float64), trace
    )


def same_length(vectors: DataFrame, col: str) -> DataFrame:
    """The rows of ``vectors`` that are ``usable`` and of the most frequent length, the longer of equal ones.

    Null vectors, those with a null, NaN or infinite entry, and empty ones are left out.
    """
    fine = vectors.where(usable(F.col(col)) & (F.size(col) > 0))
    found = fine.groupBy(F.size(col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return fine.where(F.size(col) == F.lit(found["d"] if found else 0))


def scaled_integers(vector: Column, scale: float = 1024.0, offset: int = 100_000) -> Column:
    """``floor(scale * entry) + offset`` for every entry, as longs; null for one beyond a long."""

    def whole(c: Column) -> Column:
        product = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(product) < float(1 << 62), F.floor(product) + F.lit(offset).cast("long"))

    return F.transform(vector, whole)


def squared_deviation(vector: Column, sums: list[int], n: int) -> Column:
    """The sum over dimensions of (n * x - sum)^2, exact; null where it is beyond a long."""
    difference = F.zip_with(
        vector,
        F.array(*[F.lit(int(s)).cast("long") for s in sums]),
        lambda x, s: F.try_subtract(F.try_multiply(x, F.lit(int(n)).cast("long")), s),
    )
    return F.aggregate(
        difference, F.lit(0).cast("long"), lambda total, v: F.try_add(total, F.try_multiply(v, v))
    )
