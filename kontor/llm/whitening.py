"""Whitening of vectors by polarisation covariance.

Vectors become whole numbers (a fixed grid), so that everything up to the eigenvectors is
exact. With n vectors and sums S, a vector's centred entries are y = n*x - S, whole too.
The variance of each dimension, and of each sum of two dimensions, is an aggregate of
squares of centred values: ``sum(y_i^2)`` and ``sum((y_i + y_j)^2)``. Half the difference
of variances, ``(Var(i+j) - Var(i) - Var(j)) / 2``, is the covariance of i and j: no
product of two dimensions is ever summed. The covariances are assembled for ``eigh``.

Spark spreads the vectors; a task returns one row for each dimension pair whatever the
number of its vectors, and the rows meet in a grouped sum of decimals. The driver gets one
row for a dimension or pair of dimensions, which the number of vectors doesn't change.
Squares are summed in limbs of 21 bits, so no sum of a batch leaves 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kontor.llm.common import fresh, per_row, values

GRID = 1024
SHIFT = 100_000
COMPONENTS = 8
LIMB = 21
# Rows squared at a time; a limb's products stay under 2^42, a block's sums under 2^58.
BLOCK = 4096


@dataclass(frozen=True)
class Fit:
    """n, sums and eigenvectors of the fit list; ``kept`` numbers of components have a value."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # dimension x component
    values: np.ndarray  # eigenvalues of the components
    trace: float


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(math.inf)))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def gridded(vector: Column) -> Column:
    """Entries as whole numbers: floor(1024 * c) + 100000."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(GRID)) * c.cast("double")).cast("bigint") + SHIFT)


def whole(rows: list[np.ndarray], d: int) -> np.ndarray:
    """Rows of x; a vector shorter than d counts as ending in zeros."""
    if rows and all(len(r) == d for r in rows):
        return np.concatenate(rows).reshape(len(rows), d)
    out = np.full((len(rows), d), SHIFT, np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n*x - S, exact: in 64 bits where the values allow it, else as Python's integers."""
    largest = int(np.abs(x).max(initial=0))
    if max(largest, 1) * n < 1 << 60 and max(map(abs, sums), default=0) < 1 << 60:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(w: np.ndarray) -> list[int]:
    """Exact sum of squares of each column."""
    if w.dtype == object:
        return [int(v) for v in (w * w).sum(axis=0)] if len(w) else [0] * w.shape[1]
    top = int(np.abs(w).max(initial=0)).bit_length()
    limbs = []
    rest = np.abs(w)
    for _ in range(max(1, -(-top // LIMB))):
        limbs.append(rest & ((1 << LIMB) - 1))
        rest = rest >> LIMB
    total = [0] * w.shape[1]
    for i, a in enumerate(limbs):
        for j in range(i, len(limbs)):
            part = np.einsum("rc,rc->c", a, limbs[j])
            scale = (1 if i == j else 2) << (LIMB * (i + j))
            total = [t + int(p) * scale for t, p in zip(total, part.tolist())]
    return total


def _partials(df: DataFrame, fn: Callable[[Iterator[list]], Iterator[dict]], schema: str) -> DataFrame:
    """``fn`` over the lists of each task's vectors, in batches."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = (values(b.column(0).slice(at, BLOCK)) for b in batches for at in range(0, b.num_rows, BLOCK))
        rows = list(fn(lists))
        if rows:
            yield pa.RecordBatch.from_pydict({k: [r[k] for r in rows] for k in target.names}, schema=target)

    return df.mapInArrow(work, schema)


def sums(x: DataFrame) -> tuple[int, tuple[int, ...]]:
    """(n, sums of each dimension); the dimension is that of the longest vector."""

    def add(lists: Iterator[list]) -> Iterator[dict]:
        n, total = 0, []
        for rows in lists:
            n += len(rows)
            total += [0] * (max(map(len, rows), default=0) - len(total))
            block = whole(rows, len(total)) - SHIFT
            small = int(np.abs(block).max(initial=0)) < 1 << 40
            part = block.sum(axis=0).tolist() if small else block.astype(object).sum(axis=0).tolist()
            total = [a + b for a, b in zip(total, part)]
        if n:
            yield {"dim": -1, "total": Decimal(n)}
            for i, t in enumerate(total):
                yield {"dim": i, "total": Decimal(int(t))}

    parts = _partials(x, add, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    got = {r.dim: int(r.total) for r in parts.collect()}
    n = got.pop(-1, 0)
    return n, tuple(got[i] + n * SHIFT for i in sorted(got))


def pair_squares(x: DataFrame, n: int, totals: tuple[int, ...]) -> dict[tuple[int, int], int]:
    """Exact sums of squares of centred values: of dimension i at (i, i), of the sum of
    dimensions i and j at (i, j)."""
    d = len(totals)

    def add(lists: Iterator[list]) -> Iterator[dict]:
        alone, both = [0] * d, [[0] * (d - i - 1) for i in range(d)]
        seen = False
        for rows in lists:
            seen = True
            y = centred(whole(rows, d), n, totals)
            alone = [a + b for a, b in zip(alone, square_sums(y))]
            for i in range(d - 1):
                both[i] = [a + b for a, b in zip(both[i], square_sums(y[:, i : i + 1] + y[:, i + 1 :]))]
        if seen:
            for i in range(d):
                yield {"i": i, "j": i, "squares": Decimal(alone[i])}
                for k, s in enumerate(both[i]):
                    yield {"i": i, "j": i + 1 + k, "squares": Decimal(s)}

    parts = _partials(x, add, "i int, j int, squares decimal(38,0)")
    # spark.sql's sum of decimal(38,0) raises where a total leaves 38 digits.
    return {(r.i, r.j): int(r.s) for r in parts.groupBy("i", "j").agg(F.sum("squares").alias("s")).collect()}


def covariance(n: int, d: int, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariances of x (divisor n), each the double nearest to its exact value."""
    out = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            s = squares[i, j] if i == j else Fraction(squares[i, j] - squares[i, i] - squares[j, j], 2)
            out[i, j] = out[j, i] = float(Fraction(s) / n**3)
    return out


def fit(x: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Fit on all rows of ``x`` (one column, array<bigint>); None without rows."""
    n, totals = sums(x)
    if not n:
        return None
    d = len(totals)
    if not d:
        return Fit(n, totals, np.zeros((0, 0)), np.zeros(0), 0.0)
    v = covariance(n, d, pair_squares(x, n, totals))
    found, vectors = np.linalg.eigh(v)
    order = np.argsort(-found, kind="stable")[:components]
    found = found[order]
    # An eigenvalue below the rounding of the largest is a zero.
    found = np.where(found > d * np.finfo(float).eps * max(float(found[0]), 0.0), found, 0.0)
    return Fit(n, totals, np.ascontiguousarray(vectors[:, order]), found, float(np.trace(v)))


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Fit | None]:
    """(rows, fit): the rows of ``df`` with a usable vector, with ``deviation``
    (decimal(38,0): sum over dimensions of (n*x - S)^2) and ``whitened`` (array<double>, a
    number for each component, null for one of eigenvalue zero) in place of the vector.

    Rows whose vector is null or holds null or non-finite entries are left out; all others
    are fitted on and returned, repeated rows each on their own. A vector shorter than the
    longest counts as ending in zeros. Other columns stay as they are; columns of the two
    names are replaced. An entry must fit a long on the grid. No vectors: no fit, no rows.
    """
    name = fresh(df, "x")
    rows = df.where(usable(F.col(f"`{vector}`"))).withColumn(name, gridded(F.col(f"`{vector}`"))).drop(vector)
    own = fit(rows.select(name), components)
    n, totals = (own.n, own.sums) if own else (1, ())
    d = len(totals)

    def project(c: dict[str, list]) -> dict[str, list]:
        y = centred(whole(c[name], d), n, totals)
        small = y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * max(d, 1) < 1 << 63
        squares = np.einsum("rc,rc->r", y, y).tolist() if small else (y.astype(object) ** 2).sum(axis=1).tolist()
        if own is None or not len(own.values):
            return {"deviation": [Decimal(int(s)) for s in squares], "whitened": [[] for _ in squares]}
        share = (y / n).astype(float)
        some = own.values > 0
        out = (share @ own.vectors) / np.sqrt(np.where(some, own.values, 1.0))
        keep = some.tolist()
        return {
            "deviation": [Decimal(int(s)) for s in squares],
            "whitened": [[v if k else None for v, k in zip(row, keep)] for row in out.tolist()],
        }

    return per_row(rows, [name], project, "deviation decimal(38,0), whitened array<double>", slice_rows=BLOCK), own


def identity_error(rows: DataFrame, own: Fit | None) -> float | None:
    """Largest absolute entry of the whitened values' covariance minus the identity, over
    the components that have values; None without such components."""
    some = [k for k in range(len(own.values)) if own.values[k] > 0] if own else []
    if not some:
        return None
    w = {k: F.col("whitened")[k] for k in some}
    cells = [(a, b) for a in some for b in some if a <= b]
    # covar_pop centres before it multiplies; its divisor is the number of rows.
    got = rows.agg(*[F.covar_pop(w[a], w[b]).alias(f"c{a}_{b}") for a, b in cells]).first()
    return max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in cells)


def whitened_components(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component (numbered from 1 by falling
    eigenvalue): the other columns of ``df``, component int, n long, deviation
    decimal(38,0), whitened double, explained double (share of the trace; null where the
    trace is zero) and identity_error double, one value for all. See ``whiten``."""
    rows, own = whiten(df, vector, components)
    error = identity_error(rows, own)
    share = [float(v) / own.trace if own.trace > 0 else None for v in own.values] if own else []
    n = own.n if own else 0
    new = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in new]
    at, value = fresh(rows, "at"), fresh(rows, "value")
    wide = rows.select(*kept, "deviation", F.posexplode("whitened").alias(at, value))
    shares = F.array(*[F.lit(s).cast("double") for s in share]) if share else F.array(F.lit(None).cast("double"))
    return wide.select(
        *kept,
        (F.col(at) + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        F.col(value).alias("whitened"),
        F.get(shares, F.col(at)).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
