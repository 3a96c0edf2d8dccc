"""Embedding whitening by refined eigenvectors of an exact covariance.

*Covariance.* Entries are whole numbers (``x``), so their sums ``S`` are exact, and so is every centred entry
``z = n*x - S``. Tasks split ``z`` into digits of ``DIGIT`` bits and multiply the digits as float64 matrices, whose sums
stay below 2**53 for a batch; batches and tasks are added as whole numbers. The covariance ``Z'Z / n**3`` therefore
does not depend on the order or the split of the rows, and nothing cancels. Only tables of dimension by dimension sums reach
the driver, never rows.

*Eigenvectors.* A float32 eigensolver gives the first vectors. Each step of the refinement (Ogita and Aishima) takes
matrix products in extended precision, ``R = I - X'X`` and ``S = X'VX``, reads off the eigenvalues and corrects ``X`` by
``X + XE``; far eigenvalues converge quadratically. Eigenvalues that a step cannot tell apart form a cluster: within it
the correction only makes ``X`` orthonormal, and a sub-solve of the small matrix ``X_k'(V - mu I)X_k``, shifted so that
its digits describe the differences, turns the vectors inside their common space. Equal eigenvalues keep any orthonormal
basis. On machines whose long double is a double, the steps run in double precision.

*Whitening.* Rows are projected in tasks. Their covariance, for ``identity_error``, is a second pass of the same
projection, added over tasks.

Defined cases: a row whose vector is null or empty, holds null or non-finite entries, or an entry whose ``x`` does not
fit 62 bits, takes no part. Vectors of another length than most (of two equally frequent lengths, the longer) take no part. A null id is kept and
repeated rows count each time. A component without variance (eigenvalue not above the rounding error of the trace) has
null in ``whitened`` and does not enter ``identity_error``, which is null if no component has variance. A table with no
vectors gives no row. ``deviation`` is null where it does not fit its type (38 digits; in the query, a long).
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
DIGIT = 20
BLOCK = 1024  # rows multiplied at once: BLOCK * 2**(2 * DIGIT) < 2**53
STEPS = 24
LIMIT = 2.0**62
WIDE = np.longdouble
_WHOLE = pa.decimal128(38, 0)


class Fit(NamedTuple):
    """What the projection needs: row count, sums, eigenvectors as columns, eigenvalues (0 without variance), trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def _entries(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows take part, their x as one matrix)."""
    lengths = np.array([-1 if k is None else k for k in column.value_lengths().to_pylist()], np.int64)
    fits = lengths == dim
    if not fits.any():
        return fits, np.zeros((0, dim), np.int64)
    some = column.filter(pa.array(fits))
    flat = some.flatten()
    c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)  # null becomes NaN
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * c)
        fine = (np.abs(scaled) < LIMIT).all(axis=1)
    fits[np.flatnonzero(fits)[~fine]] = False
    return fits, scaled[fine].astype(np.int64) + SHIFT


def _lengths(vectors: DataFrame) -> int:
    """The most frequent length of usable vectors, 0 if there are none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            column = batch.column(1)
            for dim in {k for k in column.value_lengths().to_pylist() if k}:
                found[dim] = found.get(dim, 0) + int(_entries(column, dim)[0].sum())
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(found), pa.int32()), "n": pa.array(list(found.values()), pa.int64())})

    counted = vectors.mapInArrow(count, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).where("n > 0")
    best = counted.agg(F.max(F.struct("n", "dim")).alias("best")).first()["best"]
    return best["dim"] if best else 0


def _totals(vectors: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Exact count and sums."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dim
        for batch in batches:
            x = _entries(batch.column(1), dim)[1]
            n += len(x)
            for i in range(0, len(x), BLOCK):  # halves, so that a block's sum fits
                part = x[i : i + BLOCK]
                high, low = (part >> 31).sum(axis=0), (part & 0x7FFFFFFF).sum(axis=0)
                sums = [s + (int(h) << 31) + int(v) for s, h, v in zip(sums, high, low)]
        values = [Decimal(v) for v in (n, *sums)]
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(dim + 1), pa.int32()), "v": pa.array(values, _WHOLE)})

    rows = vectors.mapInArrow(add, "place int, v decimal(38,0)").groupBy("place").agg(F.sum("v").alias("v")).collect()
    found = {r["place"]: int(r["v"]) for r in rows}
    return found.get(0, 0), [found.get(k + 1, 0) for k in range(dim)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n*x - S``, exact: as int64 where that fits, else as Python integers."""
    largest = int(np.abs(x).max(initial=0))
    if n * largest < 1 << 61:  # so are the sums of at most n entries, or they are larger and fall to the other branch
        if max((abs(s) for s in sums), default=0) < 1 << 61:
            return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def digits(z: np.ndarray) -> list[np.ndarray]:
    """``z`` as float64 matrices d with z = sum of d[k] * 2**(DIGIT*k); the last one carries the sign."""
    out = []
    while z.size and int(np.abs(z).max()) >= 1 << DIGIT:
        out.append((z & ((1 << DIGIT) - 1)).astype(np.float64))
        z = z >> DIGIT
    return [*out, z.astype(np.float64)]


def _products(vectors: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """``Z'Z`` in whole numbers."""
    dim = len(sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        blocks = 0
        for batch in batches:
            x = _entries(batch.column(1), dim)[1]
            for i in range(0, len(x), BLOCK):
                parts = digits(centred(x[i : i + BLOCK], n, sums))
                for a, left in enumerate(parts):
                    for b, right in enumerate(parts):
                        held[a + b] = held.get(a + b, 0) + (left.T @ right).astype(np.int64)
                blocks += 1
                if blocks % 64 == 0:  # far below 2**63
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    def rows(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for power, gram in held.items():
            for i in range(dim):  # a row of the matrix at a time, from the diagonal
                yield pa.RecordBatch.from_pydict({"power": pa.array([power], pa.int32()), "i": pa.array([i], pa.int32()), "g": pa.array([gram[i, i:]], pa.list_(pa.int64()))})

    parts = vectors.mapInArrow(multiply, "power int, i int, g array<long>").select("power", "i", F.posexplode("g").alias("j", "g"))
    added = parts.groupBy("power", "i", "j").agg(F.sum(F.col("g").cast("decimal(20,0)")).alias("g")).toArrow()
    gram = [[0] * dim for _ in range(dim)]
    for power, i, j, g in zip(*(added[name].to_pylist() for name in ("power", "i", "j", "g"))):
        gram[i][i + j] += int(g) << (DIGIT * power)
        gram[i + j][i] = gram[i][i + j]
    return gram


def _wide(value: Fraction) -> np.longdouble:
    """A fraction rounded to the working precision, as the sum of two doubles."""
    high = float(value)
    return WIDE(high) + WIDE(float(value - Fraction(high)))


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix in the working precision, largest first."""
    dim = len(v)
    scale = np.abs(v).max(initial=0)
    if not scale:
        return np.zeros(dim, WIDE), np.eye(dim, dtype=WIDE)
    a = v / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    eye = np.eye(dim, dtype=WIDE)
    tiny = np.finfo(WIDE).eps * dim
    norm = float(np.linalg.norm(a.astype(np.float64), 2))
    best = np.inf
    for _ in range(STEPS):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        delta = 2 * (float(np.linalg.norm(off.astype(np.float64), 2)) + norm * float(np.linalg.norm(r.astype(np.float64), 2)))
        order = np.argsort(-values, kind="stable")
        x, s, r, values = x[:, order], s[np.ix_(order, order)], r[np.ix_(order, order)], values[order]
        gap = values[None, :] - values[:, None]
        cluster = np.concatenate([[0], np.cumsum(np.abs(np.diff(values)) > max(delta, float(tiny)))])
        apart = cluster[:, None] != cluster[None, :]
        e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        for k in np.unique(cluster):
            members = np.flatnonzero(cluster == k)
            if len(members) > 1:
                x[:, members] = _turned(a, x[:, members], float(tiny))
        change = max(float(np.abs(e).max()), float(delta))
        if change < float(tiny) or (change < 1e-15 and change >= best):
            break
        best = min(best, change)
    x = 1.5 * x - 0.5 * x @ (x.T @ x)  # orthonormal to the working precision, among nearly equal eigenvalues too
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _turned(a: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """The columns of ``x``, which span the space of a cluster, turned to its eigenvectors by a solve of the shifted small matrix
    (left as they are if the cluster's eigenvalues differ by rounding only)."""
    middle = np.einsum("ij,ij->j", x, a @ x).mean()
    small = x.T @ (a @ x) - middle * (x.T @ x)
    size = np.abs(small).max()
    if size <= tiny:
        return x
    turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(WIDE)
    return x @ (1.5 * turn - 0.5 * turn @ (turn.T @ turn))


def fit(vectors: DataFrame) -> Fit | None:
    """Eigenvectors of the covariance of all usable vectors (id, vector), None if there are none."""
    dim = _lengths(vectors)
    if not dim:
        return None
    n, sums = _totals(vectors, dim)
    gram = _products(vectors, n, sums)
    trace = Fraction(sum(gram[i][i] for i in range(dim)), n**3)
    v = np.array([[_wide(Fraction(g, n**3)) for g in row] for row in gram], WIDE)
    values, x = eigen(v)
    x = x * np.where(np.take_along_axis(x, np.abs(x).argmax(axis=0)[None, :], 0) < 0, -1, 1)
    none = values <= float(trace) * dim * np.finfo(np.float64).eps
    return Fit(n, sums, x.astype(np.float64), np.where(none, 0, values).astype(np.float64), float(trace))


def project(x: np.ndarray, fitted: Fit, count: int) -> np.ndarray:
    """The whitened components of rows of ``x``; NaN without variance."""
    z = centred(x, fitted.n, fitted.sums)
    values = fitted.values[:count]
    with np.errstate(divide="ignore", invalid="ignore"):
        y = (z / fitted.n).astype(np.float64) @ (fitted.vectors[:, :count] / np.sqrt(values))
    y[:, values == 0] = np.nan
    return y


def _identity_error(vectors: DataFrame, fitted: Fit, count: int) -> float | None:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    alive = np.flatnonzero(fitted.values[:count] > 0)
    if not len(alive):
        return None
    size = len(alive)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            x = _entries(batch.column(1), len(fitted.sums))[1]
            for i in range(0, len(x), BLOCK):
                y = project(x[i : i + BLOCK], fitted, count)[:, alive]
                total[:size] += y.T @ y
                total[size] += y.sum(axis=0)
        flat = total.ravel()
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(flat)), pa.int32()), "v": pa.array(flat, pa.float64())})

    added = vectors.mapInArrow(add, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros((size + 1) * size)
    total[added["place"].to_numpy()] = added["v"].to_numpy()
    total = total.reshape(size + 1, size) / fitted.n
    # Rows are centred before they are multiplied; what rounding leaves of their mean is taken out too.
    return float(np.abs(total[:size] - np.outer(total[size], total[size]) - np.eye(size)).max())


def _whitened(fitted: Fit, count: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, x = _entries(batch.column(1), len(fitted.sums))
            if not len(x):
                continue
            z = centred(x, fitted.n, fitted.sums)
            wide = len(fitted.sums) * int(np.abs(z).max()) ** 2 >= 1 << 62
            square = ((z.astype(object) if wide else z) ** 2).sum(axis=1)
            deviation = [Decimal(int(s)) if int(s) < 10**38 else None for s in square]
            y = project(x, fitted, count)
            flat = pa.array(y.ravel(), pa.float64(), mask=np.isnan(y.ravel()))
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).filter(pa.array(fits)), "deviation": pa.array(deviation, _WHOLE),
                "y": pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * count, pa.int32()), flat)})

    return rows


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation decimal(38,0), whitened, explained, identity_error for every usable vector and
    each of the first ``components``. The sign of a component makes its largest entry positive."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    slim = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fitted = fit(slim)
    if fitted is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    count = min(components, len(fitted.sums))
    error = _identity_error(slim, fitted, count)
    explained = F.array(*(F.lit(float(e) / fitted.trace if fitted.trace else 0.0) for e in fitted.values[:count]))
    rows = slim.mapInArrow(_whitened(fitted, count), "vec_id long, deviation decimal(38,0), y array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("y").alias("place", "whitened"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def _as_long(name: str) -> Column:
    return F.expr(f"try_cast({name} AS BIGINT)").alias(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.select(*(_as_long(c) if c == "deviation" else c for c in found.columns))
