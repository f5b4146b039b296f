"""Embedding whitening by polarisation: covariances from differences of variances, all sums exact.

Every component c becomes the whole number x = floor(64 c) + 1000000. With n vectors and
sums S, y = n x - S is x centred, times n, and still whole. Tasks add up y_i**2 for every
dimension and (y_i + y_j)**2 for every pair of dimensions; since

    (y_i + y_j)**2 - y_i**2 - y_j**2 = 2 y_i y_j,

half the differences of those sums are all cross-covariances, times n**3. Squares are
added in limbs of 24 bits, so nothing is rounded before the covariance matrix is divided
out and handed to ``eigh``. Only that matrix (dimensions squared) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quipu.storage import stage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
_LIMB = 24
_ROWS = 2048  # vectors worked on at once; 2**11 squares of 2**24 bits, doubled, stay below 2**60
_LIMITED = float(1 << 61)
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Fit:
    """Count, sums per dimension, eigenvectors in columns, eigenvalues (falling) and the trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace > 0 else np.zeros(len(self.values))

    @property
    def spread(self) -> np.ndarray:
        """Which components vary at all, by the usual bound of numerical rank."""
        floor = len(self.sums) * np.finfo(float).eps * self.values.max(initial=0)
        return self.values > floor


def whole_numbers(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every component; beyond 2**61 the product stops there."""
    scaled = lambda c: F.least(F.greatest(F.floor(c.cast("double") * SCALE).cast("double"), F.lit(-_LIMITED)), F.lit(_LIMITED))
    return F.transform(vector, lambda c: F.when(F.abs(c) < 1e15, F.floor(c.cast("double") * SCALE)).otherwise(scaled(c).cast("bigint")) + SHIFT)


def _usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, x) of the vectors without null, NaN or infinite components, of the commonest length."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    known = rows.filter(vector.isNotNull() & finite).select(F.col(id_col).alias("id"), vector.alias("vector"))
    length = known.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    fit_rows = known.filter(F.size("vector") == (length["n"] if length else 0))
    return fit_rows.select("id", whole_numbers(F.col("vector")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part, _matrix(part.column(at))


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: in 64 bits where that fits, else as Python's integers."""
    most = max(int(np.abs(x).max(initial=0)), 1)
    if n * most + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(t: np.ndarray) -> list[int]:
    """The exact sum of squares of every column."""
    if t.dtype != object and int(np.abs(t).max(initial=0)) < 1 << (2 * _LIMB):
        high, low = t >> _LIMB, t & ((1 << _LIMB) - 1)
        tops, middles, lows = ((a * b).sum(axis=0).tolist() for a, b in ((high, high), (high, low), (low, low)))
        return [(a << 2 * _LIMB) + (b << _LIMB + 1) + c for a, b, c in zip(tops, middles, lows)]
    return [sum(v * v for v in column) for column in t.astype(object).T.tolist()]


_DIGITS = 10**18


def _parts(cells: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """Cells (i, j) with their sums, cut into two parts that Spark can add up without overflow."""
    split = [divmod(v, _DIGITS) for v in cells.values()]
    i, j = zip(*cells) if cells else ((), ())
    kind = pa.decimal128(38, 0)
    arrays = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([a for a, _ in split], kind), pa.array([b for _, b in split], kind)]
    return pa.RecordBatch.from_arrays(arrays, names=["i", "j", "high", "low"])


def _added(rows: DataFrame, run) -> dict[tuple[int, int], int]:
    """The cells of all tasks, added up: at most dimensions squared of them."""
    parts = rows.mapInArrow(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    cells = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    return {(c["i"], c["j"]): int(c["high"]) * _DIGITS + int(c["low"]) for c in cells}


def _totals(rows: DataFrame) -> tuple[int, list[int]]:
    def run(batches):
        n, sums = 0, None
        for _, x in _blocks(batches, 1):
            # Two limbs: 2**11 values of 62 bits would not fit.
            part = [(a << 32) + b for a, b in zip((x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist())]
            n, sums = n + len(x), part if sums is None else [a + b for a, b in zip(sums, part)]
        if n:
            yield _parts({(-1, -1): n} | {(i, i): s for i, s in enumerate(sums)})

    cells = _added(rows, run)
    n = cells.pop((-1, -1), 0)
    return n, [cells[i, i] for i in range(len(cells))]


def cross_sums(rows: DataFrame, n: int, sums: list[int]) -> list[list[int]]:
    """Sums of y_i y_j over all rows, from squares of every y_i and every y_i + y_j."""
    size = len(sums)

    def run(batches):
        cells: dict[tuple[int, int], int] = {}
        for _, x in _blocks(batches, 1):
            y = centred(x, n, sums)
            for i in range(size):
                pairs = y[:, i:] + y[:, i : i + 1]
                pairs[:, 0] = y[:, i]  # the dimension itself, then its sums with the later ones
                for j, value in enumerate(squares(pairs), i):
                    cells[i, j] = cells.get((i, j), 0) + value
        if cells:
            yield _parts(cells)

    found = _added(rows, run)
    crossed = [[0] * size for _ in range(size)]
    for (i, j), value in found.items():
        whole = value if i == j else (value - found[i, i] - found[j, j]) // 2
        crossed[i][j] = crossed[j][i] = whole
    return crossed


def fitted(rows: DataFrame) -> Fit | None:
    """The fit on rows (id, x); None without rows or dimensions."""
    n, sums = _totals(rows)
    if not n or not sums:
        return None
    crossed = cross_sums(rows, n, sums)
    covariance = np.array([[c / n**3 for c in row] for row in crossed])  # each quotient is rounded once
    values, vectors = np.linalg.eigh(covariance)
    return Fit(n, sums, vectors[:, ::-1], values[::-1], sum(crossed[i][i] for i in range(len(sums))) / n**3)


def _whitened(rows: DataFrame, fit: Fit, components: int) -> DataFrame:
    """Rows (id, deviation, whitened): the first components of every vector, NaN where one does not vary."""
    kept = min(components, len(fit.sums))
    scale = np.where(fit.spread, 1 / np.sqrt(np.where(fit.spread, fit.values, 1)), np.nan)[:kept]
    onto = fit.vectors[:, :kept] * scale

    def run(batches):
        for part, x in _blocks(batches, 1):
            y = centred(x, fit.n, fit.sums)
            if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] <= _LONG:
                deviation = (y * y).sum(axis=1).tolist()
            else:
                deviation = [sum(v * v for v in row) for row in y.astype(object).tolist()]
            white = (y / fit.n).astype(float) @ onto
            arrays = [part.column(0), pa.array([d if d <= _LONG else None for d in deviation], pa.int64())]
            arrays.append(pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * kept, pa.int32()), pa.array(white.ravel())))
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "deviation", "whitened"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, components: list[int]) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity; centred before multiplying."""
    if not components:
        return 0.0
    means = white.agg(*[F.avg(F.get("whitened", F.lit(c))).alias(f"m{c}") for c in components]).first()
    mean = np.array([means[f"m{c}"] for c in components])

    def run(batches):
        total, n = None, 0
        for batch in batches:
            if batch.num_rows:
                w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[:, components] - mean
                total, n = w.T @ w + (0 if total is None else total), n + len(w)
        if n:
            i, j = np.indices(total.shape)
            arrays = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel()), pa.array(np.full(i.size, n), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "total", "n"])

    sums = white.select("whitened").mapInArrow(run, "i int, j int, total double, n long").groupBy("i", "j").agg((F.sum("total") / F.sum("n")).alias("v"))
    off = F.abs(F.col("v") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return sums.agg(F.max(off)).first()[0]


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: (id, component from 1, n, deviation, whitened, explained, identity_error).

    Components are unit eigenvectors of the covariance of x by falling eigenvalue; ``whitened``
    is the centred x on that component over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of the trace. Vectors that are null, hold null or non-finite components
    or have another length than the commonest (of equals, the longest) take no part, nor do
    empty ones. Repeated rows and rows without an id stay. Where all vectors agree in a direction, so that its
    eigenvalue is 0, ``whitened`` is null and the component is no part of ``identity_error``;
    ``deviation`` is null where it passes 64 bits. Only the two named columns are read.
    """
    known = stage(_usable(rows, id_col, vector_col), "vectors")
    fit = fitted(known)
    if fit is None:
        none = known.filter("false")
        kinds = {"component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
        return none.select(F.col("id").alias(id_col), *[F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()])
    white = stage(_whitened(known, fit, components), "whitened")
    kept = min(components, len(fit.sums))
    error = identity_error(white, [c for c in range(kept) if fit.spread[c]])
    shares = F.array(*[F.lit(float(v)) for v in fit.explained[:kept]])
    laid = white.select("id", "deviation", F.posexplode("whitened").alias("place", "value"))
    return laid.select(
        F.col("id").alias(id_col),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(fit.n).cast("bigint").alias("n"),
        "deviation",
        F.nanvl("value", F.lit(None).cast("double")).alias("whitened"),
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
