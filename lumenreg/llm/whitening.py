"""Embedding whitening: QDWH spectral divide-and-conquer, then broadcast whitening.

Entries c become whole numbers x = floor(64 c) + 1000000. The covariance is taken over
the *fit list*, each distinct x vector once: Spark finds the distinct vectors, adds the
sums up exactly, and each task adds products of vectors centred by whole numbers, which
one aggregation merges. The covariance (dimensions squared, whatever the rows) is split
on the driver: the polar factor U of A - shift, by QR-based dynamically weighted Halley
steps (Cholesky-based ones once the weights are small), gives the spectral projector
(U + I) / 2 of the eigenvalues above the shift; bases of its range and of its
complement cut A into two smaller blocks, and so on until every block is one value.
The components whiten all rows from a broadcast matrix.

Rows whose vector is null, holds a null or a non-finite entry, or has another length
than most (ties: the longer) are dropped. Repeated rows, repeated ids and null ids give
their rows each. Directions without variance (rank below the asked components, one
distinct vector, an empty table) give no component. Components of equal eigenvalues are
some orthonormal basis of their space, the same for all rows. Entries of 2**50 or more
in size are refused. ``deviation`` is null where it doesn't fit a long;
``deviation_wide`` has up to 38 digits.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (DecimalType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from lumenreg.llm.batches import map_arrow
from lumenreg.session import remove_scratch, scratch_dir

SCALE, OFFSET, LIMIT = 64, 1_000_000, 2.0 ** 50
COMPONENTS = 16
#: The driver holds a few square matrices of this many rows at most (128 MB each).
MOST_DIMENSIONS = 4096
SLICE = 1 << 20  # entries worked on at once
EPS = np.finfo(float).eps


# ---------------------------------------------------------------- the method, on the driver
def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix, by QDWH steps."""
    m = len(a)
    scale = np.linalg.norm(a, 1)
    if scale == 0:
        return np.zeros_like(a)
    x, low, eye = a / scale, EPS, np.eye(m)
    for _ in range(20):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            z = np.linalg.cholesky(eye + wc * (x.T @ x))
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(z.T, np.linalg.solve(z, x.T)).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        if 1 - low < 10 * EPS and moved < 1e-9:
            break
    return x


def bisect(a: np.ndarray, scale: float):
    """(basis above a shift, basis below it) that block-diagonalise ``a``, or None if no
    shift parts its eigenvalues, which are then equal to the last digits."""
    m = len(a)
    diagonal = np.diag(a)
    spread = max(np.ptp(diagonal), np.linalg.norm(a - np.diag(diagonal)))
    if spread <= 4 * EPS * scale:
        return None
    start = np.random.Generator(np.random.Philox(m)).standard_normal((m, m))
    best = None
    for middle in (np.median(diagonal), np.mean(diagonal)):
        for step in (0.0, 1e-3, -1e-3, 0.03, -0.03, 0.2, -0.2):
            projector = (polar(a - (middle + step * spread) * np.eye(m)) + np.eye(m)) / 2
            rank = np.trace(projector)
            k = int(round(rank))
            if not 0 < k < m or abs(rank - k) > 1e-6:
                continue  # all on one side, or an eigenvalue at the shift
            q, _ = np.linalg.qr(projector @ start[:, :k])
            q, _ = np.linalg.qr(projector @ q)
            q, _ = np.linalg.qr(q, mode="complete")
            left = np.linalg.norm(q[:, k:].T @ a @ q[:, :k])
            if best is None or left < best[0]:
                best = left, q[:, :k], q[:, k:]
            if left <= 8 * m * EPS * scale:
                return best[1:]
    return best[1:] if best and best[0] <= 1e-10 * scale else None


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    scale = np.linalg.norm(a)
    open_blocks, values, vectors = [np.eye(len(a))], [], []
    while open_blocks:
        basis = open_blocks.pop()
        block = basis.T @ a @ basis
        parts = bisect((block + block.T) / 2, scale) if len(block) > 1 else None
        if parts is None:
            values.extend(np.diag(block))
            vectors.append(basis)
        else:
            open_blocks += [basis @ parts[1], basis @ parts[0]]
    order = np.argsort(-np.array(values), kind="stable")
    found = np.hstack(vectors)[:, order]
    return np.array(values)[order], found / np.linalg.norm(found, axis=0)


# ---------------------------------------------------------------- Spark side
def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows that are kept, before any look at lengths."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    wide = F.exists(v, lambda c: F.abs(c) >= LIMIT)
    x = F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return (rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(v.isNotNull() & ~bad)
            .select("vec_id", F.when(wide, F.raise_error(F.lit("an entry is too large to be a long")))
                    .otherwise(x).alias("x")))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(fit: DataFrame, width: int, products) -> dict:
    """{(i, j): sum over the fit list} of the matrices that ``products`` makes of a slice.

    One matrix for each task goes to the shuffle, as rows of its upper triangle.
    """
    step = max(1, SLICE // width)

    def run(batches):
        total = None
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for at in range(0, len(x), step):
                part = products(x[at:at + step])
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                names=["i", "j", "g"])

    rows = map_arrow(fit.select("x"), run, "i int, j int, g double").groupBy("i", "j").agg(
        F.sum("g").alias("g")).collect()  # dimensions squared, whatever the rows
    return {(r["i"], r["j"]): r["g"] for r in rows}


def _symmetric(cells: dict, size: int) -> np.ndarray:
    out = np.zeros((size, size))
    for (i, j), g in cells.items():
        out[i, j] = out[j, i] = g
    return out


def _with_one(y: np.ndarray) -> np.ndarray:
    """Products of the columns with each other and with 1: sums come along, in the last column."""
    y = np.hstack([y, np.ones((len(y), 1))])
    return y.T @ y


class Whitening:
    """What is fitted: n, exact sums S, eigenvalues and components, and the error of the fit."""

    def __init__(self, n, sums, values, vectors, trace):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        self.centre = [s // n for s in sums]  # S = n * centre + rest
        self.rest = [s - n * c for s, c in zip(sums, self.centre)]
        self.identity_error = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        y = x - np.array(self.centre, np.int64)
        return y - np.array([r / self.n for r in self.rest])

    def white(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        y = x - np.array(self.centre, np.int64)
        largest = int(np.abs(y).max(initial=0)) + 1
        if largest * max(largest, self.n) * x.shape[1] >= 1 << 62:
            y = y.astype(object)
        squares, mixed = (y * y).sum(1), y @ np.array(self.rest, y.dtype)
        whole = sum(r * r for r in self.rest)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + whole
                for a, b in zip(squares, mixed)]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of column ``x``; None if no direction has variance."""
    spark = vectors.sparkSession
    path = scratch_dir(spark, "whitening-fit")
    try:
        vectors.select("x").distinct().write.parquet(path)
        distinct = spark.read.schema("x array<long>").parquet(path)
        common = (distinct.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
                  .orderBy(F.desc("n"), F.desc("size")).first())
        if common is None or not common["size"]:
            return None
        width = common["size"]
        if width > MOST_DIMENSIONS:
            raise ValueError(f"at most {MOST_DIMENSIONS} dimensions, got {width}")
        distinct = distinct.where(F.size("x") == width)
        row = distinct.agg(F.count(F.lit(1)).alias("n"), *[
            F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]).first()
        n, sums = row["n"], [int(row[f"s{i}"]) for i in range(width)]
        centre = np.array([s // n for s in sums], np.int64)
        cells = _symmetric(_sums(distinct, width, lambda x: _with_one((x - centre).astype(float))),
                           width + 1)
        mean = cells[:-1, -1] / n  # below 1: the vectors are already centred but for that
        covariance = cells[:-1, :-1] / n - np.outer(mean, mean)
        values, found = spectral(covariance)
        few = int((values[:components] > 8 * width * EPS * max(values[0], 0.0)).sum())
        if not few:
            return None
        model = Whitening(n, sums, values[:few], found[:, :few], float(np.trace(covariance)))
        shared = spark.sparkContext.broadcast(model)
        cells = _symmetric(_sums(distinct, width, lambda x: _with_one(shared.value.white(x))), few + 1)
        mean = cells[:-1, -1] / n
        white = cells[:-1, :-1] / n - np.outer(mean, mean)
        model.identity_error = float(np.abs(white - np.eye(few)).max())
        return model
    finally:
        remove_scratch(spark, path)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """A row for each kept row and component: see the module."""
    vectors = whole_vectors(rows, id_col, vector_col)
    model = fit(vectors, components)
    schema = StructType([
        StructField(id_col, vectors.schema["vec_id"].dataType), StructField("component", IntegerType()),
        StructField("n", LongType()), StructField("deviation", LongType()),
        StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
        StructField("identity_error", DoubleType()), StructField("deviation_wide", DecimalType(38, 0))])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    width, few = len(model.sums), len(model.values)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    step = max(1, SLICE // max(width, few))

    def run(batches):
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = _matrix(part.column(1), width)
                far = m.deviations(x)
                each = np.repeat(np.arange(len(x)), few)
                constant = lambda v, t: pa.array(np.full(len(each), v), t)
                fits = pa.array([d if d < 1 << 63 else None for d in far], pa.int64())
                wide = pa.array([Decimal(d) if d < 10 ** 38 else None for d in far], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, few + 1), len(x)), pa.int32()),
                    constant(m.n, pa.int64()), fits.take(pa.array(each)), pa.array(m.white(x).ravel()),
                    pa.array(np.tile(m.values / m.trace, len(x))),
                    constant(m.identity_error, pa.float64()), wide.take(pa.array(each))], schema=arrow)

    return map_arrow(vectors.where(F.size("x") == width), run, schema)
