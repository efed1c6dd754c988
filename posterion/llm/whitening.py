"""Embedding whitening from exact variances alone.

Entries become integers x = floor(64 * c) + 1000000. With n vectors and per-dimension sums S the
centred integers z = n * x - S are exact, and so are the sums of z_i^2 of every dimension and of
(z_i + z_j)^2 of every pair. Half the difference of variances is the cross-covariance:
2 * sum(z_i z_j) = sum((z_i + z_j)^2) - sum(z_i^2) - sum(z_j^2). The matrix is assembled on the
driver (dimensions squared numbers, whatever the number of vectors) and goes to `eigh`.

Tasks square d = x - q, with q the mean rounded to an integer, so that numbers stay short; with
r = S - n * q the sums of z follow exactly: sum((z_i + z_j)^2) = n * (n * sum((d_i + d_j)^2) - (r_i + r_j)^2).
Each task sends one number a dimension and pair. No vector leaves its task before the result.

Defined cases: vectors that are null or hold null, NaN or infinite entries take no part; nor do
vectors of another length than the most frequent one (of two as frequent, the longer). x is held
within 2^53 on both sides. Repeated rows and rows without id count like any other. Components
with less than 1e-11 of the largest eigenvalue cannot be scaled to unit variance and are left
out, so one vector alone, or only equal ones, give no rows; nor does an empty table. A
deviation of more than 38 digits is null.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from posterion.llm.common import renamed

SCALE, OFFSET = 64, 1_000_000
LIMIT = 1 << 53
COMPONENTS = 32
LEAST = 1e-11                # of the largest eigenvalue: components below it are noise
ROWS = 2048                  # rows squared at a time


@dataclass(frozen=True)
class Whitening:
    """Everything a row needs: n, sums S, rounded means q, eigenvalues and unit eigenvectors (columns)."""
    n: int
    sums: tuple[int, ...]
    centre: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def remainder(self) -> list[int]:
        return [s - self.n * q for s, q in zip(self.sums, self.centre)]

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)


def integers(vectors: pa.Array, dims: int) -> np.ndarray:
    """x of a batch as int64[row, dimension]."""
    c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(SCALE * c), -LIMIT, LIMIT).astype(np.int64) + OFFSET


def exact_sums(a: np.ndarray) -> list[int]:
    """Column sums without overflow."""
    high, low = a >> 26, a & ((1 << 26) - 1)
    return [(h << 26) + l for h, l in zip(high.sum(axis=0).tolist(), low.sum(axis=0).tolist())]


def pair_squares(d: np.ndarray) -> list[int]:
    """sum((d_i + d_j)^2) of all pairs i < j by rows, each row led by sum(d_i^2)."""
    widest = int(np.abs(d).max(initial=0))
    if 4 * widest * widest * max(1, len(d)) >= 1 << 62:
        d = d.astype(object)
    out: list[int] = []
    for i in range(d.shape[1]):
        both = d[:, i:] + d[:, i:i + 1]
        both[:, 0] = d[:, i]
        out += [int(v) for v in (both * both).sum(axis=0)]
    return out


def usable(vectors: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, int, int]:
    """vec_id and vector of the rows that take part, their dimension and number."""
    rows = renamed(vectors, {"vec_id": id_col, "v": vector}).filter(
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    lengths = rows.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    dims, n = (lengths[0].dims, lengths[0].n) if lengths else (0, 0)
    return rows.filter(F.size("v") == dims), dims, n


def totals(rows: DataFrame, dims: int, measure) -> dict[int, int]:
    """Column-wise sums of measure(x) over all rows: partial sums in each task, then one exact sum."""
    schema = pa.schema([("at", pa.int32()), ("value", pa.decimal128(38, 0))])

    def partial(batches):
        total: list[int] = []
        for batch in batches:
            x = integers(batch.column(0), dims)
            for start in range(0, len(x), ROWS):
                part = measure(x[start:start + ROWS])
                total = [a + b for a, b in zip(total, part)] if total else part
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(38, 0))], schema=schema)

    found = rows.select("v").mapInArrow(partial, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value")).collect()
    return {r["at"]: int(r["value"]) for r in found}


def fit(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all vectors; None where none takes part or none varies."""
    rows, dims, n = usable(vectors, id_col, vector)
    if not n:
        return None
    found = totals(rows, dims, exact_sums)
    sums = tuple(found[i] for i in range(dims))
    centre = tuple((2 * s + n) // (2 * n) for s in sums)
    origin = np.array(centre, np.int64)
    squares = totals(rows, dims, lambda x: pair_squares(x - origin))
    r = [s - n * q for s, q in zip(sums, centre)]

    single, pairs, at = [0] * dims, {}, 0
    for i in range(dims):
        for j in range(i, dims):
            if i == j:
                single[i] = n * (n * squares[at] - r[i] * r[i])
            else:
                pairs[i, j] = n * (n * squares[at] - (r[i] + r[j]) ** 2)
            at += 1
    cov = np.empty((dims, dims))
    for i in range(dims):
        cov[i, i] = single[i] / n ** 3
        for j in range(i + 1, dims):
            cov[i, j] = cov[j, i] = (pairs[i, j] - single[i] - single[j]) / (2 * n ** 3)
    values, unit = np.linalg.eigh(cov)
    values, unit = values[::-1][:components], unit[:, ::-1][:, :components]
    live = values > LEAST * max(values[0], 0.0)
    values, unit = values[live], unit[:, live]
    if not len(values):
        return None
    lead = np.abs(unit).argmax(axis=0)
    unit = unit * np.where(unit[lead, range(unit.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, centre, cov, values, unit)


def projected(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Whitened coordinates of integer vectors."""
    shift = np.array([r / model.n for r in model.remainder])
    return ((x - np.array(model.centre, np.int64)) - shift) @ (model.vectors / np.sqrt(model.values))


def deviations(model: Whitening, x: np.ndarray) -> list[int]:
    """sum over dimensions of (n * x - S)^2, exact."""
    d = x - np.array(model.centre, np.int64)
    widest = model.n * (int(np.abs(d).max(initial=0)) + 1)
    if widest * widest * max(1, d.shape[1]) >= 1 << 62:
        d = d.astype(object)
    z = d * model.n - np.array(model.remainder, d.dtype)
    return [int(v) for v in (z * z).sum(axis=1)]


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from the vectors themselves."""
    dims, k = model.vectors.shape

    def partial(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = projected(model, integers(batch.column(0), dims))
            first += w.sum(axis=0)
            second += w.T @ w
        value = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_pydict({"at": np.arange(len(value), dtype=np.int32), "value": value})

    found = rows.select("v").mapInArrow(partial, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(k + k * k)
    for r in found:
        flat[r["at"]] = r["value"] / model.n
    return float(np.abs(flat[k:].reshape(k, k) - np.outer(flat[:k], flat[:k]) - np.eye(k)).max())


ROW = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained, identity_error."""
    model = fit(vectors, id_col, vector, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], ROW + ", identity_error double")
    rows, dims, _ = usable(vectors, id_col, vector)
    k = len(model.values)
    explained = model.explained

    def work(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = integers(part.column(1), dims)
                m = len(x)
                if not m:
                    continue
                far = [Decimal(v) if v < 10 ** 38 else None for v in deviations(model, x)]
                twice = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(twice)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, model.n, np.int64)), pa.array(far, pa.decimal128(38, 0)).take(pa.array(twice)),
                     pa.array(projected(model, x).ravel()), pa.array(np.tile(explained, m))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    out = rows.select(F.col("vec_id").cast("long"), "v").mapInArrow(work, ROW)
    return out.withColumn("identity_error", F.lit(identity_error(rows, model)))
