"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates are read in blocks; each block keeps one sorted list per component. For a query, a
list is read from the end where its products are largest. After a depth, what has been read of a
candidate gives its partial score; what has not is bounded below by the list's far end and above
by the value last read. Candidates whose upper bound is under the k-th best lower bound leave;
reading ends when no outsider can qualify, and the few left get their final scores.

Query blocks meet candidate blocks by a key join (slot of the query block, salt of the candidate
block), so no table is broadcast or collected and work is split at any number of queries. Each
pair of blocks gives at most k rows a query, and a grouped limit merges them.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors
are compared with those of the same length only; rows of the same id but the query's own id are
skipped as the query itself; null ids take no part; ties go to the smaller id. Components are held
within 2^60 on both sides. Scores beyond 2^53 are summed in whole numbers of any length; what
a long cannot hold is given as the largest or smallest long, in the order of the true scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

SCALE = 1024
BLOCK = 4096
QUERY_BLOCK = 256
LARGEST = 2.0 ** 60
FEW = 64            # so few candidates left are scored at once


def _valid(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    v = F.col(f"`{vector}`").cast("array<double>")
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(good & F.col("id").isNotNull())


def _blocks(size: int):
    """Rows of one dimension as (dim, part, number, ids, integer components) in blocks."""
    def run(batches):
        part, number, held = TaskContext.get().partitionId(), 0, {}

        def block(dim):
            nonlocal number
            ids, rows = zip(*held.pop(dim))
            values = np.clip(np.floor(SCALE * np.array(rows, np.float64).reshape(len(ids), dim)), -LARGEST, LARGEST).astype("<i8")
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([part], pa.int32()), pa.array([number - 1], pa.int32()),
                                               pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary())],
                                              names=["dim", "part", "number", "ids", "vectors"])

        for batch in batches:
            for i, v in zip(batch.column(0), batch.column(1)):
                held.setdefault(len(v), []).append((i.as_py(), v.as_py()))
                if len(held[len(v)]) >= size:
                    yield block(len(v))
        for dim in list(held):
            yield block(dim)
    return run


class Lists:
    """A block's sorted lists: values by rank, and each candidate's rank in each list."""

    def __init__(self, values: np.ndarray):
        n, dim = values.shape
        largest = float(np.abs(values).max()) if values.size else 0.0
        # sums of whole numbers are exact under 2 ** 24 in the short form, under 2 ** 53 in the long one
        self.short = dim * largest * largest < 2 ** 24
        self.whole = values
        self.values = values.astype(np.float32 if self.short else np.float64)
        self.largest = largest
        order = np.argsort(values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, order, axis=0)
        self.rank = np.empty((n, dim), np.int16 if n <= 32_000 else np.int32)
        np.put_along_axis(self.rank, order, np.arange(n, dtype=self.rank.dtype)[:, None], axis=0)

    def top(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best candidates other than the query's own id."""
        n, dim = self.values.shape
        if self.short and np.abs(query).max(initial=0) > self.largest:
            self.short, self.values, self.sorted = False, self.values.astype(np.float64), self.sorted.astype(np.float64)
        q = query.astype(self.values.dtype)
        alive = np.flatnonzero(ids != own)
        far = np.where(q >= 0, self.sorted[0], self.sorted[-1]) * q if n else q     # the least a list can give
        depth, step = max(1, n // 2), max(1, n // 8)
        values, rank = self.values, self.rank
        # larger sums are rounded: bounds are widened by what rounding can do, and survivors are summed in whole numbers
        size = dim * self.largest * float(np.abs(query).max(initial=0))
        error = 0.0 if size < 2 ** 53 else 8 * (dim + 4) * 2.0 ** -53 * size
        if len(alive) < n:
            values, rank = values[alive], rank[alive]
        while len(alive) > max(k, FEW) and depth < n:
            last = np.where(q >= 0, self.sorted[n - depth], self.sorted[depth - 1]) * q
            read = (np.where(q >= 0, rank >= n - depth, rank < depth)).astype(q.dtype)
            # read entries count in full; of the others the list's far end is the least and the last value the most
            partial = np.einsum("ij,ij,j->i", values, read, q)
            unread = np.stack([far.sum() - read @ far, last.sum() - read @ last])
            lower, upper = partial + unread
            bar = np.partition(lower, len(alive) - k)[len(alive) - k]
            stay = upper >= bar - 2 * error
            alive, values, rank = alive[stay], values[stay], rank[stay]
            depth = min(n, depth + step)
        if error:
            exact = sorted((-int(s), int(i)) for s, i in zip(self.whole[alive].astype(object) @ query.astype(object), ids[alive]))[:k]
            return [(max(-(1 << 63), min((1 << 63) - 1, -s)), i) for s, i in exact]
        scores = (self.values[alive] @ q).astype(np.int64)
        best = np.lexsort((ids[alive], -scores))[:k]
        return list(zip(scores[best].tolist(), ids[alive][best].tolist()))


def _pairs(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in zip(*batch.columns):
                dim, q_ids, q_vec, c_ids, c_vec = (x.as_py() for x in row)
                queries, ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(c_ids, "<i8")
                vectors = np.frombuffer(q_vec, "<i8").reshape(len(queries), dim)
                lists = Lists(np.frombuffer(c_vec, "<i8").reshape(len(ids), dim))
                found = [(int(q), i, s) for q, v in zip(queries, vectors) for s, i in lists.top(v, ids, int(q), k)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), (), ()))], schema=schema)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query."""
    asked = _valid(queries, id_col, vector)
    slots = max(1, -(-asked.count() // QUERY_BLOCK))
    salts = max(1, -(-48 // slots))
    shape = "dim int, part int, number int, ids binary, vectors binary"
    q = asked.repartition(slots, "id").mapInArrow(_blocks(1 << 30), shape).select(
        "dim", F.col("part").alias("slot"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    c = _valid(vectors, id_col, vector).mapInArrow(_blocks(BLOCK), shape).select(
        "dim", "ids", "vectors", F.pmod(F.xxhash64("part", "number"), F.lit(salts)).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    found = c.join(q, ["dim", "slot", "salt"]).select("dim", "q_ids", "q_vectors", "ids", "vectors").mapInArrow(
        _pairs(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
