"""Whitening against exact fractions and numpy, and on odd tables."""

from fractions import Fraction
from math import floor

import numpy as np
from pyspark.sql import functions as F

from posterion.llm import queries, whitening


def exact(rows):
    """x vectors, S and covariance as fractions."""
    x = [[floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n ** 3) for j in range(d)] for i in range(d)]
    return x, s, cov


def test_query_against_numpy(spark, data):
    vectors = spark.read.parquet(f"{data}/embeddings.parquet").orderBy("vec_id").collect()
    rows = [r.embedding for r in vectors]
    x, s, cov = exact(rows)
    n, d = len(x), len(x[0])
    v = np.array([[float(c) for c in r] for r in cov])
    model = whitening.fit(spark.read.parquet(f"{data}/embeddings.parquet"))
    assert np.abs(model.covariance - v).max() <= 1e-12 * np.abs(v).max() and model.sums == tuple(s) and model.n == n
    values = np.linalg.eigvalsh(v)[::-1]
    got = queries.QUERIES["op12_polarisation_whitening"](spark, data).toPandas().sort_values(["vec_id", "component"])
    k = min(32, int((values > 1e-11 * values[0]).sum()))
    assert len(got) == n * k and sorted(got.component.unique()) == list(range(1, k + 1))
    assert got.deviation.tolist() == [sum((n * r[i] - s[i]) ** 2 for i in range(d)) for r in x for _ in range(k)]
    w = got.whitened.to_numpy().reshape(n, k)
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-4 and got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-4
    assert np.allclose(got.explained.to_numpy()[:k], values[:k] / values.sum(), rtol=1e-4)
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s)] for r in x])
    unit = centred.T @ w / n / np.sqrt(values[:k])               # the directions the whitened values belong to
    assert np.allclose(v @ unit, unit * values[:k], atol=1e-8 * values[0]) and np.allclose((unit ** 2).sum(axis=0), 1)


def test_pair_squares_and_sums_are_exact_at_any_size():
    r = np.random.default_rng(3)
    for top in (5, 1 << 20, 1 << 40, 1 << 54):
        d = r.integers(-top, top, (7, 4))
        expected = [sum((int(a[i]) + int(a[j])) ** 2 if i != j else int(a[i]) ** 2 for a in d) for i in range(4) for j in range(i, 4)]
        assert whitening.pair_squares(d) == expected
        assert whitening.exact_sums(d) == [sum(map(int, c)) for c in d.T]


def test_odd_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [-1.0, 3.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, []), (7, [1.0]), (8, [2.0, 1e30]), (9, [2.0, -7.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("n", F.lit("n"))
    got = whitening.whitened(frame).toPandas()
    # the far entry leaves the other direction below the least eigenvalue
    assert sorted(got.vec_id.fillna(-1)) == [-1, 1, 1, 8, 9] and (got.n == 5).all()
    near = whitening.whitened(frame.filter("vec_id is null or vec_id <> 8")).toPandas()
    assert sorted(near.vec_id.fillna(-1)) == [-1, -1, 1, 1, 1, 1, 9, 9] and near.identity_error.iloc[0] < 1e-9
    far = [(0.5, 0.25), (0.5, 0.25), (-1.0, 3.0), (2.0, (1 << 53) / 64), (2.0, -7.5)]
    x, s, _ = exact(far)
    expected = sorted(sum((5 * a - b) ** 2 for a, b in zip(r, s)) for r in x)
    assert sorted(int(v) for v in got.drop_duplicates(["vec_id", "deviation"]).deviation) == sorted(set(expected))
    for few in (rows[:1], rows[:2], [], [(1, None)]):
        empty = whitening.whitened(spark.createDataFrame(few, "vec_id long, embedding array<double>"))
        assert empty.count() == 0 and "identity_error" in empty.columns
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<double>")
    only = whitening.whitened(flat).toPandas()                    # rank one: one component, no division by zero
    assert set(only.component) == {1} and abs(only.explained.iloc[0] - 1) < 1e-9 and only.identity_error.iloc[0] < 1e-9
