"""Conditional-Gaussian tests against a plain computation, and PC over both kinds of columns."""

import itertools
import math

import numpy as np
import pytest

from posterion.operators.mixed import independence, mixed_pc
from posterion.operators.structure import learn_pc, links_frame

DISCRETE, CONTINUOUS = ["a", "b"], ["x", "y", "z"]


def rows(n=1500, seed=1, gap=.05):
    r = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        a = int(r.integers(0, 3))
        b = int((a + (r.random() < .4)) % 2)
        x = 1.5 * a + r.normal()
        y = .8 * x + r.normal()
        z = r.normal() + b
        row = [f"a{a}", f"b{b}", x, y, z]
        out.append([None if r.random() < gap else v if isinstance(v, str) else float(v) for v in row])
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "a string, b string, x double, y double, z double")


def brute(data, a, b, given):
    names = ["a", "b", "x", "y", "z"]
    used = [a, b, *given]
    ridge = {c: 1e-9 * np.var([r[names.index(c)] for r in data if r[names.index(c)] is not None]) for c in CONTINUOUS}
    part = [dict(zip(names, r)) for r in data if all(r[names.index(c)] is not None for c in used)]
    ds, cs = [c for c in used if c in DISCRETE], [c for c in used if c in CONTINUOUS]
    finest = {}
    for r in part:
        finest.setdefault(tuple(r[d] for d in ds), []).append(r)
    part = [r for cell in finest.values() if len(cell) >= len(cs) + 2 for r in cell]

    def model(own):
        d, c = [v for v in own if v in DISCRETE], [v for v in own if v in CONTINUOUS]
        cells = {}
        for r in part:
            cells.setdefault(tuple(r[v] for v in d), []).append([r[v] for v in c])
        ll = 0.0
        for cell in cells.values():
            n = len(cell)
            ll += n * math.log(n)
            if c:
                v = np.array(cell)
                ll -= n / 2 * np.linalg.slogdet(np.cov(v.T, bias=True).reshape(len(c), len(c)) + np.diag([ridge[x] for x in c]))[1]
        return ll, len(cells) * (1 + len(c) + len(c) * (len(c) + 1) // 2)

    xyz, z, xz, yz = model(used), model(list(given)), model([a, *given]), model([b, *given])
    return 2 * (xyz[0] + z[0] - xz[0] - yz[0]), xyz[1] + z[1] - xz[1] - yz[1]


def test_statistics_equal_a_plain_computation(spark):
    data = rows()
    data += [["rare", "b0", 1.0, 2.0, 3.0]] * 2                    # a cell too small for every test with continuous columns
    names = DISCRETE + CONTINUOUS
    tests = [(a, b, g) for a, b in itertools.combinations(names, 2) for k in range(3) for g in itertools.combinations([n for n in names if n not in (a, b)], k)]
    got = {(r.a, r.b, r.given): r for r in independence(frame(spark, data), DISCRETE, CONTINUOUS, tests).collect()}
    for a, b, g in tests:
        stat, free = brute(data, a, b, g)
        r = got[a, b, ",".join(g)]
        assert (r.g2, r.df) == (pytest.approx(max(stat, 0.0), abs=1e-5), free), (a, b, g)
    assert got["a", "y", ""].p < 1e-6 and got["a", "y", "x"].p > .001 and got["x", "z", "b"].p > .001


def test_pc_finds_the_mixed_graph(spark):
    df = frame(spark, rows(4000, 5))
    want = [("a", "b"), ("a", "x"), ("b", "z"), ("x", "y")]
    assert mixed_pc(df, DISCRETE, CONTINUOUS, alpha=.001) == want
    assert learn_pc(df, discrete=DISCRETE, continuous=CONTINUOUS, alpha=.001) == want
    assert links_frame(df, want).count() == 4


def test_constant_columns_and_empty_tables(spark):
    df = frame(spark, [["a0", "b0", 1.0, 1.0, 1.0]] * 20 + [["a1", "b1", 1.0, 1.0, 2.0]] * 20)
    got = independence(df, DISCRETE, CONTINUOUS, [("a", "x", ()), ("a", "z", ()), ("x", "y", ("a",))]).collect()
    assert got[0].p > .5 and got[1].p < 1e-6 and all(math.isfinite(r.g2) for r in got)
    none = independence(df.filter("false"), DISCRETE, CONTINUOUS, [("a", "x", ())]).collect()
    assert (none[0].g2, none[0].df, none[0].p) == (0.0, 0, 1.0)
    assert mixed_pc(df.filter("false"), DISCRETE, CONTINUOUS) == []
