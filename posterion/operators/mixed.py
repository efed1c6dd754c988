"""Conditional independence over discrete and continuous columns at once (G2, mixed).

A set of columns is modelled as conditional Gaussian: a multinomial over its discrete part and, in each
of its cells, a Gaussian over its continuous part. Two columns are tested given others by the
likelihood ratio of four such models, ll(xyz) + ll(z) - ll(xz) - ll(yz). Everything comes from moments
summed by cell: the table is folded once by its discrete columns, every batch of tests is one
job over the folded cells, and four numbers a test reach the driver.

Rows with a gap in a test's columns are left out of it, and so are its finest cells with fewer than
(continuous columns + 2) rows, from all four models. A ridge of 1e-9 of each column's variance (1e-9
where that is 0) keeps constant cells finite.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from posterion.functions.scalars import as_double, quoted, state_index
from posterion.operators.fit import discover
from posterion.operators.structure import TEST_BATCH, chi_square_p, correlation_matrix, fisher_z_p, orient, partial_correlation, refuted_by_counts
from posterion.plans.network import Network
from posterion.plans.templates import independent
from posterion.sources.storage import reused

RIDGE = 1e-9


def folded(df: DataFrame, discrete, continuous) -> tuple[DataFrame, Network, dict[str, float]]:
    """One row per combination of discrete states and of present continuous columns: state numbers, `present` (bit
    i: the i-th continuous column has a value), n, s (sums), q (products i <= j) of the centred values; the variances too."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    network, centres = discover(df, independent(discrete=discrete, continuous=continuous))
    x = [as_double(quoted(c), fields[c]) - F.lit(centres[c]) for c in continuous]
    rows = df.select(*[state_index(quoted(c), network[c].states, fields[c]).alias(c) for c in discrete], *[v.alias(f"__x{i}") for i, v in enumerate(x)])
    mask = F.lit(0).cast("bigint")
    for i in range(len(x)):
        mask = mask + F.when(F.col(f"__x{i}").isNotNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    v = [F.coalesce(f"__x{i}", F.lit(0.0)) for i in range(len(x))]
    sums = [F.sum(a).alias(f"s{i}") for i, a in enumerate(v)]
    sums += [F.sum(v[i] * v[j]).alias(f"q{i}_{j}") for i, j in _pairs(len(v))]
    cells = rows.withColumn("present", mask).groupBy(*[quoted(c) for c in discrete], "present").agg(F.count(F.lit(1)).alias("n"), *sums)
    none = F.array().cast("array<double>")
    cells = reused(cells.select(*[quoted(c) for c in discrete], "present", "n", F.array(*[f"s{i}" for i in range(len(v))]).alias("s") if v else none.alias("s"),
                                F.array(*[f"q{i}_{j}" for i, j in _pairs(len(v))]).alias("q") if v else none.alias("q")))
    spread = df.agg(F.lit(1), *[F.var_pop(as_double(quoted(c), fields[c])).alias(f"v{i}") for i, c in enumerate(continuous)]).head()
    return cells, network, {c: spread[f"v{i}"] or 0.0 for i, c in enumerate(continuous)}


def _pairs(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


def _code(network: Network, names) -> Column:
    at = F.lit(0).cast("bigint")
    for n in names:
        at = at * F.lit(len(network[n].states)) + quoted(n)
    return at


def likelihood_ratios(known, discrete, continuous, tests) -> list[tuple[float, int]]:
    """(ratio statistic, degrees of freedom) of every test (a, b, given)."""
    cells, network, spread = known
    out: list[tuple[float, int]] = []
    for start in range(0, len(tests), TEST_BATCH):
        out += _batch(cells, network, spread, list(discrete), list(continuous), tests[start:start + TEST_BATCH])
    return out


def _batch(cells, network, spread, discrete, continuous, tests) -> list[tuple[float, int]]:
    place = {p: k for k, p in enumerate(_pairs(len(continuous)))}
    number = {c: i for i, c in enumerate(continuous)}
    entries, terms = [], []
    for t, (a, b, given) in enumerate(tests):
        names = [a, b, *given]
        ds, cs = [n for n in names if n in discrete], [n for n in names if n in continuous]
        grid = network.grid_size(ds)
        if grid >= 2 ** 62:
            raise ValueError(f"the states of {names} have too many combinations to test")
        ix = [number[c] for c in cs]
        need = sum(1 << i for i in ix)
        ok = F.col("present").bitwiseAND(F.lit(need).cast("bigint")) == need
        vector = [F.get("s", F.lit(i)) for i in ix] + [F.get("q", F.lit(place[min(i, j), max(i, j)])) for i, j in ((ix[p], ix[q]) for p, q in _pairs(len(ix)))]
        values = F.array(*vector) if vector else F.array().cast("array<double>")
        entries.append(F.when(ok & _code(network, ds).isNotNull(), F.struct(F.lit(t).alias("test"), _code(network, ds).alias("code"), F.col("n"), values.alias("v"))))
        # the four models of a test: which digits of the code and which of its continuous columns they keep
        for k, own in enumerate(([a, b, *given], list(given), [a, *given], [b, *given])):
            terms.append((t, k, ds, cs, own))
    width = max((len(t) for t in ([n for n in (a, b, *g) if n in continuous] for a, b, g in tests)), default=0)
    size = width + len(_pairs(width))
    wide = cells.select(F.inline(F.array_compact(F.array(*entries)))).select("test", "code", "n", *[F.coalesce(F.get("v", F.lit(i)), F.lit(0.0)).alias(f"v{i}") for i in range(size)])
    finest = wide.groupBy("test", "code").agg(F.sum("n").alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(size)])
    many = F.element_at(F.array(*[F.lit(len([n for n in (a, b, *g) if n in continuous])) for a, b, g in tests]), F.col("test") + 1)
    finest = finest.filter(F.col("n") >= many + 2)
    codes = []
    for t, k, ds, _, own in terms:
        at, stride = F.lit(0).cast("bigint"), 1
        for n in reversed(ds):
            s = max(1, len(network[n].states))
            digit = F.pmod(F.expr(f"code div {stride}L"), F.lit(s))
            stride *= s
            if n in own:
                at = at * F.lit(s) + digit
        codes.append(F.when(F.col("test") == t, F.struct(F.lit(k).alias("model"), at.alias("part"))))
    models = finest.select("test", "n", *[f"v{i}" for i in range(size)], F.inline(F.array_compact(F.array(*codes))))
    summed = models.groupBy("test", "model", "part").agg(F.sum("n").alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(size)])

    layout = {}                       # (test, model): places of its sums and products, and its ridge
    for t, k, ds, cs, own in terms:
        keep = [i for i, c in enumerate(cs) if c in own]
        pairs = {p: len(cs) + i for i, p in enumerate(_pairs(len(cs)))}
        layout[t, k] = keep, [[pairs[min(i, j), max(i, j)] for j in keep] for i in keep], [RIDGE * (spread[cs[i]] or 1.0) for i in keep]

    def loglikelihoods(batches):
        for b in batches:
            test, model, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            v = np.column_stack([b.column(4 + i).to_numpy(zero_copy_only=False) for i in range(size)]) if size else np.zeros((b.num_rows, 0))
            ll = n * np.log(n)
            for (t, k), (keep, pairs, ridge) in layout.items():
                r = np.flatnonzero((test == t) & (model == k))
                if len(r) and keep:
                    mean = v[np.ix_(r, keep)] / n[r, None]
                    cov = v[r][:, np.array(pairs)] / n[r, None, None] - mean[:, :, None] * mean[:, None, :] + np.diag(ridge)
                    ll[r] -= 0.5 * n[r] * np.linalg.slogdet(cov)[1]
            yield pa.RecordBatch.from_pydict({"test": test, "model": model, "ll": ll, "cells": np.ones(len(ll), np.int64)})

    sums = (summed.mapInArrow(loglikelihoods, "test int, model int, ll double, cells long").groupBy("test", "model")
            .agg(F.sum("ll").alias("ll"), F.sum("cells").alias("cells")).collect())
    found = {(r["test"], r["model"]): (r["ll"], r["cells"]) for r in sums}
    out = []
    for t in range(len(tests)):
        ll, free = 0.0, 0
        for k, sign in enumerate((1, 1, -1, -1)):
            value, n_cells = found.get((t, k), (0.0, 0))
            d = len(layout[t, k][0])
            ll += sign * value
            free += sign * n_cells * (1 + d + d * (d + 1) // 2)
        out.append((max(2 * ll, 0.0), int(free)))
    return out


def independence(df: DataFrame, discrete, continuous, tests) -> DataFrame:
    """`a, b, given, g2, df, p` of each (a, b, given) by the conditional-Gaussian likelihood ratio."""
    found = likelihood_ratios(folded(df, discrete, continuous), discrete, continuous, tests)
    rows = [(a, b, ",".join(g), float(s), free, float(chi_square_p(s, free))) for (a, b, g), (s, free) in zip(tests, found)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, given string, g2 double, df int, p double")


def mixed_pc(df: DataFrame, discrete, continuous, *, alpha: float = 0.05, max_given: int = 2) -> list[tuple[str, str]]:
    """PC over columns of both kinds: G2 where all columns of a test are discrete, Fisher's z where all are
    continuous, the likelihood ratio otherwise. Links run from discrete to continuous columns."""
    names = [*discrete, *continuous]
    known = folded(df, discrete, continuous)
    n, corr = correlation_matrix(df, continuous)
    adjacent = {frozenset(p) for p in combinations(names, 2)}
    separators: dict[frozenset, tuple[str, ...]] = {}
    counted = known[0].groupBy(*[quoted(c) for c in discrete]).agg(F.sum("n").alias("n"))
    for level in range(max_given + 1):
        tests = []
        for pair in sorted(tuple(sorted(p, key=names.index)) for p in adjacent):
            a, b = pair
            near = {o for x in (a, b) for o in names if o not in pair and frozenset((x, o)) in adjacent}
            tests += [(a, b, g) for g in combinations(sorted(near, key=names.index), level)]
        if not tests:
            break
        kind = [len({c in continuous for c in (a, b, *g)}) > 1 and "mixed" or ("continuous" if a in continuous else "discrete") for a, b, g in tests]
        p = {}
        only = [i for i, k in enumerate(kind) if k == "discrete"]
        p |= {only[i]: v for i, v in refuted_by_counts(counted, known[1], [tests[i] for i in only]).items()}
        mixed = [i for i, k in enumerate(kind) if k == "mixed"]
        p |= {i: chi_square_p(*s) for i, s in zip(mixed, likelihood_ratios(known, discrete, continuous, [tests[i] for i in mixed]))}
        for i, (a, b, g) in enumerate(tests):
            if kind[i] == "continuous":
                r = partial_correlation(corr, continuous.index(a), continuous.index(b), [continuous.index(x) for x in g])
                p[i] = fisher_z_p(r, n, len(g))
        for i, (a, b, g) in enumerate(tests):
            pair = frozenset((a, b))
            if pair in adjacent and p.get(i, 1.0) > alpha:
                adjacent.discard(pair)
                separators[pair] = g
    fixed = {(a, b) for a in discrete for b in continuous if frozenset((a, b)) in adjacent}
    return orient(names, adjacent, separators, fixed)
