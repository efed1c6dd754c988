"""Structure learning: counts come from Spark, one job per batch of tests; the driver only
holds the small list of scores and the graph."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from posterion.functions.scalars import as_double, quoted, state_index
from posterion.operators.fit import discover
from posterion.plans.network import Network, would_cycle
from posterion.plans.templates import independent
from posterion.sources.storage import reused

TEST_BATCH = 200             # tests counted by one job


def _cells(df: DataFrame, columns, extra=()) -> tuple[DataFrame, Network]:
    """Combinations of state positions with their count `n`, and the network that names the
    states. The table is read once and folded to distinct values; the states and every later
    count come from the written combinations, however many rows there are."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = list(dict.fromkeys((*columns, *extra)))
    folded = reused(df.groupBy(*[quoted(c) for c in names]).agg(F.count(F.lit(1)).alias("__n")))
    network, _ = discover(folded, independent(discrete=columns))
    return folded.select(*[state_index(quoted(c), network[c].states, fields[c]).alias(c) for c in columns],
                         *[quoted(e) for e in extra], F.col("__n").alias("n")), network


def _radix(network: Network, columns):
    z = F.lit(0).cast("bigint")
    for c in columns:
        z = z * F.lit(len(network[c].states)) + quoted(c)
    return z


def contingency(cells: DataFrame, network: Network, tests) -> DataFrame:
    """Counts `test, x, y, z, n` (state positions) of several (a, b, given) triples from one pass;
    rows with a missing value in a triple are left out of it.

    Each combination yields one packed number per test, so the shuffle carries partial counts of
    a test and a bigint. A test is refused only if its own grid has 2^62 cells or more.
    """
    sizes = [(len(network[a].states), len(network[b].states)) for a, b, _ in tests]
    codes = []
    for i, ((a, b, given), (sx, sy)) in enumerate(zip(tests, sizes)):
        if max(sx, 1) * max(sy, 1) * network.grid_size(given) >= 2 ** 62:
            raise ValueError(f"the states of {[a, b, *given]} have too many combinations to test")
        x, y = quoted(a).cast("bigint"), quoted(b).cast("bigint")
        code = x + F.lit(sx).cast("bigint") * (y + F.lit(sy).cast("bigint") * _radix(network, given))
        codes.append(F.struct(F.lit(i).alias("test"), code.alias("code")))
    counts = (cells.select("n", F.inline(F.array(*codes))).filter(F.col("code").isNotNull())
              .groupBy("test", "code").agg(F.sum("n").alias("n")))
    sx, sy = (F.element_at(F.array(*[F.lit(max(s[k], 1)).cast("bigint") for s in sizes]), F.col("test") + 1) for k in (0, 1))
    wide = counts.select("test", "n", "code", sx.alias("sx"), sy.alias("sy"))
    return wide.select("test", F.expr("code % sx").alias("x"), F.expr("(code div sx) % sy").alias("y"),
                       F.expr("code div sx div sy").alias("z"), "n")


def information(counts: DataFrame) -> DataFrame:
    """`test, total, mi, g2, nx, ny, nz`: (conditional) mutual information and G2 per test.

    With m ln m summed over the cells and over their margins, G2 is twice (cells + z - xz - yz).
    All margins are counted by one grouping; only their partial sums meet by test.
    """
    sets = [("test", "x", "y", "z"), ("test", "x", "z"), ("test", "y", "z"), ("test", "z"), ("test", "x"), ("test", "y")]
    margins = counts.groupingSets([tuple(F.col(c) for c in s) for s in sets], "test", "x", "y", "z").agg(
        F.sum("n").cast("double").alias("m"), F.grouping_id().alias("g"))
    level = {s: sum(1 << i for i, c in enumerate("zyx") if c not in s) for s in sets}
    weight = F.col("m") * F.ln("m")

    def summed(*s):
        return F.coalesce(F.sum(F.when(F.col("g") == level["test", *s], weight)), F.lit(0.0))

    half = summed("x", "y", "z") + summed("z") - summed("x", "z") - summed("y", "z")
    sums = margins.groupBy("test").agg(
        F.sum(F.when(F.col("g") == level["test", "z"], F.col("m"))).alias("total"), F.greatest(half, F.lit(0.0)).alias("half"),
        *[F.count_if(F.col("g") == level["test", c]).alias(f"n{c}") for c in ("x", "y", "z")])
    return sums.select("test", "total", (F.col("half") / F.col("total")).alias("mi"), (F.lit(2.0) * F.col("half")).alias("g2"), "nx", "ny", "nz")


def mutual_information(df: DataFrame, columns, *, pairs=None, given: str | None = None, known=None) -> DataFrame:
    """G1: `a, b, mi, g2, df` of every pair, or `a, b, c, cmi, g2, df` given one column; `known`
    are combinations and network that were counted before."""
    columns = list(columns)
    pairs = list(pairs or combinations([c for c in columns if c != given], 2))
    cells, network = known or _cells(df, columns)
    tests = [(a, b, (given,) if given else ()) for a, b in pairs]
    info = None
    for start in range(0, len(tests), TEST_BATCH):
        batch = information(contingency(cells, network, tests[start:start + TEST_BATCH])).withColumn("test", F.col("test") + start)
        info = batch if info is None else info.unionByName(batch)
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "test int, a string, b string")
    free = ((F.col("nx") - 1) * (F.col("ny") - 1) * F.col("nz")).cast("bigint").alias("df")
    joined = names.join(info, "test")
    if given:
        return joined.select("a", "b", F.lit(given).alias("c"), F.col("mi").alias("cmi"), "g2", free)
    return joined.select("a", "b", "mi", "g2", free)


def chi_square_p(g2: float, free: int) -> float:
    """Upper tail probability by the Wilson-Hilferty normal approximation."""
    if free <= 0:
        return 1.0
    z = ((max(g2, 0.0) / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    return 0.5 * math.erfc(z / math.sqrt(2))


def fisher_z_p(r: float, n: float, given: int) -> float:
    """Two-sided p-value of a (partial) correlation by Fisher's z."""
    if n - given - 3 <= 0:
        return 1.0
    r = min(max(r, -0.9999999), 0.9999999)
    return math.erfc(math.sqrt(n - given - 3) * abs(math.atanh(r)) / math.sqrt(2))


def partial_correlation(corr: np.ndarray, i: int, j: int, given) -> float:
    ix = [i, j, *given]
    inv = np.linalg.pinv(corr[np.ix_(ix, ix)])
    return float(-inv[0, 1] / math.sqrt(inv[0, 0] * inv[1, 1]))


def correlation_matrix(df: DataFrame, columns) -> tuple[float, np.ndarray]:
    """Number of complete rows and all pairwise correlations, from one aggregate."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    values = df.select(*[as_double(quoted(c), fields[c]).alias(f"x{i}") for i, c in enumerate(columns)]).dropna()
    aggs = [F.corr(f"x{i}", f"x{j}").alias(f"r{i}_{j}") for i, j in combinations(range(len(columns)), 2)]
    row = values.agg(F.count(F.lit(1)).alias("n"), *aggs).head()
    corr = np.eye(len(columns))
    for i, j in combinations(range(len(columns)), 2):
        corr[i, j] = corr[j, i] = row[f"r{i}_{j}"] or 0.0
    return float(row["n"]), corr


def learn_pc(df: DataFrame, *, discrete=(), continuous=(), alpha: float = 0.05, max_given: int = 2) -> list[tuple[str, str]]:
    """PC with G2 tests (all-discrete), Fisher-z tests (all-continuous), or both and likelihood ratios
    of conditional Gaussians (`mixed`) where columns of both kinds are given.

    Every level is one batched counting job; edges removed at one level shrink the next.
    """
    if discrete and continuous:
        from posterion.operators.mixed import mixed_pc
        return mixed_pc(df, list(discrete), list(continuous), alpha=alpha, max_given=max_given)
    names = list(discrete or continuous)
    if discrete:
        cells, network = _cells(df, names)
    else:
        n, corr = correlation_matrix(df, names)
    adjacent = {frozenset(p) for p in combinations(names, 2)}
    separators: dict[frozenset, tuple[str, ...]] = {}
    for level in range(max_given + 1):
        tests = []
        for pair in sorted(tuple(sorted(p, key=names.index)) for p in adjacent):
            a, b = pair
            near = {o for x in (a, b) for o in names if o not in pair and frozenset((x, o)) in adjacent}
            tests += [(a, b, g) for g in combinations(sorted(near, key=names.index), level)]
        if not tests:
            break
        results = {}
        if discrete:
            results = refuted_by_counts(cells, network, tests)
        else:
            for i, (a, b, g) in enumerate(tests):
                r = partial_correlation(corr, names.index(a), names.index(b), [names.index(x) for x in g])
                results[i] = fisher_z_p(r, n, len(g))
        for i, (a, b, g) in enumerate(tests):
            pair = frozenset((a, b))
            if pair in adjacent and results.get(i, 1.0) > alpha:
                adjacent.discard(pair)
                separators[pair] = g
    return orient(names, adjacent, separators)


def refuted_by_counts(cells: DataFrame, network: Network, tests) -> dict[int, float]:
    """p-value of each discrete test that has any rows."""
    results = {}
    for start in range(0, len(tests), TEST_BATCH):
        for r in information(contingency(cells, network, tests[start:start + TEST_BATCH])).collect():
            results[start + r["test"]] = chi_square_p(r["g2"], (r["nx"] - 1) * (r["ny"] - 1) * r["nz"])
    return results


def orient(names, adjacent, separators, fixed=()) -> list[tuple[str, str]]:
    """Colliders first, then the three propagation rules; what stays open follows column order.
    `fixed` links have their direction from the start."""
    directed: set[tuple[str, str]] = set(fixed)

    def linked(a, b):
        return frozenset((a, b)) in adjacent

    def open_pair(a, b):
        return linked(a, b) and (a, b) not in directed and (b, a) not in directed

    for b in names:
        for a, c in combinations([x for x in names if x != b and linked(x, b)], 2):
            if not linked(a, c) and b not in separators.get(frozenset((a, c)), ()):
                for s in (a, c):
                    if (b, s) not in directed and not would_cycle(directed, s, b):
                        directed.add((s, b))
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in names:
                if a == b or not open_pair(a, b):
                    continue
                chain = any((c, a) in directed and not linked(c, b) for c in names)
                triangle = any((a, c) in directed and (c, b) in directed for c in names)
                fork = any(open_pair(a, c) and open_pair(a, d) and (c, b) in directed and (d, b) in directed
                           and not linked(c, d) for c, d in combinations([x for x in names if x not in (a, b)], 2))
                if (chain or triangle or fork) and not would_cycle(directed, a, b):
                    directed.add((a, b))
                    changed = True
    for a, b in combinations(names, 2):
        if open_pair(a, b):
            directed.add((a, b) if not would_cycle(directed, a, b) else (b, a))
    return sorted(directed)


def learn_tan(df: DataFrame, target: str, features) -> list[tuple[str, str]]:
    """Maximum spanning tree over conditional mutual information given the class, directed
    away from the first feature; the class is a parent of every feature."""
    features = list(features)
    weights = {(r["a"], r["b"]): r["cmi"] for r in
               mutual_information(df.filter(quoted(target).isNotNull()), [target, *features], given=target).collect()}
    group = {f: {f} for f in features}
    tree = []
    for (a, b), _ in sorted(weights.items(), key=lambda e: (-e[1], e[0])):
        if group[a] is not group[b]:
            tree.append((a, b))
            merged = group[a] | group[b]
            for f in merged:
                group[f] = merged
    links, reached = [(target, f) for f in features], [features[0]] if features else []
    while len(reached) < len(features):
        for a, b in tree:
            for p, c in ((a, b), (b, a)):
                if p in reached and c not in reached:
                    links.append((p, c))
                    reached.append(c)
    return links


def learn_greedy(df: DataFrame, columns, *, fold: str, k: int, max_parents: int | None = None, candidates: int = 30,
                 alpha: float = 1.0) -> list[tuple[str, str]]:
    """Links in order of pairwise mutual information, each kept while it raises the held-out
    loglikelihood of its child over k folds. The direction follows column order. The held-out
    loglikelihood alone ends the growth of a family; `max_parents` is a limit the caller may state.

    One counting job scores all candidates of a round against the present parents.
    """
    columns = list(columns)
    cells, states = _cells(df, columns, extra=(fold,))
    ranked = sorted(((r["mi"], r["a"], r["b"]) for r in mutual_information(df, columns, known=(cells, states)).collect()), key=lambda t: (-t[0], t[1:]))
    todo = [(a, b) for _, a, b in ranked]
    parents: dict[str, tuple[str, ...]] = {c: () for c in columns}
    base = _family_scores(cells, [(c, ()) for c in columns], states, fold, k, alpha)
    score = {c: base[c, ()] for c in columns}
    while todo:
        round_, todo = todo[:candidates], todo[candidates:]
        wave = list(round_)
        while wave:
            trials = {(a, b): tuple(sorted(parents[b] + (a,))) for a, b in wave
                      if (max_parents is None or len(parents[b]) < max_parents) and not would_cycle([(p, c) for c in columns for p in parents[c]], a, b)}
            if not trials:
                break
            # a later link into a child already extended in this wave is tested again next wave
            got = _family_scores(cells, [(b, ps) for (a, b), ps in trials.items()], states, fold, k, alpha)
            touched, again = set(), []
            for a, b in wave:
                if (a, b) not in trials:
                    continue
                if b in touched:
                    again.append((a, b))
                elif got[b, trials[a, b]] > score[b] + 1e-9 and not would_cycle(
                        [(p, c) for c in columns for p in parents[c]], a, b):
                    parents[b], score[b] = trials[a, b], got[b, trials[a, b]]
                    touched.add(b)
            wave = again
    return sorted((p, c) for c in columns for p in parents[c])


def _family_scores(cells: DataFrame, families, network: Network, fold: str, k: int, alpha: float) -> dict:
    """Held-out loglikelihood of each (child, parents) family, from one grouped count."""
    parts = []
    for i, (c, ps) in enumerate(families):
        ok = quoted(c).isNotNull()
        for p in ps:
            ok = ok & quoted(p).isNotNull()
        key = _radix(network, ps)
        parts.append(F.when(ok, F.struct(F.lit(i).alias("family"), key.alias("key"), quoted(c).alias("state"))))
    long = cells.select("n", quoted(fold).alias("f"), F.explode(F.array_compact(F.array(*parts))).alias("t")).select("t.*", "n", "f")
    counts = long.groupBy("family", "key", "state", "f").agg(F.sum("n").alias("n"))
    cell = Window.partitionBy("family", "key", "state")
    row = Window.partitionBy("family", "key")
    own_row = Window.partitionBy("family", "key", "f")
    sizes = F.element_at(F.array(*[F.lit(len(network[c].states)) for c, _ in families]), F.col("family") + 1)
    other = F.sum("n").over(cell) - F.col("n") + alpha
    total = F.sum("n").over(row) - F.sum("n").over(own_row) + F.lit(alpha) * sizes
    scored = counts.select("family", (F.col("n") * F.ln(other / total)).alias("ll"))
    return {families[r["family"]]: r["ll"] for r in scored.groupBy("family").agg(F.sum("ll").alias("ll")).collect()}


def links_frame(df: DataFrame, links) -> DataFrame:
    return df.sparkSession.createDataFrame(list(links), "parent string, child string")
