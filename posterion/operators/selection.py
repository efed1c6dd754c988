"""Variable selection: all subsets and folds are scored from one fit and one scan per chunk."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from posterion.functions.scalars import as_double, quoted, state_index
from posterion.operators.gaussian import discrete_parents_of
from posterion.operators.score import _Plan, encode
from posterion.operators.validate import FOLD, fit_folds
from posterion.plans.templates import naive_bayes

SUBSET_CHUNK = 60            # subsets scored by one scan


def univariate(variables) -> list[tuple[str, ...]]:
    """Each variable alone."""
    return [(v,) for v in variables]


def subsets(variables, n: int = 2) -> list[tuple[str, ...]]:
    """Every set of n variables."""
    variables = list(variables)
    if n > len(variables):
        raise ValueError("n may not exceed the number of variables")
    return list(combinations(variables, n))


def leave_some_out(variables, some: int = 1) -> list[tuple[str, ...]]:
    """All but a window of `some` variables, wrapping round."""
    variables = list(variables)
    if some > len(variables):
        raise ValueError("some may not exceed the number of variables")
    result = []
    for i in range(len(variables)):
        gone = {variables[(i + j) % len(variables)] for j in range(some)}
        result.append(tuple(v for v in variables if v not in gone))
    return result


def forward_first(ordering) -> list[tuple[str, ...]]:
    """Growing prefixes of an ordering."""
    ordering = list(ordering)
    return [tuple(ordering[:i]) for i in range(1, len(ordering) + 1)]


def back_first(ordering) -> list[tuple[str, ...]]:
    """Growing suffixes of an ordering."""
    ordering = list(ordering)
    return [tuple(ordering[-i:]) for i in range(1, len(ordering) + 1)]


def key_of(subset) -> str:
    return ",".join(subset)


def pick_variables(df: DataFrame, target: str, chosen, *, discrete=(), continuous=(), k: int = 3,
                   fold: str = FOLD) -> DataFrame:
    """`subset, fold, score`: held-out naive-Bayes accuracy of every subset.

    The naive-Bayes log terms of a variable do not depend on the others, so one fit over all
    features serves every subset: a subset's score is the sum of its terms.
    """
    chosen = list(dict.fromkeys(tuple(s) for s in chosen))
    rows = df.filter(quoted(target).isNotNull())
    model = fit_folds(rows, naive_bayes(target, discrete=discrete, continuous=continuous), k, fold=fold)
    index, x, inputs = encode(rows, model)
    plan = _Plan(model, target, index, x, "w")
    net = model.network
    used = sorted({v for s in chosen for v in s})
    prior = plan._stage("prior", [plan.prior(i) for i in range(plan.K)])
    terms = {}
    for n, v in enumerate(used):
        cols = [plan.discrete_term(v, i) if net[v].kind == "discrete" else plan.gaussian_term((v,), i) for i in range(plan.K)]
        terms[v] = plan._stage(f"t{n}", cols)
    base = rows.select("*", *inputs)
    for stage in plan.staged:
        base = base.select("*", *stage)
    result = None
    for start in range(0, len(chosen), SUBSET_CHUNK):
        aggs = []
        for i, s in enumerate(chosen[start:start + SUBSET_CHUNK]):
            score = [sum((terms[v][c] for v in s), prior[c]) for c in range(plan.K)]
            top = F.greatest(*score) if plan.K > 1 else score[0]
            best = None
            for c in range(plan.K):
                best = F.when(score[c] == top, F.lit(c)) if best is None else best.when(score[c] == top, F.lit(c))
            aggs.append(F.avg((best == index[target]).cast("double")).alias(f"s{i}"))
        wide = base.groupBy(quoted(fold).alias("fold")).agg(*aggs)
        pairs = F.array(*[F.struct(F.lit(key_of(s)).alias("subset"), F.col(f"s{i}").alias("score"))
                          for i, s in enumerate(chosen[start:start + SUBSET_CHUNK])])
        part = wide.select("fold", F.explode(pairs).alias("p")).select("p.subset", "fold", "p.score")
        result = part if result is None else result.unionByName(part)
    return result


def pick_regressors(df: DataFrame, target: str, chosen, *, k: int = 3, fold: str = FOLD) -> DataFrame:
    """W5 for a continuous target: `subset, fold, score` with the held-out r2 of a linear fit.

    Fits and held-out squared errors both follow from the cross-products per fold, so the
    table is read once whatever the number of subsets.
    """
    chosen = list(dict.fromkeys(tuple(s) for s in chosen))
    names = sorted({v for s in chosen for v in s})
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = [*names, target]
    base = df.select(quoted(fold).alias("fold"), *[as_double(quoted(c), fields[c]).alias(f"x{i}") for i, c in enumerate(cols)]).dropna()
    means = base.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(cols))]).head()
    v = [F.lit(1.0)] + [F.col(f"x{i}") - F.lit(means[f"m{i}"]) for i in range(len(cols))]
    aggs = [F.sum(v[i] * v[j]).alias(f"q{i}_{j}") for i in range(len(v)) for j in range(i, len(v))]
    cross = {}
    for r in base.groupBy("fold").agg(*aggs).collect():
        cross[r["fold"]] = np.array([[r[f"q{min(i, j)}_{max(i, j)}"] for j in range(len(v))] for i in range(len(v))])
    total = sum(cross.values())
    out = []
    for f, own in cross.items():
        train, y = total - own, len(v) - 1
        for s in chosen:
            ix = [0] + [1 + names.index(n) for n in s]
            beta = np.linalg.lstsq(train[np.ix_(ix, ix)], train[ix, y], rcond=None)[0]
            sse = own[y, y] - 2 * beta @ own[ix, y] + beta @ own[np.ix_(ix, ix)] @ beta
            sst = own[y, y] - own[0, y] ** 2 / own[0, 0]
            out.append((key_of(s), int(f), float(1 - sse / sst) if sst > 0 else None))
    return df.sparkSession.createDataFrame(out, "subset string, fold int, score double")


def summarise_variables(results: DataFrame) -> DataFrame:
    """Mean score per subset, summed over the subsets a variable belongs to."""
    means = results.groupBy("subset").agg(F.avg("score").alias("score"))
    return (means.select(F.explode(F.split("subset", ",")).alias("variable"), "score")
            .groupBy("variable").agg(F.sum("score").alias("score")))


def best_combinations(results: DataFrame) -> DataFrame:
    """Mean score per subset, best first."""
    return results.groupBy("subset").agg(F.avg("score").alias("score")).orderBy(F.desc("score"), "subset")
