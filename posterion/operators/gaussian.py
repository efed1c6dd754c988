"""Log-density and conditional expressions of linear-Gaussian groups of columns."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from posterion.functions.scalars import lookup, normal_log_density
from posterion.plans.network import Network

MAX_PATTERN_COLUMNS = 4      # columns of one group whose null patterns are written out


class NoExpression(ValueError):
    """The question has no column expression of reasonable size; `inference` answers it."""


def components(network: Network) -> list[tuple[str, ...]]:
    """Continuous variables grouped by links between them and by shared nodes."""
    group = {n: {n} for n in network.names("continuous")}
    ties = [(p, c) for p, c in network.edges if p in group and c in group]
    ties += [(b[0], m) for b in network.blocks for m in b[1:]]
    for a, b in ties:
        merged = group[a] | group[b]
        for n in merged:
            group[n] = merged
    seen, result = set(), []
    for n in network.names("continuous"):
        if n not in seen:
            seen |= group[n]
            result.append(tuple(m for m in network.order() if m in group[n]))
    return result


def discrete_parents_of(network: Network, members) -> list[str]:
    return sorted({p for m in members for p in network.discrete_parents(m)})


def _log_constant(cov: np.ndarray) -> float:
    sign, logdet = np.linalg.slogdet(cov)
    return -0.5 * (len(cov) * math.log(2 * math.pi) + logdet) if sign > 0 else -math.inf


def _quadratic(x: list[Column], mean: np.ndarray, cov: np.ndarray) -> Column:
    precision = np.linalg.inv(cov)
    dev = [c - F.lit(float(m)) for c, m in zip(x, mean)]
    total = None
    for i in range(len(dev)):
        for j in range(i, len(dev)):
            coef = float(precision[i, j]) * (1.0 if i == j else 2.0)
            term = F.lit(coef) * dev[i] * dev[j]
            total = term if total is None else total + term
    return F.lit(_log_constant(cov)) - F.lit(0.5) * total


def _stable(cov: np.ndarray) -> np.ndarray:
    cov = (cov + cov.T) / 2
    while np.linalg.slogdet(cov)[0] <= 0:
        cov = cov + np.eye(len(cov)) * max(1e-9, 1e-9 * float(np.trace(cov)))
    return cov


def log_density(x: dict[str, Column], joint) -> Column:
    """ln density of the present columns of a group; absent ones are marginalised."""
    if joint is None:
        return F.lit(-math.inf)
    order, mean, cov = joint
    if len(order) == 1:
        v = x[order[0]]
        return F.coalesce(normal_log_density(v, F.lit(float(mean[0])), F.lit(float(cov[0, 0]))), F.lit(0.0))
    if len(order) > MAX_PATTERN_COLUMNS:
        return _pattern_udf(order, mean, cov)(*[x[n] for n in order])
    expr = F.lit(0.0)
    for size in range(1, len(order) + 1):
        for keep in combinations(range(len(order)), size):
            present = F.lit(True)
            for i in keep:
                present = present & x[order[i]].isNotNull()
            ix = list(keep)
            expr = F.when(present, _quadratic([x[order[i]] for i in ix], mean[ix], _stable(cov[np.ix_(ix, ix)]))).otherwise(expr)
    return expr


def _pattern_udf(order, mean, cov):
    """Wide groups: numpy per null pattern inside Arrow batches."""
    @F.pandas_udf("double")
    def density(*cols: pd.Series) -> pd.Series:
        data = np.column_stack([c.to_numpy(dtype=float) for c in cols])
        present = ~np.isnan(data)
        out = np.zeros(len(data))
        for pattern in np.unique(present, axis=0):
            rows = (present == pattern).all(axis=1)
            ix = np.flatnonzero(pattern)
            if len(ix):
                part = _stable(cov[np.ix_(ix, ix)])
                dev = data[np.ix_(rows, ix)] - mean[ix]
                out[rows] = _log_constant(part) - 0.5 * np.einsum("ni,ij,nj->n", dev, np.linalg.inv(part), dev)
        return pd.Series(out)
    return density


def conditional_moments(target: str, x: dict[str, Column], joint) -> tuple[Column, Column]:
    """Mean and variance of one column given the present others of its group."""
    if joint is None:
        return F.lit(None).cast("double"), F.lit(None).cast("double")
    order, mean, cov = joint
    t = order.index(target)
    m, v = F.lit(float(mean[t])), F.lit(float(cov[t, t]))
    others = [i for i in range(len(order)) if i != t and abs(cov[t, i]) > 0]
    if len(others) > MAX_PATTERN_COLUMNS:
        raise NoExpression(f"mean/variance of {target}: more than {MAX_PATTERN_COLUMNS} dependent columns in its group")
    for size in range(1, len(others) + 1):
        for keep in combinations(others, size):
            ix = list(keep)
            beta = np.linalg.solve(_stable(cov[np.ix_(ix, ix)]), cov[ix, t])
            present = F.lit(True)
            pred = F.lit(float(mean[t]))
            for b, i in zip(beta, ix):
                present = present & x[order[i]].isNotNull()
                pred = pred + F.lit(float(b)) * (x[order[i]] - F.lit(float(mean[i])))
            m = F.when(present, pred).otherwise(m)
            v = F.when(present, F.lit(float(cov[t, t] - beta @ cov[ix, t]))).otherwise(v)
    return m, v


def indexed_moments(joints: list, index: Column) -> tuple[Column, Column]:
    """Mean and variance of a single column looked up by parent combination."""
    if len(joints) == 1:
        j = joints[0]
        return (F.lit(float(j[1][0])), F.lit(float(j[2][0, 0]))) if j is not None else (
            F.lit(None).cast("double"), F.lit(None).cast("double"))
    means = [j[1][0] if j is not None else math.nan for j in joints]
    variances = [j[2][0, 0] if j is not None else math.nan for j in joints]
    return F.nanvl(lookup(means, index), F.lit(None)), F.nanvl(lookup(variances, index), F.lit(None))
