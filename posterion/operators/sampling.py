"""Q16: synthetic tables drawn from a network, reproducible per row id."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from posterion.functions.scalars import hash_normal, hash_uniform, lookup, quoted
from posterion.operators.gaussian import _stable
from posterion.operators.junction import Engine, log_sum
from posterion.plans.model import Model


def sample(ids: DataFrame, model: Model, *, id_col: str, seed=0, evidence: dict | None = None) -> DataFrame:
    """One sample per id: `id` and one column per observed variable.

    Every draw is a hash of (id, variable, seed) put through the inverse distribution, so rows
    are independent, repeatable, and need no shuffle. Without evidence variables are drawn parents
    first. With evidence (states and values, on columns of either kind) a junction tree is collected once,
    and variables are drawn from its roots downwards, each given what its bucket has drawn before
    (forward filtering, backward sampling); continuous ones follow from their Gaussian parts.
    Tables are as large as the buckets, whatever the number of hidden columns.
    """
    evidence = dict(evidence or {})
    names = model.network.names()
    position = {n: i for i, n in enumerate(names)}
    discrete, parts = _given(model, evidence) if evidence else _ancestral(model)
    index: dict[str, Column] = {}
    df = ids.select(quoted(id_col))
    for n, s in evidence.items():
        if model.network[n].kind == "discrete":
            df = df.withColumn(f"__i{position[n]}", F.lit(model.network[n].states.index(str(s))))
            index[n] = F.col(f"__i{position[n]}")
    for n, given, rows in discrete:
        combo = F.lit(0)
        for p in given:
            combo = combo * F.lit(len(model.network[p].states)) + index[p]
        df = df.withColumn("__u", hash_uniform(quoted(id_col), f"{seed}:{n}")).withColumn("__c", combo)
        df = df.withColumn(f"__i{position[n]}", _inverse(rows, F.col("__u"), F.col("__c"))).drop("__u", "__c")
        index[n] = F.col(f"__i{position[n]}")
    values: dict[str, Column] = {n: F.lit(float(v)) for n, v in evidence.items() if model.network[n].kind == "continuous"}
    for part in parts:
        combo = F.lit(0)
        for p in part.parents:
            combo = combo * F.lit(len(model.network[p].states)) + index[p]
        noise = [hash_normal(quoted(id_col), f"{seed}:{m}") for m in part.names]
        for a, m in enumerate(part.names):
            expr = lookup(part.mean[:, a], combo)
            for b, p in enumerate(part.linked):
                expr = expr + lookup(part.links[:, a, b], combo) * values[p]
            for b in range(a + 1):
                expr = expr + lookup(part.lower[:, a, b], combo) * noise[b]
            df = df.withColumn(f"__v{position[m]}", expr)
            values[m] = F.col(f"__v{position[m]}")
    out = []
    for v in model.network.variables:
        if v.latent:
            continue
        if v.kind == "discrete":
            out.append(F.get(F.array(*[F.lit(s) for s in v.states]), index[v.name]).alias(v.name))
        else:
            out.append(F.nanvl(values[v.name], F.lit(None)).alias(v.name))
    return df.select(quoted(id_col), *out)


def _inverse(rows, u: Column, combo: Column) -> Column:
    """The state whose share of [0, 1) holds u, in the row of the combination; states of probability 0 are never taken."""
    n = len(rows[0])
    last = [max((s for s in range(n) if r[s] > 0), default=n - 1) for r in rows]
    pick = lookup(last, combo).cast("int")
    running = np.cumsum(np.array(rows, float), axis=1)
    for s in range(n - 2, -1, -1):
        pick = F.when(u < lookup(running[:, s], combo), F.lit(s)).otherwise(pick)
    return pick


@dataclass(frozen=True)
class Drawn:
    """Continuous variables drawn together: means, links to values drawn before, and the lower triangle of the
    covariance, by combination of the discrete parents."""
    names: list[str]
    parents: list[str]
    linked: list[str]
    mean: np.ndarray
    links: np.ndarray
    lower: np.ndarray


def _ancestral(model: Model):
    """Tables of all discrete nodes and Gaussians of all continuous ones, parents first."""
    net = model.network
    discrete = [(n, net.parents(n), [list(r) for r in model.dense(n)]) for n in net.order() if net[n].kind == "discrete"]
    parts, done = [], set()
    for n in net.order():
        if net[n].kind != "continuous" or n in done:
            continue
        group, parents, linked = list(net.members(n)), net.discrete_parents(n), net.continuous_parents(n)
        done |= set(group)
        found = [model.conditional(group[0], c) for c in model.combos(parents)]
        d, k = len(group), len(linked)
        mean = np.array([f[0] if f else np.full(d, math.nan) for f in found]).reshape(len(found), d)
        links = np.array([f[1] if f else np.zeros((d, k)) for f in found]).reshape(len(found), d, k)
        parts.append(Drawn(group, parents, linked, mean, links, np.array([_lower(f[2]) if f else np.zeros((d, d)) for f in found])))
    return discrete, parts


def _given(model: Model, evidence: dict):
    """Tables of the hidden discrete variables given those drawn before and all evidence, and the hidden Gaussian parts."""
    net = model.network
    data = {}
    for n, v in evidence.items():
        if net[n].kind == "discrete" and str(v) not in net[n].states:
            raise ValueError(f"{n} has no state {v}")
        data[n] = np.array([float(net[n].states.index(str(v)) if net[n].kind == "discrete" else v)])
    engine = Engine(model)
    pattern = engine.pattern(frozenset(data), whole=True)
    answers = pattern.run(data, 1)
    if not np.isfinite(answers.loglikelihood[0]):
        raise ValueError("the evidence is impossible under the model")
    discrete = []
    for i in reversed(range(len(pattern.tree.order))):
        table = answers.beliefs.collected(i)[0]                     # ln of the bucket: its own variable first, then those above
        with np.errstate(invalid="ignore"):
            share = np.nan_to_num(np.exp(table - log_sum(table, (0,))))
        v, *above = pattern.tree.cliques[i]
        discrete.append((v, above, np.moveaxis(share, 0, -1).reshape(-1, engine.cards[v]).tolist()))
    parts = []
    for x in pattern.parts:
        if x.hidden:
            free = pattern.free(x.parents)
            mean, known, at = x.conditional(free, data, 1)
            mean = np.where(known[0][:, None], mean[0], math.nan)
            d = len(x.hidden)
            lower = np.array([_lower(x.spread[k]) if ok else np.zeros((d, d)) for k, ok in zip(at[0], known[0])])
            parts.append(Drawn(x.hidden, list(free), [], mean, np.zeros((len(mean), d, 0)), lower))
    return discrete, parts


def _lower(cov) -> np.ndarray:
    return np.linalg.cholesky(_stable(np.asarray(cov)))
