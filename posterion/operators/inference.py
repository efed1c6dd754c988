"""Row queries on any network with any gaps (Q1-Q7, Q12): numpy per Arrow batch, in place.

Every row is answered where it lies, so nothing is shuffled, broadcast or joined and the same call
works on a stream. Only the network's columns travel to Python. A batch is reduced to its
distinct rows first where its evidence is discrete, and then split by null pattern (`junction`).
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from posterion.functions.scalars import as_double, cast_state, quoted, state_index
from posterion.operators.junction import Engine, log_sum
from posterion.plans.model import Model


class Request:
    """What the propagations over one set of left-out variables must answer."""

    def __init__(self):
        self.keep: set[str] = set()
        self.heads: list[str] = []


class Batch:
    """Answers of all queries for one batch; each needs the propagations of its own left-out set."""

    def __init__(self, engine: Engine, requests: dict[frozenset, Request], data: dict[str, np.ndarray], rows: int, extra=()):
        self.engine, self.rows, self.data = engine, rows, data
        self.ll: dict[frozenset, np.ndarray] = {}
        self.states: dict[str, np.ndarray] = {}
        self.mean: dict[str, np.ndarray] = {}
        self.variance: dict[str, np.ndarray] = {}
        for gone, request in requests.items():
            ll = self.ll[gone] = np.full(rows, np.nan)
            for v in request.keep:
                self.states[v] = np.full((rows, engine.cards[v]), np.nan)
            for v in request.heads:
                self.mean[v], self.variance[v] = np.full(rows, np.nan), np.full(rows, np.nan)
            for pick, found in engine.runs(data, without=gone, keep=frozenset(request.keep),
                                           scopes=tuple((v,) for v in (*sorted(request.keep), *request.heads)), extra=extra):
                ll[pick] = found.loglikelihood
                for v in request.keep:
                    self.states[v][pick] = found.states(v)
                for v in request.heads:
                    mean, cov = found.moments((v,))
                    self.mean[v][pick], self.variance[v][pick] = mean[:, 0, 0], np.maximum(cov[:, 0, 0, 0], 0.0)
            ll[~np.isfinite(ll)] = np.nan


def prior_marginals(engine: Engine, names) -> dict:
    """Marginals without evidence: state probabilities, or (weights, means, variances) of the parts."""
    out = {}
    for n in names:
        pattern = engine.pattern(frozenset(), frozenset(), ((n,),))
        found = pattern.run({}, 1)
        if engine.net[n].kind == "discrete":
            out[n] = found.states(n)[0]
            continue
        weight, ((x, mean),), ((_, at),), _ = found.mixture((n,))
        i = x.hidden.index(n)
        live = weight[0] > 0
        out[n] = weight[0][live] / weight[0].sum(), mean[0][live, i], x.spread[at[0][live], i, i]
    return out


def _marginal_scores(priors: dict, data: dict[str, np.ndarray], rows: int) -> np.ndarray:
    """Sum of ln P(e_i) over the values of each row."""
    total = np.zeros(rows)
    with np.errstate(divide="ignore"):
        for n, found in priors.items():
            v = data[n]
            here = ~np.isnan(v)
            if isinstance(found, tuple):
                w, m, s = found
                dev = v[here, None] - m
                total[here] += log_sum(np.log(w) - 0.5 * np.log(2 * np.pi * s) - dev * dev / (2 * s), (1,))
            else:
                total[here] += np.log(found)[v[here].astype(int)]
    return np.where(np.isfinite(total), total, np.nan)


def plan_answers(model: Model, queries):
    """(requests, columns): columns are (name, Spark type, function of a Batch, finish) of every answer."""
    from posterion.operators.score import (KLDivergence, LogLikelihood, MeanVariance, ModelStatistics, MostLikelyState, StateProbability,
                                           check_query)
    net, requests, columns = model.network, {}, []
    base = frozenset()

    def request(gone=base) -> Request:
        return requests.setdefault(gone, Request())

    def number(name, of, finish=None):
        columns.append((name, "double", of, finish))

    def mean_of(v):
        gone = frozenset([v])
        if v not in request(gone).heads:
            request(gone).heads.append(v)

    for q in queries:
        check_query(q, net)
        if isinstance(q, ModelStatistics):
            request()
            if q.loglikelihood:
                number("loglikelihood", lambda b: b.ll[base])
            if q.conflict:
                names = [n for n in net.observed() if not net[n].selector]
                number("conflict", lambda b, names=tuple(names): _marginal_scores(b.priors(names), b.data, b.rows) - b.ll[base])
        elif isinstance(q, MostLikelyState):
            request().keep.add(q.variable)

            def best(b, v=q.variable):
                p = b.states[v]
                return np.where(np.isnan(p[:, 0]), np.nan, p.argmax(axis=1))

            def name_state(c: Column, q=q) -> Column:
                text = F.get(F.array(*map(F.lit, net[q.variable].states)), c.cast("int"))
                return cast_state(text, q.dtype) if q.dtype != "string" else text
            number(f"{q.variable}{q.suffix}", best, name_state)
        elif isinstance(q, StateProbability):
            request().keep.add(q.variable)
            states = net[q.variable].states
            for i, s in enumerate(states):
                if q.state is None:
                    number(f"{q.variable}$${s}{q.suffix}", lambda b, v=q.variable, i=i: b.states[v][:, i])
                elif q.state == s:
                    number(f"{q.variable}{q.suffix}", lambda b, v=q.variable, i=i: b.states[v][:, i])
        elif isinstance(q, MeanVariance):
            mean_of(q.variable)

            def value(b, which, q=q):
                seen = b.data[q.variable]
                found = b.mean[q.variable] if which == "mean" else b.variance[q.variable]
                if not q.retract_evidence:
                    found = np.where(np.isnan(seen), found, seen if which == "mean" else 0.0)
                return found

            def default(c: Column, q=q) -> Column:
                return (c if q.default is None else F.coalesce(c, F.lit(q.default))).cast(q.dtype)
            number(f"{q.variable}_mean", partial(value, which="mean"), default)
            number(f"{q.variable}_variance", partial(value, which="variance"), default)
        elif isinstance(q, LogLikelihood):
            rest = frozenset(q.variables)
            request(), request(rest)
            name = f"{':'.join(q.variables)}_{q.column_name}" if q.append_variable_names else q.column_name
            number(name, lambda b, rest=rest: b.ll[base] - b.ll[rest])
        elif isinstance(q, KLDivergence):
            if net[q.a].kind == "discrete":
                request().keep |= {q.a, q.b}

                def divergence(b, q=q):
                    p, r = b.states[q.a], b.states[q.b]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        terms = np.where(p > 0, p * np.log(p / r), 0.0)
                    # a state that only the first can be in makes the divergence infinite: no answer
                    terms = np.where((p > 0) & (r == 0), np.nan, terms).sum(axis=1)
                    return np.where(np.isnan(p[:, 0]) | np.isnan(r[:, 0]), np.nan, terms)
            else:
                mean_of(q.a), mean_of(q.b)

                def divergence(b, q=q):
                    (ma, va), (mb, vb) = (b.mean[q.a], b.variance[q.a]), (b.mean[q.b], b.variance[q.b])
                    with np.errstate(divide="ignore", invalid="ignore"):
                        return 0.5 * np.log(vb / va) + (va + (ma - mb) ** 2) / (2 * vb) - 0.5
            number(f"{q.a}_{q.b}", divergence)
        else:
            raise ValueError(f"unknown query {q!r}")
    return requests, columns


def inputs(df: DataFrame, model: Model, evidence=None) -> dict[str, Column]:
    """Evidence binding for Python: state numbers and values as doubles, by variable."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for v in model.network.variables:
        if v.name in fields and not v.latent and (evidence is None or v.name in evidence):
            c = quoted(v.name)
            out[v.name] = state_index(c, v.states, fields[v.name]).cast("double") if v.kind == "discrete" else as_double(c, fields[v.name])
    return out


def to_arrays(model: Model, names, columns) -> dict[str, np.ndarray]:
    """Arrays of every variable; those without a column are gaps."""
    given = {n: c.to_numpy(dtype=float) for n, c in zip(names, columns)}
    rows = len(columns[0])
    return {v.name: given.get(v.name, np.full(rows, np.nan)) for v in model.network.variables}


def score_rows(df: DataFrame, model: Model, queries, *, id_col: str | None = None, evidence=None, append: bool = True) -> DataFrame:
    """The answers of all queries as columns, whatever the network and the gaps of each row."""
    bound = inputs(df, model, evidence)
    names = list(bound)
    requests, columns = plan_answers(model, queries)
    taken = [c[0] for c in columns]
    if len(set(taken)) != len(taken):
        raise ValueError(f"two queries write the same column: {taken}")
    discrete = all(model.network[n].kind == "discrete" for n in names)
    schema = ", ".join(f"a{i} {kind}" for i, (_, kind, _, _) in enumerate(columns))
    held: list = []                  # the engine is made once in each task

    @F.pandas_udf(schema)
    def answer(*cols: pd.Series) -> pd.DataFrame:
        if not held:
            engine = Engine(model)
            held.extend([engine, {}])
        engine, marginals = held
        data, back = to_arrays(model, names, cols), None
        rows = len(cols[0])
        if discrete and rows:
            # mixed-radix number of the evidence of a row; -1 for a gap
            code = np.zeros(rows, np.float64)
            for n in names:
                code = code * (engine.cards[n] + 1) + np.nan_to_num(data[n], nan=-1) + 1
            if math.prod(engine.cards[n] + 1 for n in names) < 1 << 53:
                _, first, back = np.unique(code, return_index=True, return_inverse=True)
                data = {n: v[first] for n, v in data.items()}
                rows = len(first)
        if not rows:
            return pd.DataFrame({f"a{i}": [] for i in range(len(columns))}, dtype=float)
        batch = Batch(engine, requests, data, rows)

        def priors(which):
            if which not in marginals:
                marginals[which] = prior_marginals(engine, which)
            return marginals[which]
        batch.priors = priors
        found = {f"a{i}": of(batch) for i, (_, _, of, _) in enumerate(columns)}
        return pd.DataFrame({k: v if back is None else v[back] for k, v in found.items()})

    out = fresh_name(df, "__answers")
    scored = df.select("*", answer(*(bound.values() or [F.lit(0.0)])).alias(out))
    keep = df.columns if append else ([id_col] if id_col else [])
    last = []
    for i, (name, _, _, finish) in enumerate(columns):
        c = F.col(out)[f"a{i}"]
        last.append((finish(c) if finish else c).alias(name))
    return scored.select(*[quoted(c) for c in keep if c not in taken], *last)


def fresh_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name
