"""Case scoring: a model and a list of queries become columns of the table.

Where one discrete variable (the latent cluster, the class, or the queried variable) is summed
over and everything else is looked up, the answers are column expressions: no join, no shuffle,
no Python. Any other network, where a missing value may stand above a present one, is answered by
junction trees in numpy (`inference`). Rows stay in place either way, so the same call works on a
streaming table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from posterion.functions.scalars import (as_double, cast_state, finite, log_sum_exp, lookup, normal_log_density,
                                         quoted, state_index)
from posterion.operators.gaussian import (NoExpression, components, conditional_moments, discrete_parents_of, indexed_moments,
                                          log_density)
from posterion.operators.inference import score_rows
from posterion.plans.model import Model, log_probability

MAX_TERMS = 500              # states x columns written as separate expressions


@dataclass(frozen=True)
class ModelStatistics:
    """Q1/Q2: ln P(evidence) of the row, and Jensen's conflict measure."""
    loglikelihood: bool = True
    conflict: bool = False


@dataclass(frozen=True)
class MostLikelyState:
    """Q3: the most probable state of a discrete variable, its own evidence retracted."""
    variable: str
    dtype: str = "string"
    suffix: str = "_maxlikelihood"


@dataclass(frozen=True)
class StateProbability:
    """Q4: probability of every state (`v$$state_probability`) or of one (`v_probability`)."""
    variable: str
    state: str | None = None
    suffix: str = "_probability"


@dataclass(frozen=True)
class MeanVariance:
    """Q5: mean and variance of a continuous variable given the other evidence."""
    variable: str
    retract_evidence: bool = True
    default: float | None = None
    dtype: str = "double"


@dataclass(frozen=True)
class LogLikelihood:
    """Q6: ln density of the named continuous variables given the remaining evidence."""
    variables: tuple[str, ...]
    column_name: str = "loglikelihood"
    append_variable_names: bool = True


@dataclass(frozen=True)
class KLDivergence:
    """Q7: KL divergence between two variables' posteriors, column `a_b`."""
    a: str
    b: str


def choose_hub(model: Model, target: str | None = None) -> str | None:
    """The variable to sum over: latent first; then the target or the class with most children."""
    net = model.network
    latent = [v.name for v in net.variables if v.latent]
    if latent:
        return latent[0]
    fixed = {n for n in net.names("discrete") if _is_common_parent(net, n)}
    inner = [n for n in net.names("discrete") if net.children(n) and n not in fixed]
    if target is not None and net[target].kind == "discrete" and (net.children(target) or not inner):
        return target
    return max(inner, key=lambda n: len(net.children(n)), default=None)


def _is_common_parent(net, name: str) -> bool:
    """Fold or model ids are never a quantity to sum over."""
    return net[name].selector


class _Plan:
    """Expressions of one model with one summed variable."""

    def __init__(self, model: Model, hub: str | None, index: dict[str, Column], x: dict[str, Column], tag: str):
        self.model, self.net, self.hub, self.tag = model, model.network, hub, tag
        self.index, self.x = index, x
        self.K = len(self.net[hub].states) if hub else 1
        self.staged: list[list[Column]] = []
        self.score_columns: dict = {}

    # -- pieces ---------------------------------------------------------------

    def _radix(self, names) -> Column:
        idx = F.lit(0)
        for n in names:
            idx = idx * F.lit(len(self.net[n].states)) + self.index[n]
        return idx

    def _fixed_hub(self, parents, k: int):
        """Rows of the dense parent grid with the hub in state k, other parents in radix order."""
        others = [p for p in parents if p != self.hub]
        combos = self.model.combos(others)
        if self.hub in parents:
            at = parents.index(self.hub)
            state = self.net[self.hub].states[k]
            return others, [c[:at] + (state,) + c[at:] for c in combos]
        return others, combos

    def table_rows(self, node: str, k: int) -> tuple[list[str], list[list[float]]]:
        others, combos = self._fixed_hub(self.net.parents(node), k)
        states = self.net[node].states
        return others, [[self.model.probability(node, c, s) for s in states] for c in combos]

    def discrete_term(self, node: str, k: int) -> Column:
        others, rows = self.table_rows(node, k)
        flat = [log_probability(p) for r in rows for p in r]
        return F.coalesce(lookup(flat, self._radix(others + [node])), F.lit(0.0))

    def joints(self, group, k: int):
        parents = discrete_parents_of(self.net, group)
        others, combos = self._fixed_hub(parents, k)
        return others, [self.model.joint_gaussian(group, dict(zip(parents, c))) for c in combos]

    def gaussian_term(self, group, k: int, hidden=frozenset()) -> Column:
        others, joints = self.joints(group, k)
        x = {n: (F.lit(None).cast("double") if n in hidden else self.x[n]) for n in group}
        if len(group) == 1:
            mean, var = indexed_moments(joints, self._radix(others))
            value = x[group[0]]
            density = F.coalesce(normal_log_density(value, mean, var), F.lit(-math.inf))
            return F.when(value.isNull(), F.lit(0.0)).otherwise(density)
        if len(joints) == 1:
            return log_density(x, joints[0])
        return self._by_combination(others, [log_density(x, j) for j in joints])

    def _by_combination(self, others, values: list[Column]) -> Column:
        if len(values) > 64:
            raise NoExpression(f"too many combinations of {others} above a linked Gaussian group")
        idx, expr = self._radix(others), None
        for i, v in enumerate(values):
            expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
        return expr

    def prior(self, k: int) -> Column:
        if not self.hub:
            return F.lit(0.0)
        parents = self.net.parents(self.hub)
        table = self.model.dense(self.hub)
        return lookup([log_probability(p) for p in table[:, k]], self._radix(parents))

    # -- scores ---------------------------------------------------------------

    def scores(self, hidden=frozenset(), evidence_on_hub: bool = True) -> list[Column]:
        """ln P(hub = k, evidence without `hidden`) per state k, as staged columns."""
        key = (hidden, evidence_on_hub)
        if key not in self.score_columns:
            base = self._base_scores(hidden)
            if self.hub and evidence_on_hub and not self.net[self.hub].latent and self.hub not in hidden:
                h = self.index[self.hub]
                base = [F.when(h.isNull() | (h == k), s).otherwise(F.lit(-math.inf)) for k, s in enumerate(base)]
            self.score_columns[key] = self._stage(f"e{len(self.score_columns)}", base)
        return self.score_columns[key]

    def _base_scores(self, hidden) -> list[Column]:
        hidden = hidden - {self.hub}
        key = ("base", hidden)
        if key in self.score_columns:
            return self.score_columns[key]
        discrete = [n for n in self.net.names("discrete") if n != self.hub and n not in hidden]
        groups = [g for g in components(self.net) if not set(g) <= hidden]
        if self.K * (len(discrete) + len(groups)) > MAX_TERMS and self._is_star(discrete, groups):
            array = self._stage(f"a{len(self.score_columns)}", [self._array_scores(discrete, groups)])[0]
            base = [F.get(array, F.lit(k)) for k in range(self.K)]
        else:
            shared = F.lit(0.0)
            own = [self.prior(k) for k in range(self.K)]
            for n in discrete:
                if self.hub in self.net.parents(n):
                    own = [o + self.discrete_term(n, k) for k, o in enumerate(own)]
                else:
                    shared = shared + self.discrete_term(n, 0)
            for g in groups:
                if self.hub in discrete_parents_of(self.net, g):
                    own = [o + self.gaussian_term(g, k, hidden) for k, o in enumerate(own)]
                else:
                    shared = shared + self.gaussian_term(g, 0, hidden)
            common = self._stage(f"c{len(self.score_columns)}", [shared])[0]
            base = [o + common for o in own]
        self.score_columns[key] = self._stage(f"b{len(self.score_columns)}", base)
        return self.score_columns[key]

    def _is_star(self, discrete, groups) -> bool:
        return all(self.net.parents(n) == [self.hub] for n in discrete) and not self.net.parents(self.hub) and all(
            len(g) == 1 and self.net.parents(g[0]) == [self.hub] for g in groups)

    def _array_scores(self, discrete, groups) -> Column:
        """Wide models: all K scores of a batch as one numpy expression."""
        prior = np.array([log_probability(p) for p in self.model.dense(self.hub)[0]])
        tables = [np.array([[log_probability(p) for p in self.table_rows(n, k)[1][0]] for k in range(self.K)])
                  for n in discrete]
        joints = [[self.joints(g, k)[1][0] for k in range(self.K)] for g in groups]
        means = [np.array([j[1][0] if j else 0.0 for j in js]) for js in joints]
        variances = [np.array([j[2][0, 0] if j else math.nan for j in js]) for js in joints]
        nd = len(discrete)

        @F.pandas_udf("array<double>")
        def batch(*cols: pd.Series) -> pd.Series:
            total = np.tile(prior, (len(cols[0]), 1))
            for t, c in zip(tables, cols[:nd]):
                v = c.to_numpy(dtype=float)
                here = ~np.isnan(v)
                total[here] += t[:, v[here].astype(int)].T
            for m, s, c in zip(means, variances, cols[nd:]):
                v = c.to_numpy(dtype=float)
                here = ~np.isnan(v)
                dens = -0.5 * np.log(2 * np.pi * s) - (v[here, None] - m) ** 2 / (2 * s)
                total[here] += np.where(np.isnan(dens), -np.inf, dens)
            return pd.Series(list(total))

        return batch(*[self.index[n] for n in discrete], *[self.x[g[0]] for g in groups])

    def _stage(self, name: str, columns: list[Column]) -> list[Column]:
        """Compute the columns once per row; later expressions refer to them by name."""
        names = [f"__{self.tag}{name}_{i}" for i in range(len(columns))]
        self.staged.append([c.alias(n) for n, c in zip(names, columns)])
        return [F.col(n) for n in names]

    def evidence_score(self, hidden=frozenset()) -> Column:
        key = ("ll", hidden)
        if key not in self.score_columns:
            self.score_columns[key] = self._stage(f"l{len(self.score_columns)}", [log_sum_exp(self.scores(hidden))])
        return self.score_columns[key][0]

    def responsibilities(self, hidden=frozenset(), evidence_on_hub: bool = True) -> list[Column]:
        key = ("r", hidden, evidence_on_hub)
        if key not in self.score_columns:
            s = self.scores(hidden, evidence_on_hub)
            total = self._stage(f"t{len(self.score_columns)}", [log_sum_exp(s)])[0]
            self.score_columns[key] = self._stage(f"r{len(self.score_columns)}", [F.exp(v - total) for v in s])
        return self.score_columns[key]

    # -- answers --------------------------------------------------------------

    def state_probabilities(self, v: str) -> list[Column]:
        """P(v = s | other evidence) for every state, own evidence retracted."""
        if self.net[v].kind != "discrete":
            raise ValueError(f"{v} is not discrete")
        key = ("p", v)
        if key in self.score_columns:
            return self.score_columns[key]
        if v == self.hub:
            values = self.responsibilities(evidence_on_hub=False)
        else:
            if self.net.children(v):
                raise NoExpression(f"{v} has children and is not the summed variable")
            r = self.responsibilities(frozenset([v]))
            values = []
            for s in range(len(self.net[v].states)):
                total = F.lit(0.0)
                for k in range(self.K):
                    others, rows = self.table_rows(v, k)
                    total = total + r[k] * lookup([row[s] for row in rows], self._radix(others))
                values.append(total)
        self.score_columns[key] = self._stage(f"p{len(self.score_columns)}", values)
        return self.score_columns[key]

    def mean_variance(self, v: str, retract: bool = True) -> tuple[Column, Column]:
        if self.net[v].kind != "continuous":
            raise ValueError(f"{v} is not continuous")
        key = ("m", v, retract)
        if key not in self.score_columns:
            group = next(g for g in components(self.net) if v in g)
            r = self.responsibilities(frozenset([v]))
            mean, second = F.lit(0.0), F.lit(0.0)
            for k in range(self.K):
                m, s2 = self._component_moments(v, group, k)
                alive = r[k] > 0
                mean = mean + F.when(alive, r[k] * m).otherwise(F.lit(0.0))
                second = second + F.when(alive, r[k] * (s2 + m * m)).otherwise(F.lit(0.0))
            mean = F.when(r[0].isNotNull(), mean)
            mean_col, second_col = self._stage(f"m{len(self.score_columns)}", [mean, second])
            var = F.when(mean_col.isNotNull(), F.greatest(second_col - mean_col * mean_col, F.lit(0.0)))
            if not retract:
                seen = self.x[v].isNotNull()
                mean_col, var = F.when(seen, self.x[v]).otherwise(mean_col), F.when(seen, F.lit(0.0)).otherwise(var)
            self.score_columns[key] = self._stage(f"v{len(self.score_columns)}", [mean_col, var])
        return tuple(self.score_columns[key])

    def _component_moments(self, v, group, k):
        others, joints = self.joints(group, k)
        if len(group) == 1:
            return indexed_moments(joints, self._radix(others))
        pairs = [conditional_moments(v, self.x, j) for j in joints]
        if len(pairs) == 1:
            return pairs[0]
        return (self._by_combination(others, [p[0] for p in pairs]),
                self._by_combination(others, [p[1] for p in pairs]))

    def marginal_scores(self) -> list[Column]:
        """ln P(e_i) of every present value on its own (null where absent)."""
        from posterion.operators.posterior import marginal_components
        result = []
        for n in self.net.observed():
            if _is_common_parent(self.net, n):
                continue
            parts = marginal_components(self.model, n)
            if self.net[n].kind == "discrete":
                result.append(lookup([log_probability(p) for p in parts], self.index[n]))
            else:
                terms = [F.lit(math.log(w)) + normal_log_density(self.x[n], F.lit(float(m)), F.lit(float(s2)))
                         for w, m, s2 in parts if w > 0]
                result.append(F.when(self.x[n].isNotNull(), log_sum_exp(terms)))
        return result


def encode(df: DataFrame, model: Model, evidence=None) -> tuple[dict[str, Column], dict[str, Column], list[Column]]:
    """Evidence binding: state positions and doubles per variable; other columns are missing."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    index, x, staged = {}, {}, []
    for i, v in enumerate(model.network.variables):
        bound = v.name in fields and not v.latent and (evidence is None or v.name in evidence)
        if v.kind == "discrete":
            expr = state_index(quoted(v.name), v.states, fields[v.name]) if bound else F.lit(None).cast("int")
        else:
            expr = as_double(quoted(v.name), fields[v.name]) if bound else F.lit(None).cast("double")
        staged.append(expr.alias(f"__in{i}"))
        (index if v.kind == "discrete" else x)[v.name] = F.col(f"__in{i}")
    return index, x, staged


def score(df: DataFrame, model: Model, queries=None, *, id_col: str | None = None, evidence=None, append: bool = True) -> DataFrame:
    """Add the answers of all queries as columns, in one pass (Q1-Q12), for any network and any gaps.

    `evidence` limits the columns used; `append=False` keeps only `id_col` and the answers.
    """
    queries = list(queries) if queries else [ModelStatistics()]
    net = model.network
    if not isinstance(model, Model):
        from posterion.operators.keyed import score_keyed
        return score_keyed(df, model, queries, id_col=id_col, evidence=evidence, append=append)
    if not any(n in df.columns for n in net.observed() if evidence is None or n in evidence):
        raise ValueError("no column of the table is a variable of the network")
    for q in queries:
        check_query(q, net)
    try:
        return _score_expressions(df, model, queries, id_col, evidence, append)
    except NoExpression:
        return score_rows(df, model, queries, id_col=id_col, evidence=evidence, append=append)


def _score_expressions(df: DataFrame, model: Model, queries, id_col, evidence, append: bool) -> DataFrame:
    net = model.network
    index, x, inputs = encode(df, model, evidence)
    plans: dict[str | None, _Plan] = {}

    def plan_for(target: str | None = None) -> _Plan:
        hub = choose_hub(model, target)
        if hub not in plans:
            plans[hub] = _Plan(model, hub, index, x, f"h{len(plans)}")
            if not _always_usable(plans[hub]):
                raise NoExpression("values above present ones may be missing")
        return plans[hub]

    out: list[tuple[str, Column]] = []
    for q in queries:
        out += _answers(q, plan_for, net)
    names = [n for n, _ in out]
    if len(set(names)) != len(names):
        raise ValueError(f"two queries write the same column: {names}")

    result = df.select("*", *inputs)
    for plan in plans.values():
        for stage in plan.staged:
            result = result.select("*", *stage)
    keep = df.columns if append else ([id_col] if id_col else [])
    # one struct unpacked by a generator: a later filter on an answer stays above it, where a
    # plain projection would copy the whole score expression into the filter
    return result.select(*[quoted(c) for c in keep if c not in names], F.inline(F.array(F.struct(*[c.alias(n) for n, c in out]))))


def _always_usable(plan: _Plan) -> bool:
    net = plan.net
    for g in net.nodes():
        parents = [p for p in net.discrete_parents(g[0]) if p != plan.hub and not _is_common_parent(net, p)]
        if parents:
            return False
    return True


def check_query(q, net) -> None:
    """Refuses questions that the network cannot be asked."""
    if isinstance(q, (MostLikelyState, StateProbability)) and net[q.variable].kind != "discrete":
        raise ValueError(f"{q.variable} is not discrete")
    if isinstance(q, StateProbability) and q.state is not None and q.state not in net[q.variable].states:
        raise ValueError(f"{q.variable} has no state {q.state}")
    if isinstance(q, MeanVariance) and net[q.variable].kind != "continuous":
        raise ValueError(f"{q.variable} is not continuous")
    if isinstance(q, LogLikelihood):
        if not q.variables or len(set(q.variables)) != len(q.variables):
            raise ValueError("name each variable once")
        if any(net[v].kind != "continuous" for v in q.variables):
            raise ValueError("loglikelihood is asked of continuous variables")
    if isinstance(q, KLDivergence):
        if net[q.a].kind != net[q.b].kind:
            raise ValueError("both variables must be of one kind")
        if net[q.a].kind == "discrete" and net[q.a].states != net[q.b].states:
            raise ValueError("both variables need the same states")


def _answers(q, plan_for, net) -> list[tuple[str, Column]]:
    if isinstance(q, ModelStatistics):
        plan = plan_for()
        ll = plan.evidence_score()
        out = [("loglikelihood", ll)] if q.loglikelihood else []
        if q.conflict:
            marginals = plan.marginal_scores()
            total = reduce(lambda a, b: a + b, [F.coalesce(m, F.lit(0.0)) for m in marginals])
            out.append(("conflict", finite(total) - ll))
        return out
    if isinstance(q, MostLikelyState):
        p = plan_for(q.variable).state_probabilities(q.variable)
        top = F.greatest(*p) if len(p) > 1 else p[0]
        expr = None
        for s, c in zip(net[q.variable].states, p):
            expr = F.when(c == top, F.lit(s)) if expr is None else expr.when(c == top, F.lit(s))
        return [(f"{q.variable}{q.suffix}", cast_state(expr, q.dtype) if q.dtype != "string" else expr)]
    if isinstance(q, StateProbability):
        p = plan_for(q.variable).state_probabilities(q.variable)
        states = net[q.variable].states
        if q.state is None:
            return [(f"{q.variable}$${s}{q.suffix}", c) for s, c in zip(states, p)]
        return [(f"{q.variable}{q.suffix}", p[states.index(q.state)])]
    if isinstance(q, MeanVariance):
        mean, var = plan_for(q.variable).mean_variance(q.variable, q.retract_evidence)
        if q.default is not None:
            mean, var = F.coalesce(mean, F.lit(q.default)), F.coalesce(var, F.lit(q.default))
        return [(f"{q.variable}_mean", mean.cast(q.dtype)), (f"{q.variable}_variance", var.cast(q.dtype))]
    if isinstance(q, LogLikelihood):
        plan = plan_for()
        name = f"{':'.join(q.variables)}_{q.column_name}" if q.append_variable_names else q.column_name
        return [(name, plan.evidence_score() - plan.evidence_score(frozenset(q.variables)))]
    if isinstance(q, KLDivergence):
        if net[q.a].kind == "discrete":
            pa = plan_for(q.a).state_probabilities(q.a)
            pb = plan_for(q.b).state_probabilities(q.b)
            terms = [F.when(a > 0, F.when(b > 0, a * F.ln(a / b))).otherwise(F.when(a.isNotNull(), F.lit(0.0)))
                     for a, b in zip(pa, pb)]
            return [(f"{q.a}_{q.b}", reduce(lambda s, t: s + t, terms))]
        (ma, va), (mb, vb) = plan_for(q.a).mean_variance(q.a), plan_for(q.b).mean_variance(q.b)
        kl = F.lit(0.5) * F.ln(vb / va) + (va + (ma - mb) * (ma - mb)) / (F.lit(2.0) * vb) - F.lit(0.5)
        return [(f"{q.a}_{q.b}", kl)]
    raise ValueError(f"unknown query {q!r}")


def impute(df: DataFrame, model: Model, columns=None) -> DataFrame:
    """Q15: fill nulls with the most likely state or the mean; present values are kept."""
    net = model.network
    fields = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in (columns or net.observed()) if c in fields and not _is_common_parent(net, c)]
    queries = [MostLikelyState(c, "string", "__fill") if net[c].kind == "discrete" else MeanVariance(c)
               for c in columns]
    scored = score(df, model, queries)
    filled = []
    for name in df.columns:
        if name not in columns:
            filled.append(quoted(name))
            continue
        fill = quoted(f"{name}__fill" if net[name].kind == "discrete" else f"{name}_mean")
        filled.append(F.coalesce(quoted(name), fill.try_cast(fields[name])).alias(name))
    return scored.select(*filled)


def anomalies(df: DataFrame, model: Model, k: int, id_col: str) -> DataFrame:
    """Q17: the k rows with the lowest loglikelihood (a top-k report)."""
    scored = score(df, model, [ModelStatistics()], id_col=id_col)
    return scored.orderBy(F.col("loglikelihood").asc_nulls_first(), quoted(id_col)).limit(k)
