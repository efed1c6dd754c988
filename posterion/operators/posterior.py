"""Posterior tables over scenarios: sum-product written as explode, lookup and grouped sum.

A scenario is a row of evidence. Each hidden discrete variable is exploded over its states
in parent-before-child order, the log weight is added from the constant probability table,
impossible combinations are dropped at once, and variables that nobody needs any more are
summed out with a grouped aggregate before the grid grows.
"""

from __future__ import annotations

import math
from itertools import product
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from posterion.functions.scalars import as_double, lookup, normal_log_density, quoted, state_index
from posterion.operators.gaussian import components, discrete_parents_of, indexed_moments, log_density
from posterion.operators.inference import inputs, score_rows, to_arrays
from posterion.operators.junction import Engine
from posterion.plans.model import Model, log_probability

GRID_LIMIT = 1024            # open combinations per scenario before variables are summed out


def _state_name(model: Model, name: str, index: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in model.network[name].states]), index)


def _radix(model: Model, names, cols: dict[str, Column]) -> Column:
    idx = F.lit(0)
    for n in names:
        idx = idx * F.lit(len(model.network[n].states)) + cols[n]
    return idx


def _weights(scenarios: DataFrame, model: Model, keep, *, key, soft=(), evidence=None, head=()) -> DataFrame:
    """Rows (key, position of every kept discrete variable as __s<i>, __lw).

    `head` variables have their own evidence retracted. `soft` names columns holding a map
    state -> likelihood weight (unlisted states weigh 0).
    """
    net = model.network
    key = [key] if isinstance(key, str) else list(key)
    fields = {f.name: f.dataType for f in scenarios.schema.fields}
    evidence = [c for c in (evidence if evidence is not None else fields) if c in net.names() and c not in key
                and c not in soft and c not in head]
    soft = [c for c in soft if c in net.names()]
    needed = net.ancestors(set(keep) | set(evidence) | set(soft))
    order = [n for n in net.order() if n in needed]
    discrete = [n for n in order if net[n].kind == "discrete"]
    groups = [g for g in components(net) if set(g) & set(evidence)]
    slot = {n: f"__s{i}" for i, n in enumerate(net.names())}
    col = {n: F.col(s) for n, s in slot.items()}

    inputs = [state_index(quoted(n), net[n].states, fields[n]).alias(f"__e{slot[n]}")
              for n in evidence if net[n].kind == "discrete"]
    inputs += [as_double(quoted(n), fields[n]).alias(f"__x{slot[n]}") for n in evidence if net[n].kind == "continuous"]
    inputs += [quoted(n).alias(f"__w{slot[n]}") for n in soft]
    df = scenarios.select(*[quoted(k) for k in key], *inputs).withColumn("__lw", F.lit(0.0))

    open_vars: list[str] = []
    done: set[str] = set()
    pending = {g: set(discrete_parents_of(net, g)) for g in groups}

    def gaussians(df):
        for g in [g for g, ps in pending.items() if ps <= done]:
            ps = discrete_parents_of(net, g)
            joints = [model.joint_gaussian(g, dict(zip(ps, c))) for c in model.combos(ps)]
            x = {n: (F.col(f"__x{slot[n]}") if n in evidence else F.lit(None).cast("double")) for n in g}
            if len(g) == 1:
                m, v = indexed_moments(joints, _radix(model, ps, col))
                dens = F.when(x[g[0]].isNull(), 0.0).otherwise(
                    F.coalesce(normal_log_density(x[g[0]], m, v), F.lit(-math.inf)))
            else:
                dens = F.lit(None).cast("double")
                for i, j in enumerate(joints):
                    dens = F.when(_radix(model, ps, col) == i, log_density(x, j)).otherwise(dens)
            df = df.withColumn("__lw", F.col("__lw") + dens)
            del pending[g]
        return df.filter(F.col("__lw") > F.lit(-math.inf))

    df = gaussians(df) if any(not p for p in pending.values()) else df
    for n in discrete:
        size = len(net[n].states)
        spread = F.sequence(F.lit(0), F.lit(size - 1))
        if n in evidence:
            seen = F.col(f"__e{slot[n]}")
            spread = F.when(seen.isNotNull(), F.array(seen)).otherwise(spread)
        df = df.withColumn(slot[n], F.explode(spread))
        parents = net.parents(n)
        flat = [log_probability(p) for row in model.dense(n) for p in row]
        lw = F.col("__lw") + lookup(flat, _radix(model, parents + [n], col))
        if n in soft:
            mapped = F.col(f"__w{slot[n]}")
            weight = F.coalesce(F.try_element_at(mapped, _state_name(model, n, col[n])), F.lit(0.0))
            lw = lw + F.when(mapped.isNull(), 0.0).when(weight > 0, F.ln(weight)).otherwise(F.lit(-math.inf))
        df = df.withColumn("__lw", lw).filter(F.col("__lw") > F.lit(-math.inf))
        done.add(n)
        open_vars.append(n)
        df = gaussians(df) if any(ps <= done for ps in pending.values()) else df
        dead = [v for v in open_vars if v not in keep
                and all(c in done for c in net.children(v) if c in needed and net[c].kind == "discrete")
                and not any(v in ps for ps in pending.values())]
        if dead and n != discrete[-1] and net.grid_size(open_vars) > GRID_LIMIT:
            open_vars = [v for v in open_vars if v not in dead]
            rest = [c for c in df.columns if c not in {slot[v] for v in dead} | {"__lw"}]
            df = _sum_out(df, rest, key)
    extra = [slot[n] for n in keep if n in open_vars]
    return df.select(*[quoted(k) for k in key], *extra, "__lw")


def _sum_out(df: DataFrame, rest, key) -> DataFrame:
    top = F.max("__lw").over(Window.partitionBy(*[quoted(k) for k in key]))
    return (df.withColumn("__top", top)
            .groupBy(*[quoted(c) for c in rest], "__top").agg(F.sum(F.exp(F.col("__lw") - F.col("__top"))).alias("__p"))
            .withColumn("__lw", F.ln("__p") + F.col("__top")).drop("__p", "__top"))


def posterior(scenarios: DataFrame, model: Model, head, *, key, soft=(), evidence=None, tail=()) -> DataFrame:
    """M1/M2/Q13/Q14: P(head [| tail], evidence of the scenario).

    One row per scenario and combination of positive probability: key, head and tail states,
    `probability` (given the tail states when a tail is named), and `ln_evidence`.
    """
    head, tail = list(head), list(tail)
    if set(head) & set(tail):
        raise ValueError("a variable is either in the head or in the tail")
    key = [key] if isinstance(key, str) else list(key)
    net = model.network
    slot = {n: f"__s{i}" for i, n in enumerate(net.names())}
    rows = _weights(scenarios, model, head + tail, key=key, soft=soft, evidence=evidence, head=head + tail)
    keys = [quoted(k) for k in key]
    scenario = Window.partitionBy(*keys)
    kept = [slot[n] for n in head + tail]
    table = (rows.withColumn("__top", F.max("__lw").over(scenario))
             .groupBy(*keys, *kept, "__top").agg(F.sum(F.exp(F.col("__lw") - F.col("__top"))).alias("__p")))
    total = F.sum("__p").over(scenario)
    given = F.sum("__p").over(Window.partitionBy(*keys, *[slot[n] for n in tail])) if tail else total
    return table.select(
        *keys, *[_state_name(model, n, F.col(slot[n])).alias(n) for n in head + tail],
        (F.col("__p") / given).alias("probability"), (F.ln(total) + F.col("__top")).alias("ln_evidence"))


def pair_tables(scenarios: DataFrame, model: Model, variables, *, key, target: str | None = None, soft=(),
                evidence=None) -> DataFrame:
    """(key, variable, state, [target state,] probability) for several variables.

    While the joint grid is small, one expansion serves all variables; otherwise each variable
    is summed out on its own.
    """
    net = model.network
    key = [key] if isinstance(key, str) else list(key)
    extra = [target] if target else []
    keep = [*dict.fromkeys([*variables, *extra])]
    observed = [v for v in variables if v in (evidence if evidence is not None else scenarios.columns)]
    if net.grid_size(sorted(net.ancestors(keep))) > GRID_LIMIT or observed:
        result = None
        for v in variables:
            one = posterior(scenarios, model, [v, *extra], key=key, soft=soft, evidence=evidence)
            part = one.select(*key, F.lit(v).alias("variable"), F.col(v).alias("state"),
                              *[F.col(t) for t in extra], "probability")
            result = part if result is None else result.unionByName(part)
        return result
    slot = {n: f"__s{i}" for i, n in enumerate(net.names())}
    rows = _weights(scenarios, model, keep, key=key, soft=soft, evidence=evidence, head=keep)
    keys = [quoted(k) for k in key]
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), _state_name(model, v, F.col(slot[v])).alias("state")) for v in variables])
    long = rows.select(*keys, "__lw", *[F.col(slot[t]) for t in extra], F.explode(pairs).alias("v"))
    scenario = Window.partitionBy(*keys)
    table = (long.withColumn("__top", F.max("__lw").over(scenario))
             .groupBy(*keys, "v.variable", "v.state", *[slot[t] for t in extra])
             .agg(F.sum(F.exp(F.col("__lw") - F.col("__top"))).alias("__p")))
    total = F.sum("__p").over(Window.partitionBy(*keys, "variable"))
    return table.select(*keys, "variable", "state", *[_state_name(model, t, F.col(slot[t])).alias(t) for t in extra],
                        (F.col("__p") / total).alias("probability"))


def state_posteriors(scenarios: DataFrame, model: Model, variables, *, key, soft=(), evidence=None) -> DataFrame:
    """(key, variable, state, ord, probability) of several variables; states of probability 0
    are listed too."""
    key = [key] if isinstance(key, str) else list(key)
    found = pair_tables(scenarios, model, variables, key=key, soft=soft, evidence=evidence)
    every = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(s).alias("state"), F.lit(i).alias("ord"))
                      for v in variables for i, s in enumerate(model.network[v].states)])
    full = scenarios.select(*[quoted(k) for k in key], F.explode(every).alias("g")).select(*[quoted(k) for k in key], "g.*")
    return full.join(found, [*key, "variable", "state"], "left").select(
        *key, "variable", "state", "ord", F.coalesce("probability", F.lit(0.0)).alias("probability"))


def no_evidence(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0,)], "scenario_id int")


def scenario_frame(spark: SparkSession, model: Model, rows) -> DataFrame:
    """Q13: scenarios from a list of {variable: state or number}; unknown names or states raise."""
    net, variables = model.network, []
    for r in rows:
        for name, value in r.items():
            v = net[name]
            if v.kind == "discrete" and value is not None and str(value) not in v.states:
                raise ValueError(f"{name} has no state {value}")
            if name not in variables:
                variables.append(name)
    schema = "scenario_id int" + "".join(
        f", `{n}` {'string' if net[n].kind == 'discrete' else 'double'}" for n in variables)
    data = [(i, *[None if r.get(n) is None else (str(r[n]) if net[n].kind == "discrete" else float(r[n]))
                  for n in variables]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def soft_except(model: Model, variable: str, states) -> dict[str, float]:
    """Likelihood 1 for every state but the named ones."""
    gone = {states} if isinstance(states, str) else set(states)
    return {s: 1.0 for s in model.network[variable].states if s not in gone}


def gaussian_posterior(scenarios: DataFrame, model: Model, heads, *, key, tail=(), soft=(), evidence=None) -> DataFrame:
    """M3/M4: per scenario and tail combination the mean vector and covariance matrix of
    continuous heads, moment-matched over everything hidden and conditioned on all evidence, also on
    values of the heads' own linked group. The heads' own values are retracted. Combinations of
    parent states that no Gaussian was fitted for, and impossible tails, are left out."""
    net = model.network
    heads, tail, soft = list(heads), list(tail), [s for s in soft if s in net.names()]
    if any(net[t].kind != "discrete" for t in tail):
        raise ValueError("a continuous tail is not supported")
    if any(net[h].kind != "continuous" for h in heads):
        raise ValueError("heads must be continuous")
    key = [key] if isinstance(key, str) else list(key)
    used = list(evidence) if evidence is not None else scenarios.columns
    bound = inputs(scenarios, model, [c for c in used if c not in key and c not in heads and c not in tail and c not in soft])
    names, d = list(bound), len(heads)
    mapped = [F.when(quoted(v).isNotNull(), F.array(*[F.coalesce(F.try_element_at(quoted(v), F.lit(s)), F.lit(0.0)).cast("double")
                                                      for s in net[v].states])) for v in soft]
    held: list = []

    @F.pandas_udf("mean array<double>, cov array<double>")
    def moments(*cols: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(Engine(model))
        rows = len(cols[0])
        data = to_arrays(model, names, cols)
        weights = {v: np.stack([np.ones(len(net[v].states)) if w is None else np.asarray(w, float) for w in cols[len(names) + i]])
                   if rows else np.ones((0, len(net[v].states))) for i, v in enumerate(soft)}
        mean, cov = [None] * rows, [None] * rows
        if rows:
            for pick, found in held[0].runs(data, scopes=((*heads, *tail),), soft=weights):
                m, c = found.moments(heads, tuple(tail))
                for j, i in enumerate(pick):
                    mean[i], cov[i] = m[j].ravel(), c[j].ravel()
        return pd.DataFrame({"mean": mean, "cov": cov})

    sizes = [len(net[t].states) for t in tail]
    found = scenarios.select(*[quoted(k) for k in key], moments(*(list(bound.values()) + mapped or [F.lit(0.0)])).alias("__m"))
    found = found.withColumn("__t", F.explode(F.sequence(F.lit(0), F.lit(prod(sizes) - 1))))
    part = lambda c, n: F.slice(F.col(c), F.col("__t") * n + 1, F.lit(n))      # noqa: E731
    out = found.select(*[quoted(k) for k in key], "__t", part("__m.mean", d).alias("mean"), part("__m.cov", d * d).alias("cov"))
    out = out.filter(~F.isnan(F.get("mean", F.lit(0))))
    state = {t: _state_name(model, t, F.floor(F.col("__t") / prod(sizes[i + 1:])).cast("int") % sizes[i]) for i, t in enumerate(tail)}
    tail_text = F.concat_ws(", ", *[F.concat(F.lit(f"{t}="), state[t]) for t in tail])
    name = F.lit("P(" + ", ".join(heads))
    label = F.concat(name, F.lit(" | "), tail_text, F.lit(")")) if tail else F.concat(name, F.lit(")"))
    return out.select(*[quoted(k) for k in key], *[c.alias(t) for t, c in state.items()], label.alias("distribution"), "mean", "cov")


def pair_moments(frame: DataFrame, heads, a: str, b: str) -> DataFrame:
    """M5: mean pair, 2x2 sub-covariance and standard deviations of two heads."""
    d, i, j = len(heads), list(heads).index(a), list(heads).index(b)
    at = lambda r, c: F.get("cov", F.lit(r * d + c))
    return frame.select("*", F.get("mean", F.lit(i)).alias("mean_a"), F.get("mean", F.lit(j)).alias("mean_b"),
                        at(i, i).alias("var_a"), at(j, j).alias("var_b"), at(i, j).alias("cov_ab"),
                        F.sqrt(at(i, i)).alias("std_a"), F.sqrt(at(j, j)).alias("std_b"))


def difference(base: DataFrame, new: DataFrame | None, on=("variable", "state")) -> DataFrame:
    """M6: base and new probability of every state, and their difference."""
    on = list(on)
    b = base.select(*on, F.col("probability").alias("base_probability"))
    if new is None:
        return b
    return b.join(new.select(*on, "probability"), on, "inner").withColumn(
        "difference", F.col("probability") - F.col("base_probability"))


def mean_posteriors(scenarios: DataFrame, model: Model, variables, *, key, soft=(), evidence=None) -> DataFrame:
    """(key, variable, mean, variance) of several continuous variables given each scenario."""
    key = [key] if isinstance(key, str) else list(key)
    result = None
    for v in variables:
        one = gaussian_posterior(scenarios, model, [v], key=key, soft=soft, evidence=evidence)
        part = one.select(*key, F.lit(v).alias("variable"), F.get("mean", F.lit(0)).alias("mean"), F.get("cov", F.lit(0)).alias("variance"))
        result = part if result is None else result.unionByName(part)
    return result


def mean_difference(base: DataFrame, new: DataFrame | None, on=("variable",)) -> DataFrame:
    """M6 for continuous variables: base and new mean and variance side by side, and how far the mean moved."""
    on = list(on)
    b = base.select(*on, F.col("mean").alias("base_mean"), F.col("variance").alias("base_variance"))
    if new is None:
        return b
    return b.join(new.select(*on, "mean", "variance"), on, "inner").withColumn("difference", F.col("mean") - F.col("base_mean"))


def marginal_components(model: Model, name: str):
    """Marginal of one variable: state probabilities, or (weight, mean, variance) parts.
    Only the small grid of the variable's discrete ancestors is enumerated."""
    net = model.network
    group = next((g for g in components(net) if name in g), (name,))
    top = net.ancestors(group if net[name].kind == "continuous" else [name])
    above = [n for n in net.order() if n in top and net[n].kind == "discrete"]
    model.combos(above)
    totals: dict = {}
    parts = []
    for combo in product(*[net[n].states for n in above]):
        at = dict(zip(above, combo))
        p = 1.0
        for n in above:
            p *= model.probability(n, tuple(at[q] for q in net.parents(n)), at[n])
            if p == 0.0:
                break
        if p == 0.0:
            continue
        if net[name].kind == "discrete":
            totals[at[name]] = totals.get(at[name], 0.0) + p
        else:
            j = model.joint_gaussian(group, at)
            if j is not None:
                i = j[0].index(name)
                parts.append((p, j[1][i], j[2][i, i]))
    if net[name].kind == "discrete":
        return [totals.get(s, 0.0) for s in net[name].states]
    merged: dict = {}
    for p, m, v in parts:
        merged[(m, v)] = merged.get((m, v), 0.0) + p
    total = sum(merged.values())
    return [(p / total, m, v) for (m, v), p in merged.items()]


def score_general(df: DataFrame, model: Model, target: str, *, id_col: str, evidence=None,
                  dtype: str = "string", suffix: str = "_maxlikelihood") -> DataFrame:
    """Q12: most likely state, all state probabilities and the loglikelihood of the other evidence,
    for a discrete target under any pattern of missing values. Rows stay in place."""
    from posterion.operators.score import ModelStatistics, MostLikelyState, StateProbability
    used = [c for c in (evidence or model.network.observed()) if c in df.columns and c != target]
    return score_rows(df, model, [MostLikelyState(target, dtype, suffix), StateProbability(target), ModelStatistics()],
                      id_col=id_col, evidence=used, append=False)
