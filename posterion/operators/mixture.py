"""EM for a latent or partly observed class with independent leaves, and for missing values.

Each iteration is one scan with map-side partial sums; parameters return as literals, so
plans never grow. Several runs (folds, state counts, columns) share one scan. Networks beyond a
star, and gaps above other columns, learn from expected statistics (`expectation`).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from posterion.functions.scalars import as_double, interval_index, lookup, quoted, state_index
from posterion.operators.bins import equal_frequency_edges
from posterion.operators.expectation import maximise
from posterion.operators.fit import collect_cells, discover, statistics
from posterion.operators.ranking import quantiles
from posterion.operators.score import _Plan, encode
from posterion.plans.model import Model, Moments, log_probability
from posterion.plans.network import Network
from posterion.sources.storage import reused

MAX_SUMS = 250               # aggregates written as expressions; beyond, numpy per Arrow batch
SMALL_ROWS = 3_000_000       # up to here compiling new expressions costs more than Arrow transfer


@dataclass
class Run:
    """One EM run of a batch: a model and the rows it learns from (`__fold` <> fold)."""
    model: Model
    fold: int | None = None
    last: float | None = None
    done: bool = False
    iterations: int = 0
    converged: bool = False


def hub_of(network: Network) -> str:
    latent = [v.name for v in network.variables if v.latent]
    if latent:
        return latent[0]
    return max((n for n in network.names("discrete") if network.children(n)), key=lambda n: len(network.children(n)))


def is_star(network: Network) -> bool:
    hub = hub_of(network)
    return not network.parents(hub) and not network.blocks and all(
        network.parents(n) == [hub] for n in network.names() if n != hub)


def starting_model(df: DataFrame, network: Network, *, start: str | None = None, weight: str | None = None,
                   by: str | None = None) -> tuple[Network, Model, dict[str, float]]:
    """Hard clusters from equal-frequency bins of one column; a null gives equal shares."""
    network, centres = discover(df, network)
    hub = hub_of(network)
    k = len(network[hub].states)
    fields = {f.name: f.dataType for f in df.schema.fields}
    start = start or next(iter(network.observed("continuous")), None) or network.observed("discrete")[0]
    if start not in network.names() or network[start].kind == "continuous":
        value = as_double(quoted(start), fields[start])
        cuts = equal_frequency_edges(df, [start], k)[start][1:-1]
        position = interval_index(value, cuts)
        distinct = len(cuts) + 1
    else:
        size = len(network[start].states)
        position = F.floor(state_index(quoted(start), network[start].states, fields[start]) * k / size).cast("int")
        distinct = min(k, size)
    if distinct < k:       # ties merged some bins: the spare clusters share every row a little
        share = [F.when(position.isNull(), 1.0 / k).when(position == i, 0.9 + 0.1 / k).otherwise(0.1 / k) for i in range(k)]
    else:
        share = [F.when(position.isNull(), 1.0 / k).when(position == i, 1.0).otherwise(0.0) for i in range(k)]
    return network, _maximise(df, network, centres, share, weight), centres


def _maximise(df: DataFrame, network: Network, centres, share: list[Column], weight) -> Model:
    """M-step for any DAG under the hub: rows are spread over hub states with their weights
    and fitted like observed data."""
    hub = hub_of(network)
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    pairs = F.array(*[F.struct(F.lit(s).alias("s"), (w * c).alias("w")) for s, c in zip(network[hub].states, share)])
    spread = df.drop(hub).withColumn("__h", F.explode(pairs)).withColumn(hub, F.col("__h.s")).withColumn("__w", F.col("__h.w"))
    return Model.from_statistics(network, collect_cells(statistics(spread, network, centres, weight="__w")), centres)


def fit_mixture(df: DataFrame, network: Network, *, iterations: int = 100, tolerance: float = 1e-6,
                weight: str | None = None, start: str | None = None, initial: Model | None = None) -> Model:
    """P5/P11/P12/P15 and P6 (class partly observed): EM from a deterministic start.

    Stops after `iterations` or when the loglikelihood gains less than `tolerance` of itself.
    The model's loglikelihood is that of the parameters returned.
    """
    columns = [n for n in network.observed() if n in df.columns]
    if start and start not in columns:
        columns.append(start)
    table = df.select(*[quoted(c) for c in columns], *([quoted(weight)] if weight else []))
    if not network.observed("continuous"):
        # purely discrete evidence: one weighted row per distinct combination
        w = quoted(weight).cast("double") if weight else F.lit(1.0)
        table = table.groupBy(*[quoted(c) for c in columns]).agg(F.sum(w).alias("__weight"))
        weight = "__weight"
    # written once, so that a lost executor costs a reread; cached on top for the many passes
    table = reused(table).persist()
    try:
        return _iterate(table, network, iterations, tolerance, weight, start, initial)
    finally:
        table.unpersist()


def _iterate(table: DataFrame, network: Network, iterations: int, tolerance: float, weight, start, initial) -> Model:
    if initial is None:
        network, model, centres = starting_model(table, network, start=start, weight=weight)
    else:
        model, network = initial, initial.network
        centres = discover(table, network)[1]
    if is_star(network):
        run = run_batch(table, [Run(model)], centres, iterations=iterations, tolerance=tolerance, weight=weight)[0]
        ll = training_loglikelihoods(table, [run], weight=weight)[0]
        return replace(run.model, iterations=run.iterations, converged=run.converged, loglikelihood=ll)
    return maximise(table, model, centres, iterations=iterations, tolerance=tolerance, weight=weight)


def run_batch(table: DataFrame, runs: list[Run], centres: dict[str, float], *, iterations: int,
              tolerance: float, weight: str | None = None, fold: str | None = None) -> list[Run]:
    """All runs advance together: one scan per iteration for every run still open.

    Every model is a star over columns of the table; `fold` excludes `run.fold` from a run.
    """
    small = table.count() <= SMALL_ROWS
    for _ in range(iterations):
        active = [r for r in runs if not r.done]
        if not active:
            break
        wide = sum(len(_layout(r.model)) for r in active) > MAX_SUMS
        step = _arrow_expectations if small or wide else _expectations
        for run, sums in zip(active, step(table, active, centres, weight, fold)):
            run.iterations += 1
            model, ll = _from_sums(run.model, sums, centres)
            if run.last is not None and abs(ll - run.last) <= tolerance * abs(run.last):
                run.done = run.converged = True
            run.model, run.last = model, ll
    return runs


def _layout(model: Model) -> list[tuple]:
    """The sufficient statistics of a star: per hub state weight, counts, moments."""
    net, hub = model.network, hub_of(model.network)
    items: list[tuple] = [("ll",)]
    for k in range(len(net[hub].states)):
        items.append(("hub", k))
        for n in net.names():
            if n != hub and net[n].kind == "discrete":
                items += [("state", n, k, s) for s in range(len(net[n].states))]
            elif n != hub:
                items += [("moment", n, k, m) for m in range(3)]
    return items


def _expectations(table, runs, centres, weight, fold) -> list[dict]:
    layouts = [_layout(r.model) for r in runs]
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    scored, plans = table, []
    for i, run in enumerate(runs):
        index, x, inputs = encode(scored, run.model)
        rename = {f"__in{j}": f"__in{i}_{j}" for j in range(len(inputs))}
        index = {n: F.col(rename[f"__in{j}"]) for j, n in enumerate(run.model.network.names()) if n in index}
        x = {n: F.col(rename[f"__in{j}"]) for j, n in enumerate(run.model.network.names()) if n in x}
        scored = scored.select("*", *[c.alias(f"__in{i}_{j}") for j, c in enumerate(inputs)])
        plan = _Plan(run.model, hub_of(run.model.network), index, x, f"r{i}")
        plan.responsibilities(), plan.evidence_score()
        for stage in plan.staged:
            scored = scored.select("*", *stage)
        plans.append(plan)
    sums = []
    for i, (run, plan, layout) in enumerate(zip(runs, plans, layouts)):
        r, ll = plan.responsibilities(), plan.evidence_score()
        share = w if run.fold is None else F.when(quoted(fold) != run.fold, w)
        for j, item in enumerate(layout):
            if item[0] == "ll":
                e = share * ll
            elif item[0] == "hub":
                e = share * r[item[1]]
            elif item[0] == "state":
                e = F.when(plan.index[item[1]] == item[3], share * r[item[2]])
            else:
                dev = plan.x[item[1]] - F.lit(float(centres.get(item[1], 0.0)))
                power = [F.when(dev.isNotNull(), F.lit(1.0)), dev, dev * dev][item[3]]
                e = share * r[item[2]] * power
            sums.append(F.sum(e).alias(f"q{i}_{j}"))
    row = scored.agg(*sums).head()
    return [{item: float(row[f"q{i}_{j}"] or 0.0) for j, item in enumerate(layout)} for i, layout in enumerate(layouts)]


def held_out_loglikelihoods(table: DataFrame, runs: list[Run], *, weight: str | None = None, fold: str) -> list[float]:
    """Summed loglikelihood of each run on the fold it did not learn from; one scan for all runs."""
    return [s["ll",] for s in _arrow_expectations(table, runs, {}, weight, fold, held_out=True)]


def training_loglikelihoods(table: DataFrame, runs: list[Run], *, weight: str | None = None, fold: str | None = None) -> list[float]:
    """Summed loglikelihood of each run's present parameters on the rows it learned from; one scan."""
    return [s["ll",] for s in _arrow_expectations(table, runs, {}, weight, fold)]


def _arrow_expectations(table, runs, centres, weight, fold, held_out: bool = False) -> list[dict]:
    """Small tables and wide batches: numpy partial sums per Arrow batch, then one grouped sum."""
    names = sorted({n for r in runs for n in r.model.network.observed() if n in table.columns})
    kinds = {n: r.model.network[n] for r in runs for n in r.model.network.observed()}
    fields = {f.name: f.dataType for f in table.schema.fields}
    cols = [(state_index(quoted(n), kinds[n].states, fields[n]).cast("double") if kinds[n].kind == "discrete"
             else as_double(quoted(n), fields[n])).alias(f"v{i}") for i, n in enumerate(names)]
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    base = table.select(*cols, w.alias("w"), (quoted(fold) if fold else F.lit(-1)).cast("int").alias("f"))
    specs = [(r.fold, *_numpy_star(r.model, names)) for r in runs]
    shift = np.array([centres.get(n, 0.0) for n in names])

    def partial(batches):
        totals: dict = {}
        for pdf in batches:
            data = pdf[[f"v{i}" for i in range(len(names))]].to_numpy(dtype=float)
            wt, fd = pdf["w"].to_numpy(dtype=float), pdf["f"].to_numpy()
            for i, (skip, prior, leaves, hub_column) in enumerate(specs):
                use = slice(None) if skip is None else (fd == skip if held_out else fd != skip)
                got = _star_sums(data[use], wt[use], prior, leaves, hub_column, shift)
                totals[i] = got if i not in totals else totals[i] + got
        yield pd.DataFrame([(i, j, v) for i, t in totals.items() for j, v in enumerate(t)],
                           columns=["run", "item", "value"])

    rows = (base.mapInPandas(partial, "run int, item int, value double")
            .groupBy("run", "item").agg(F.sum("value").alias("value")).collect())
    out = [dict.fromkeys(_layout(r.model), 0.0) for r in runs]
    layouts = [_layout(r.model) for r in runs]
    for row in rows:
        out[row["run"]][layouts[row["run"]][row["item"]]] = row["value"]
    return out


def _numpy_star(model: Model, names):
    net, hub = model.network, hub_of(model.network)
    states = net[hub].states
    prior = np.array([log_probability(p) for p in model.dense(hub)[0]])
    leaves = []
    for n in net.names():
        if n == hub:
            continue
        if net[n].kind == "discrete":
            leaves.append(("d", names.index(n), np.array(
                [[log_probability(model.probability(n, (h,), s)) for s in net[n].states] for h in states])))
        else:
            found = [model.conditional(n, (h,)) for h in states]
            leaves.append(("g", names.index(n), np.array(
                [(f[0][0], f[2][0, 0]) if f else (0.0, np.nan) for f in found])))
    return prior, leaves, (names.index(hub) if hub in names else None)


def _star_sums(data, wt, prior, leaves, hub_column, shift) -> np.ndarray:
    """Sums of one batch in `_layout` order."""
    s = np.tile(prior, (len(data), 1))
    for kind, c, par in leaves:
        v = data[:, c]
        here = ~np.isnan(v)
        if kind == "d":
            s[here] += par[:, v[here].astype(int)].T
        else:
            dens = -0.5 * np.log(2 * np.pi * par[:, 1]) - (v[here, None] - par[:, 0]) ** 2 / (2 * par[:, 1])
            s[here] += np.where(np.isnan(dens), -np.inf, dens)
    if hub_column is not None:
        h = data[:, hub_column]
        s[~np.isnan(h)[:, None] & (np.arange(s.shape[1])[None, :] != h[:, None])] = -np.inf
    top = s.max(axis=1, keepdims=True) if len(s) else s[:, :1]
    live = np.isfinite(top[:, 0])
    s, wt, data, top = s[live], wt[live], data[live], top[live]
    e = np.exp(s - top)
    z = e.sum(axis=1, keepdims=True)
    r = e / z * wt[:, None]
    ll = float((wt * (top + np.log(z))[:, 0]).sum())
    columns = []
    for kind, c, par in leaves:
        v = data[:, c]
        here = ~np.isnan(v)
        if kind == "d":
            columns.append(np.stack([r[here & (v == st)].sum(axis=0) for st in range(par.shape[1])], axis=1))
        else:
            dev = v[here] - shift[c]
            columns.append(np.stack([r[here].sum(axis=0), dev @ r[here], (dev * dev) @ r[here]], axis=1))
    per_k = np.concatenate([r.sum(axis=0)[:, None], *columns], axis=1)
    return np.concatenate([[ll], per_k.ravel()])


def _from_sums(old: Model, sums: dict, centres) -> tuple[Model, float]:
    net, hub = old.network, hub_of(old.network)
    states = net[hub].states
    total = sum(sums["hub", k] for k in range(len(states)))
    tables: dict = {hub: {(): {s: sums["hub", k] / total for k, s in enumerate(states)}}}
    moments: dict = {}
    for n in net.names():
        if n == hub:
            continue
        if net[n].kind == "discrete":
            tables[n] = {}
            for k, h in enumerate(states):
                c = [sums["state", n, k, s] for s in range(len(net[n].states))]
                if sum(c) > 0:
                    tables[n][(h,)] = {s: v / sum(c) for s, v in zip(net[n].states, c)}
        else:
            moments[n] = {}
            for k, h in enumerate(states):
                w, s1, s2 = (sums["moment", n, k, m] for m in range(3))
                if w > 0:
                    dev = s1 / w
                    moments[n][(h,)] = Moments(w, (dev + centres.get(n, 0.0),), ((s2 / w - dev * dev,),))
    return Model(net, tables, moments), sums["ll",]


def fit_incomplete(df: DataFrame, network: Network, *, iterations: int = 100, tolerance: float = 1e-6,
                   weight: str | None = None, initial: Model | None = None) -> Model:
    """P6 for any network, discrete or mixed, with missing values anywhere: EM by expected statistics.

    The first estimate comes from the families that are complete in each row, unless `initial` is
    given. Discrete tables are folded to one weighted row per distinct pattern first.
    """
    if initial is None:
        network, centres = discover(df, network)
    else:
        network, centres = initial.network, discover(df, initial.network)[1]
    names = network.observed()
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    table = df.select(*[quoted(n) for n in names], w.alias("__weight"))
    if not network.observed("continuous"):
        table = table.groupBy(*[quoted(n) for n in names]).agg(F.sum("__weight").alias("__weight"))
    table = reused(table)
    if initial is None:
        initial = Model.from_statistics(network, collect_cells(statistics(table, network, centres, weight="__weight")), centres)
    return maximise(table, initial, centres, iterations=iterations, tolerance=tolerance, weight="__weight")


def column_starts(table: DataFrame, column: str, network_of, counts, *, weight: str) -> tuple[list[Model], dict[str, float]]:
    """Starting models of one-column mixtures for several cluster counts, from two scans:
    quantiles for all counts at once, then moments per (count, bin). Clusters left without a
    bin of their own, when ties merge bins, start from the whole column."""
    counts = list(counts)
    value = quoted(column).cast("double")
    fractions = sorted({i / k for k in counts for i in range(1, k)})
    points = dict(zip(fractions, quantiles(table, {column: value}, fractions)[column])) if fractions else {}
    cuts = {k: sorted({points[i / k] for i in range(1, k)}) for k in counts}
    centre = table.agg(F.avg(value)).head()[0] or 0.0
    dev, w = value - F.lit(centre), quoted(weight).cast("double")
    spread = F.array(*[F.struct(F.lit(k).alias("k"), interval_index(value, cuts[k]).alias("bin")) for k in counts])
    rows = (table.select(F.explode(spread).alias("s"), w.alias("w"), (w * dev).alias("s1"), (w * dev * dev).alias("s2"))
            .groupBy("s.k", "s.bin").agg(F.sum("w").alias("w"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2")).collect())
    models = []
    for k in counts:
        found = {r["bin"]: (r["w"], r["s1"], r["s2"]) for r in rows if r["k"] == k}
        total = [sum(v[i] for v in found.values()) for i in range(3)]
        network = network_of(k)
        hub = hub_of(network)
        sums: dict = {("ll",): 0.0}
        for i in range(k):
            share = found.get(i) or [0.1 / k * t for t in total]
            sums["hub", i] = share[0]
            for m in range(3):
                sums["moment", column, i, m] = share[m]
        models.append(_from_sums(Model(network, {}, {}), sums, {column: centre})[0])
    return models, {column: centre}
