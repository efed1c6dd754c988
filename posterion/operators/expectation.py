"""Expected sufficient statistics of any network with gaps anywhere, and EM on them.

One scan an iteration: each task runs both passes of the junction trees over its rows and adds up
expected counts and moments of all families in arrays as large as the parameters; these are summed
by one grouped aggregate. The work of a row does not grow with the number of its gaps, only with the
largest bucket of its null pattern. Hidden continuous values enter with their conditional mean and
covariance, so Gaussian families under any gaps get exact expected moments.

Rows with impossible evidence weigh nothing. A Gaussian family that the present model does not
know takes no part until a case is complete enough to start it.
"""

from __future__ import annotations

from dataclasses import replace
from itertools import product
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from posterion.functions.scalars import quoted
from posterion.operators.fit import MAX_PARAMETERS
from posterion.operators.inference import inputs
from posterion.operators.junction import Answers, Engine, Part
from posterion.plans.model import Model


class Layout:
    """Places of all sums in one flat array: the loglikelihood, counts of every discrete family, then weight, sums
    and cross products of every Gaussian family."""

    def __init__(self, engine: Engine):
        self.engine, at = engine, 1
        self.counts, self.moments = {}, {}
        for n in engine.discrete:
            shape = [engine.cards[v] for v in (*engine.parents[n], n)]
            self.counts[n] = at, shape
            at += prod(shape)
        for g in engine.nodes:
            if engine.net[g[0]].kind == "continuous":
                d = len(engine.continuous_parents[g]) + len(g)
                c = prod(engine.cards[p] for p in engine.discrete_parents[g])
                self.moments[g] = at, c, d
                at += c * (1 + d + d * d)
        self.size = at
        if self.size > MAX_PARAMETERS:
            raise ValueError(f"more than {MAX_PARAMETERS} parameters to learn from gaps")

    def rows(self, flat: np.ndarray):
        """The sums as the parameter cells that `Model.from_statistics` reads."""
        net = self.engine.net
        for n, (at, shape) in self.counts.items():
            counts = flat[at:at + prod(shape)].reshape(-1, shape[-1])
            for key, row in zip(product(*[net[p].states for p in self.engine.parents[n]]), counts):
                if row.sum() > 0:
                    for s, w in zip(net[n].states, row):
                        yield {"node": n, "kind": "cpt", "parents": list(key), "state": s, "w": float(w), "sums": None, "cross": None}
        for g, (at, c, d) in self.moments.items():
            cells = flat[at:at + c * (1 + d + d * d)].reshape(c, -1)
            for key, row in zip(product(*[net[p].states for p in self.engine.discrete_parents[g]]), cells):
                if row[0] > 1e-300:
                    yield {"node": g[0], "kind": "gauss", "parents": list(key), "state": None, "w": float(row[0]), "sums": row[1:1 + d], "cross": row[1 + d:]}


def add_expectations(flat: np.ndarray, layout: Layout, answers: Answers, weight: np.ndarray, centres: dict[str, float]) -> None:
    """Adds what some rows of one null pattern expect of every family."""
    engine, pattern, data, rows = layout.engine, answers.pattern, answers.data, answers.rows
    ll = answers.loglikelihood
    weight = np.where(np.isfinite(ll), weight, 0.0)
    flat[0] += float((weight * np.where(np.isfinite(ll), ll, 0.0)).sum())
    for n, (start, shape) in layout.counts.items():
        names = (*engine.parents[n], n)
        share = np.nan_to_num(answers.joint(names)).reshape(rows, -1) * weight[:, None]
        place, inner = np.zeros(rows, np.int64), np.zeros(1, np.int64)
        for i, v in enumerate(names):
            stride = prod(shape[i + 1:])
            if v in pattern.sliced:
                place += stride * data[v].astype(np.int64)
            else:
                inner = (inner[:, None] + stride * np.arange(shape[i])).ravel()
        np.add.at(flat, start + place[:, None] + inner[None, :], share)
    for part in pattern.parts:
        _add_moments(flat, layout, answers, part, weight, centres)


def _add_moments(flat, layout: Layout, answers: Answers, part: Part, weight, centres) -> None:
    engine, data, rows = layout.engine, answers.data, answers.rows
    share = np.nan_to_num(answers.joint(part.parents)).reshape(rows, -1) * weight[:, None]
    mean, known, at = part.conditional(answers.pattern.free(part.parents), data, rows)
    share = np.where(known, share, 0.0)
    hidden = {m: i for i, m in enumerate(part.hidden)}
    per_combo = np.bincount(at.ravel(), weights=share.ravel(), minlength=len(part.known))
    for g in part.nodes:
        start, c, d = layout.moments[g]
        names = [*engine.continuous_parents[g], *g]
        own = engine.discrete_parents[g]
        combos = np.zeros(1, np.int64)               # the family's parent combination of each combination of the part
        for p, size in zip(part.parents, part.sizes):
            stride = prod(engine.cards[q] for q in own[own.index(p) + 1:]) if p in own else 0
            combos = (combos[:, None] + stride * np.arange(size)).ravel()
        where = combos[at].ravel()
        values = [(mean[:, :, hidden[m]] if m in hidden else np.broadcast_to(data[m][:, None], share.shape)) - centres.get(m, 0.0) for m in names]
        cells = flat[start:start + c * (1 + d + d * d)].reshape(c, -1)      # a view
        cells[:, 0] += np.bincount(where, weights=share.ravel(), minlength=c)
        spread = np.zeros((c, d, d))
        gaps = [(i, hidden[m]) for i, m in enumerate(names) if m in hidden]
        if gaps:
            out, ix = [i for i, _ in gaps], [j for _, j in gaps]
            inner = np.zeros((len(combos), d, d))
            inner[np.ix_(range(len(combos)), out, out)] = part.spread[np.ix_(range(len(combos)), ix, ix)]
            np.add.at(spread, combos, per_combo[:, None, None] * inner)
        for i, a in enumerate(values):
            wa = share * a
            cells[:, 1 + i] += np.bincount(where, weights=wa.ravel(), minlength=c)
            for j in range(i, d):
                second = np.bincount(where, weights=(wa * values[j]).ravel(), minlength=c) + spread[:, i, j]
                cells[:, 1 + d + i * d + j] += second
                if i != j:
                    cells[:, 1 + d + j * d + i] += second


def expectations(table: DataFrame, model: Model, centres: dict[str, float], weight: str | None = None) -> tuple[list[dict], float]:
    """(expected parameter cells, loglikelihood) of a model on a table; one scan."""
    bound = inputs(table, model)
    names = list(bound)
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    layout = Layout(Engine(model))
    size = layout.size

    def partial(batches):
        engine = Engine(model)
        layout, flat = Layout(engine), np.zeros(size)
        for b in batches:
            wt = b.column(0).to_numpy(zero_copy_only=False).astype(float)
            use = wt > 0
            if not use.any():
                continue
            given = {n: b.column(i + 1).to_numpy(zero_copy_only=False).astype(float)[use] for i, n in enumerate(names)}
            data = {v.name: given.get(v.name, np.full(int(use.sum()), np.nan)) for v in engine.net.variables}
            wt = wt[use]
            for pick, answers in engine.runs(data, whole=True):
                add_expectations(flat, layout, answers, wt[pick], centres)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_pydict({"at": at.astype(np.int32), "value": flat[at]})

    found = (table.select(w.alias("w"), *[c.alias(f"v{i}") for i, c in enumerate(bound.values())])
             .mapInArrow(partial, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect())   # one row a parameter
    flat = np.zeros(size)
    for r in found:
        flat[r["at"]] = r["value"]
    return list(layout.rows(flat)), float(flat[0])


def maximise(table: DataFrame, model: Model, centres: dict[str, float], *, iterations: int, tolerance: float, weight: str | None = None) -> Model:
    """EM from a first model: stops after `iterations`, or when the loglikelihood gains less than `tolerance` of
    itself. The loglikelihood reported is that of the parameters returned."""
    last, converged, t = None, False, 0
    for step in range(1, iterations + 2):          # the last step only scores the returned model
        cells, ll = expectations(table, model, centres, weight)
        if last is not None and abs(ll - last) <= tolerance * abs(last):
            converged = True
        last, t = ll, min(step, iterations)
        if converged or step > iterations:
            break
        model = Model.from_statistics(model.network, cells, centres)
    return replace(model, iterations=t, converged=converged, loglikelihood=last)
