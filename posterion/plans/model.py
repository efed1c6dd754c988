"""Fitted parameters: small, size-checked tables held next to the network they belong to."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from posterion.functions.scalars import VARIANCE_FLOOR
from posterion.plans.network import Network, Variable

MAX_GRID = 500_000           # dense cells of one probability table


@dataclass(frozen=True)
class Moments:
    """Population moments of (continuous parents, own variables) in one parent combination."""
    weight: float
    mean: tuple[float, ...]
    cov: tuple[tuple[float, ...], ...]


@dataclass
class Model:
    """network, discrete tables {node: {parent states: {state: p}}} and Gaussian moments
    {first variable of node: {discrete parent states: Moments}}."""

    network: Network
    tables: dict[str, dict[tuple[str, ...], dict[str, float]]]
    moments: dict[str, dict[tuple[str, ...], Moments]]
    iterations: int = 1
    converged: bool = True
    loglikelihood: float | None = None

    @staticmethod
    def from_statistics(network: Network, rows, centres: dict[str, float], *, alpha: float = 0.0) -> "Model":
        counts: dict = {n: {} for n in network.names("discrete")}
        moments: dict = {g[0]: {} for g in network.nodes() if network[g[0]].kind == "continuous"}
        for r in rows:
            key = tuple(r["parents"])
            if r["kind"] == "cpt":
                counts[r["node"]].setdefault(key, {})[r["state"]] = float(r["w"])
            else:
                group = network.members(r["node"])
                vec = network.continuous_parents(r["node"]) + list(group)
                w, d = float(r["w"]), len(vec)
                dev = np.array(r["sums"], dtype=float) / w
                cov = np.array(r["cross"], dtype=float).reshape(d, d) / w - np.outer(dev, dev)
                mean = dev + np.array([centres.get(c, 0.0) for c in vec])
                moments[r["node"]][key] = Moments(w, tuple(mean), tuple(map(tuple, cov)))
        tables = {}
        for n, families in counts.items():
            states = network[n].states
            tables[n] = {}
            for key, c in families.items():
                total = sum(c.values()) + alpha * len(states)
                tables[n][key] = {s: (c.get(s, 0.0) + alpha) / total for s in states}
        return Model(network, tables, moments)

    # -- parameters as numbers ------------------------------------------------

    def combos(self, parents) -> list[tuple[str, ...]]:
        if self.network.grid_size(parents) > MAX_GRID:
            raise ValueError(f"the table over {list(parents)} has more than {MAX_GRID} cells")
        return list(product(*[self.network[p].states for p in parents]))

    def probability(self, node: str, parent_states: tuple[str, ...], state: str) -> float:
        """p(state | parents); uniform for a parent combination never seen."""
        row = self.tables[node].get(parent_states)
        return 1.0 / len(self.network[node].states) if row is None else row.get(state, 0.0)

    def dense(self, node: str) -> np.ndarray:
        """Probabilities indexed [parent combination, state], parents sorted by name."""
        states = self.network[node].states
        combos = self.combos(self.network.parents(node))
        return np.array([[self.probability(node, c, s) for s in states] for c in combos]).reshape(len(combos), len(states))

    def conditional(self, node: str, parent_states: tuple[str, ...]):
        """(intercept[own], slopes[own, continuous parents], covariance[own, own], weight) or None."""
        m = self.moments[node].get(parent_states)
        if m is None:
            return None
        k = len(self.network.continuous_parents(node))
        mean, cov = np.array(m.mean), np.array(m.cov)
        own = cov[k:, k:].copy()
        slopes = np.zeros((len(mean) - k, k))
        if k:
            slopes = np.linalg.lstsq(cov[:k, :k], cov[:k, k:], rcond=None)[0].T
            own = own - slopes @ cov[:k, k:]
        for i in range(len(own)):
            own[i, i] = max(own[i, i], VARIANCE_FLOOR)
        return mean[k:] - slopes @ mean[:k], slopes, own, m.weight

    def joint_gaussian(self, members, parent_states: dict[str, str]):
        """Joint mean and covariance of continuous variables (closed under continuous parents),
        given the states of their discrete parents; None where a family was never seen."""
        order = [n for n in self.network.order() if n in members]
        index = {n: i for i, n in enumerate(order)}
        mean, cov, done = np.zeros(len(order)), np.zeros((len(order), len(order))), set()
        for n in order:
            group = self.network.members(n)
            if n in done:
                continue
            key = tuple(parent_states[p] for p in self.network.discrete_parents(n))
            found = self.conditional(group[0], key)
            if found is None:
                return None
            a, b, s, _ = found
            ps = [index[p] for p in self.network.continuous_parents(n)]
            own = [index[m] for m in group]
            mean[own] = a + (b @ mean[ps] if ps else 0.0)
            if ps:
                cross = b @ cov[np.ix_(ps, list(range(len(order))))]
                cov[own, :] = cross
                cov[:, own] = cross.T
                cov[np.ix_(own, own)] = s + b @ cov[np.ix_(ps, ps)] @ b.T
            else:
                cov[np.ix_(own, own)] = s
            done |= set(group)
        return order, mean, cov

    def is_trained(self) -> bool:
        """Every node has parameters for every combination of its discrete parents."""
        return not self.missing_families()

    def missing_families(self) -> list[tuple[str, str]]:
        missing = []
        for g in self.network.nodes():
            n = g[0]
            parents = self.network.discrete_parents(n)
            have = self.tables.get(n) if self.network[n].kind == "discrete" else self.moments.get(n)
            for c in self.combos(parents):
                if not have or c not in have:
                    missing.append((n, parent_key(parents, c)))
        return missing

    # -- parameters as frames, save and load ----------------------------------

    def cpt_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(n, parent_key(self.network.parents(n), key), list(key), s, float(p))
                for n, fam in self.tables.items() for key, row in fam.items() for s, p in row.items()]
        return spark.createDataFrame(rows, "node string, parent_key string, parents array<string>, state string, p double")

    def gauss_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(n, parent_key(self.network.discrete_parents(n), key), list(key), float(m.weight),
                 [float(v) for v in m.mean], [float(v) for r in m.cov for v in r])
                for n, fam in self.moments.items() for key, m in fam.items()]
        return spark.createDataFrame(
            rows, "node string, parent_key string, parents array<string>, w double, mean array<double>, cov array<double>")

    def save(self, spark: SparkSession, path: str) -> None:
        """Parquet parameter tables and a JSON line for the network, in one directory."""
        spec = {"variables": [[v.name, v.kind, list(v.states), v.latent, v.selector] for v in self.network.variables],
                "edges": [list(e) for e in self.network.edges], "blocks": [list(b) for b in self.network.blocks],
                "iterations": self.iterations, "converged": self.converged, "loglikelihood": self.loglikelihood}
        self.cpt_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/cpt")
        self.gauss_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/gauss")
        spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/network")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Model":
        spec = json.loads(spark.read.text(f"{path}/network").head()[0])
        network = Network(tuple(Variable(n, k, tuple(s), *rest) for n, k, s, *rest in spec["variables"]),
                          tuple(map(tuple, spec["edges"])), tuple(map(tuple, spec["blocks"])))
        tables: dict = {n: {} for n in network.names("discrete")}
        for r in spark.read.parquet(f"{path}/cpt").collect():
            tables[r.node].setdefault(tuple(r.parents), {})[r.state] = r.p
        moments: dict = {g[0]: {} for g in network.nodes() if network[g[0]].kind == "continuous"}
        for r in spark.read.parquet(f"{path}/gauss").collect():
            d = len(r["mean"])
            cov = tuple(tuple(r["cov"][i * d:(i + 1) * d]) for i in range(d))
            moments[r.node][tuple(r.parents)] = Moments(r.w, tuple(r["mean"]), cov)
        return Model(network, tables, moments, spec["iterations"], spec["converged"], spec["loglikelihood"])


def parent_key(parents, states) -> str:
    """The text key of a parent combination, written as functions.scalars.key_text does."""
    return "|".join(f"{p}=" + str(s).replace("\\", "\\\\").replace("|", "\\|") for p, s in zip(parents, states))


def log_probability(p: float) -> float:
    return math.log(p) if p > 0 else -math.inf
