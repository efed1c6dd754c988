"""Parameter learning: every node family from one grouped aggregation over the table.

Families are counted together with GROUPING SETS. When the discrete columns span a small
grid, rows are first folded into one row per distinct combination, so the grouping sets
expand a few thousand cells and not the table.
"""

from __future__ import annotations

from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from posterion.functions.scalars import as_double, key_text, quoted, state_index, state_text
from posterion.plans.model import Model
from posterion.plans.network import Network

MAX_STATES = 10_000          # states over all discrete columns that a network may discover
MAX_PARAMETERS = 500_000     # parameter rows that may come to the driver
FOLD_CELLS = 50_000          # grid size up to which rows are folded into cells first
MOMENT_SUMS = 100            # moment sums in one aggregate
MOMENT_WORK = 400            # discrete families x moment sums up to which one aggregate serves both


class TooManyStates(ValueError):
    """The states do not fit on the driver: such columns are keyed (`operators.keyed`)."""


def discover(df: DataFrame, network: Network) -> tuple[Network, dict[str, float]]:
    """States of the discrete variables that have none yet, and the mean of each
    continuous column (used to centre the moment sums); one scan for both."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name in network.observed():
        if name not in fields:
            raise ValueError(f"column {name} is not in the table")
    open_vars = [n for n in network.observed("discrete") if not network[n].states]
    continuous = network.observed("continuous")
    means = [F.avg(as_double(quoted(c), fields[c])).alias(f"m{i}") for i, c in enumerate(continuous)]
    texts = [state_text(quoted(n), fields[n]).alias(f"d{i}") for i, n in enumerate(open_vars)]
    if not open_vars:
        row = df.agg(F.lit(1), *means).collect()[0]
        return network, {c: row[f"m{i}"] or 0.0 for i, c in enumerate(continuous)}
    base = df.select(*texts, *[quoted(c) for c in continuous])
    keys = [f"d{i}" for i in range(len(open_vars))]
    sets = [[k] for k in keys] + [[]]
    rows = (base.groupingSets(sets, *keys)
            .agg(F.grouping_id().alias("gid"), *means)
            .limit(MAX_STATES + 1).collect())
    if len(rows) > MAX_STATES:
        raise TooManyStates(f"more than {MAX_STATES} states; key the high-cardinality columns, or bin them")
    full = (1 << len(keys)) - 1
    states: dict[str, tuple[str, ...]] = {}
    for i, name in enumerate(open_vars):
        gid = full ^ (1 << (len(keys) - 1 - i))
        found = [r[keys[i]] for r in rows if r.gid == gid and r[keys[i]] is not None]
        states[name] = sort_states(found, fields[name])
    total = next((r for r in rows if r.gid == full), None)
    centres = {c: (total[f"m{i}"] if total is not None else None) or 0.0 for i, c in enumerate(continuous)}
    return network.with_states(states), centres


def sort_states(found, dtype) -> tuple[str, ...]:
    """States in value order: numbers by size, other types by text."""
    from posterion.functions.scalars import NUMERIC
    return tuple(sorted(found, key=float if isinstance(dtype, NUMERIC) else None))


def _parent_key(parents, text) -> Column:
    if not parents:
        return F.lit("")
    return F.concat_ws("|", *[F.concat(F.lit(f"{p}="), key_text(text[p])) for p in parents])


def statistics(df: DataFrame, network: Network, centres: dict[str, float], *,
               weight: str | Column | None = None) -> DataFrame:
    """One row per parameter cell of every family, raw sums only.

    Columns: node, kind, parents (array), parent_key, state, w (weight), rows, sums, cross.
    A row counts for a family when all its columns are present (exact when the node has no
    observed descendants); states outside the network are missing.

    Narrow networks take one aggregation. In wide ones the moment sums would be computed for
    every discrete family too, and one aggregate with thousands of sums would not compile, so
    counts and chunks of Gaussian groups are aggregated apart; a group that is too wide for one
    aggregate is summed in numpy per Arrow batch.
    """
    discrete = network.names("discrete")
    groups = [g for g in network.nodes() if network[g[0]].kind == "continuous"]
    size = {g: 2 + len(v) + len(v) * (len(v) + 1) // 2 for g in groups
            for v in [network.continuous_parents(g[0]) + list(g)]}
    if len(discrete) * sum(size.values()) <= MOMENT_WORK and sum(size.values()) <= MOMENT_SUMS:
        return _statistics(df, network, centres, weight, discrete, groups)
    wide = [g for g in groups if size[g] > MOMENT_SUMS]
    groups = [g for g in groups if g not in wide]
    chunks, current = [], []
    for g in groups:
        if current and sum(size[c] for c in current) + size[g] > MOMENT_SUMS:
            chunks.append(current)
            current = []
        current.append(g)
    parts = [_statistics(df, network, centres, weight, [], c) for c in [*chunks, current] if c]
    parts += [_wide_moments(df, network, centres, weight, g) for g in wide]
    if discrete:
        parts.insert(0, _statistics(df, network, centres, weight, discrete, []))
    result = parts[0]
    for p in parts[1:]:
        result = result.unionByName(p)
    return result


def _wide_moments(df: DataFrame, network: Network, centres, weight, group) -> DataFrame:
    """Moment cells of one wide Gaussian group: each task keeps one array a parent combination, and these are added up
    place by place."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    parents, vector = network.discrete_parents(group[0]), network.continuous_parents(group[0]) + list(group)
    w = F.lit(1.0) if weight is None else (quoted(weight) if isinstance(weight, str) else weight).cast("double")
    text = {p: state_text(quoted(p), fields[p]) for p in parents}
    ok = F.lit(True)
    for p in parents:
        ok = ok & state_index(quoted(p), network[p].states, fields[p]).isNotNull()
    x = F.array(*[as_double(quoted(c), fields[c]) - F.lit(float(centres.get(c, 0.0))) for c in vector])
    key = F.array(*text.values()) if parents else F.array().cast("array<string>")
    rows = df.select(key.alias("parents"), w.alias("w"), x.alias("x")).filter(ok & (F.col("w") > 0))
    d = len(vector)

    def partial(batches):
        found: dict = {}
        for b in batches:
            keys = list(map(tuple, b.column(0).to_pylist()))
            wt = b.column(1).to_numpy(zero_copy_only=False)
            data = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            here = ~np.isnan(data).any(axis=1)               # a gap leaves the row out
            for k in set(keys):
                r = here & np.array([key == k for key in keys])
                if not r.any():
                    continue
                weighted = data[r] * wt[r, None]
                sums = np.concatenate([[wt[r].sum(), r.sum()], weighted.sum(axis=0), (weighted.T @ data[r]).ravel()])
                found[k] = found[k] + sums if k in found else sums
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(map(list, found), pa.list_(pa.string())), pa.array(list(found.values()), pa.list_(pa.float64()))],
                                             names=["parents", "sums"])

    parts = rows.mapInArrow(partial, "parents array<string>, sums array<double>").select("parents", F.posexplode("sums").alias("at", "v"))
    cells = parts.groupBy("parents", "at").agg(F.sum("v").alias("v")).groupBy("parents").agg(F.collect_list(F.struct("at", "v")).alias("s"))

    def ordered(batches):            # plain columns: later expressions do not repeat the sorting
        for b in batches:
            flat = []
            for row in b.column(1).to_pylist():
                s = np.zeros(2 + d + d * d)
                s[[v["at"] for v in row]] = [v["v"] for v in row]
                flat.append(s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s[0] for s in flat]), pa.array([int(s[1]) for s in flat], pa.int64()),
                                              pa.array([s[2:2 + d] for s in flat], pa.list_(pa.float64())), pa.array([s[2 + d:] for s in flat], pa.list_(pa.float64()))],
                                             names=["parents", "w", "rows", "sums", "cross"])

    cells = cells.mapInArrow(ordered, "parents array<string>, w double, rows bigint, sums array<double>, cross array<double>")
    named = {p: F.get("parents", F.lit(i)) for i, p in enumerate(parents)}
    return cells.select(F.lit(group[0]).alias("node"), F.lit("gauss").alias("kind"), "parents", _parent_key(parents, named).alias("parent_key"),
                        F.lit(None).cast("string").alias("state"), "w", "rows", "sums", "cross")


def _statistics(df: DataFrame, network: Network, centres, weight, discrete, groups) -> DataFrame:
    fields = {f.name: f.dataType for f in df.schema.fields}
    w = F.lit(1.0) if weight is None else (quoted(weight) if isinstance(weight, str) else weight).cast("double")
    families = {n: sorted({n, *network.parents(n)}) for n in discrete}
    gaussian = {g: network.discrete_parents(g[0]) for g in groups}
    vectors = {g: network.continuous_parents(g[0]) + list(g) for g in groups}
    used = sorted({c for s in [*families.values(), *gaussian.values()] for c in s})
    short = {c: f"d{i}" for i, c in enumerate(used)}
    numeric = sorted({c for v in vectors.values() for c in v})
    xs = {c: f"x{i}" for i, c in enumerate(numeric)}

    base = df.select(
        *[quoted(c).alias(short[c]) for c in used],
        *[(as_double(quoted(c), fields[c]) - F.lit(float(centres.get(c, 0.0)))).alias(xs[c]) for c in numeric],
        w.alias("w"))
    base = base.filter(F.col("w") > 0) if weight is not None else base

    sums: list[Column] = [F.sum("w").alias("w"), F.count(F.lit(1)).alias("c")]
    moment_names: list[str] = []
    for gi, g in enumerate(groups):
        vec = [F.col(xs[c]) for c in vectors[g]]
        here = vec[0].isNotNull()
        for v in vec[1:]:
            here = here & v.isNotNull()
        parts = {f"g{gi}n": F.when(here, F.col("w")), f"g{gi}c": F.when(here, F.lit(1))}
        for i, a in enumerate(vec):
            parts[f"g{gi}s{i}"] = F.when(here, F.col("w") * a)
            for j in range(i, len(vec)):
                parts[f"g{gi}q{i}_{j}"] = F.when(here, F.col("w") * a * vec[j])
        sums += [F.sum(e).alias(k) for k, e in parts.items()]
        moment_names += list(parts)

    keys = [short[c] for c in used]
    sets = list(dict.fromkeys(tuple(sorted(short[c] for c in s)) for s in [*families.values(), *gaussian.values()]))
    if keys and len(sets) > 1 and prod(len(network[c].states) + 1 for c in used) <= FOLD_CELLS:
        base = base.groupBy(*keys).agg(*sums)
        sums = [F.sum(n).alias(n) for n in ["w", "c"] + moment_names]
    if keys:
        stats = base.groupingSets([list(s) for s in sets], *keys).agg(
            F.grouping_id(*keys).alias("gid"), *sums)
    else:
        stats = base.agg(*sums).withColumn("gid", F.lit(0))

    def gid(columns) -> int:
        inside = {short[c] for c in columns}
        return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in inside)

    text = {c: state_text(F.col(short[c]), fields[c]) for c in used}
    valid = {c: state_index(F.col(short[c]), network[c].states, fields[c]).isNotNull() for c in used}
    none_d = F.lit(None).cast("array<double>")
    items = []
    for n in discrete:
        ok = F.col("gid") == gid(families[n])
        for c in families[n]:
            ok = ok & valid[c]
        items.append(F.when(ok, _cell(n, "cpt", network.parents(n), text, text[n], F.col("w"), F.col("c"), none_d, none_d)))
    for gi, g in enumerate(groups):
        ok = (F.col("gid") == gid(gaussian[g])) & (F.col(f"g{gi}n") > 0)
        for c in gaussian[g]:
            ok = ok & valid[c]
        d = len(vectors[g])
        first = F.array(*[F.col(f"g{gi}s{i}") for i in range(d)])
        second = F.array(*[F.col(f"g{gi}q{min(i, j)}_{max(i, j)}") for i in range(d) for j in range(d)])
        items.append(F.when(ok, _cell(g[0], "gauss", gaussian[g], text, F.lit(None).cast("string"),
                                      F.col(f"g{gi}n"), F.col(f"g{gi}c"), first, second)))
    return stats.select(F.explode(F.array_compact(F.array(*items))).alias("r")).select("r.*")


def _cell(node, kind, parents, text, state, w, rows, first, second) -> Column:
    parent_states = F.array(*[text[p] for p in parents]) if parents else F.array().cast("array<string>")
    return F.struct(
        F.lit(node).alias("node"), F.lit(kind).alias("kind"), parent_states.alias("parents"),
        _parent_key(parents, text).alias("parent_key"), state.alias("state"), w.alias("w"),
        rows.cast("bigint").alias("rows"), first.alias("sums"), second.alias("cross"))


def cpt_frame(stats: DataFrame) -> DataFrame:
    """`node, parent_key, state, w, n, p` as a distributed frame (for tables of any size)."""
    family = Window.partitionBy("node", "parent_key")
    return (stats.filter(F.col("kind") == "cpt")
            .select("node", "parent_key", "state", "w", F.col("rows").alias("n"),
                    (F.col("w") / F.sum("w").over(family)).alias("p")))


def moment_frame(stats: DataFrame, network: Network, centres: dict[str, float]) -> DataFrame:
    """`node, parent_key, n, w, mean[], cov[]` per Gaussian family (population moments;
    the vector is continuous parents first, then the node's own variables)."""
    shift: Column | None = None
    for g in network.nodes():
        if network[g[0]].kind == "continuous":
            vec = [float(centres.get(c, 0.0)) for c in network.continuous_parents(g[0]) + list(g)]
            arr = F.array(*[F.lit(v) for v in vec])
            shift = F.when(F.col("node") == g[0], arr) if shift is None else shift.when(F.col("node") == g[0], arr)
    g = stats.filter(F.col("kind") == "gauss").withColumn("shift", shift)
    g = g.withColumn("dev", F.transform("sums", lambda s: s / F.col("w")))
    d = F.size("dev")
    cov = F.transform(F.col("cross"), lambda q, i: q / F.col("w")
                      - F.get(F.col("dev"), F.floor(i / d).cast("int")) * F.get(F.col("dev"), i % d))
    return g.select("node", "parent_key", F.col("rows").alias("n"), "w",
                    F.zip_with("dev", "shift", lambda a, b: a + b).alias("mean"), cov.alias("cov"))


def fit(df: DataFrame, network: Network, *, weight: str | Column | None = None, alpha: float = 0.0):
    """Maximum-likelihood parameters of a fully observed network.

    Rows stay on the executors; only parameter cells come back, and their number is checked. Columns
    of too many states to list keep their families as tables (a `KeyedModel`, which score() takes too).
    """
    try:
        network, centres = discover(df, network)
    except TooManyStates:
        if alpha or isinstance(weight, Column):
            raise
        from posterion.operators.keyed import fit_keyed
        return fit_keyed(df, network, weight=weight)
    rows = collect_cells(statistics(df, network, centres, weight=weight))
    return Model.from_statistics(network, rows, centres, alpha=alpha)


def collect_cells(stats: DataFrame) -> list:
    rows = stats.limit(MAX_PARAMETERS + 1).collect()
    if len(rows) > MAX_PARAMETERS:
        raise ValueError(f"more than {MAX_PARAMETERS} parameters: keep cpt_frame() and score by join "
                         "(tables.lookup_probability)")
    return rows


def training_metrics(scored: DataFrame, model: Model, *, weight: str | None = None,
                     iterations: int = 1, converged: bool = True,
                     loglikelihood: str = "loglikelihood") -> DataFrame:
    """One row of training metrics from a table scored with `ModelStatistics`."""
    w = F.lit(1.0) if weight is None else quoted(weight).cast("double")
    k = model.network.free_parameters()
    agg = scored.agg(
        F.sum(w * quoted(loglikelihood)).alias("loglikelihood"),
        F.count(F.lit(1)).alias("case_count"),
        F.sum(w).alias("weighted_case_count"),
        F.count(F.lit(1)).alias("unweighted_case_count"))
    return agg.select(
        "loglikelihood", "case_count", "weighted_case_count", "unweighted_case_count",
        F.lit(iterations).cast("bigint").alias("iteration_count"), F.lit(converged).alias("converged"),
        (F.lit(-2.0) * F.col("loglikelihood") + F.lit(float(k)) * F.ln("weighted_case_count")).alias("bic"))
