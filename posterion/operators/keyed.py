"""Networks with columns of very many states: big families stay distributed tables.

A keyed column (a product, a user) never lists its states. Its families are counted by its value and
written as one table: a row per value, and in it one array per family with the log probabilities over the
family's other members, which have few states (`DENSE` cells at most). Scoring meets the table by the
value: each row receives arrays, and these are factors on top of the network that is left, which
the junction trees answer with any gaps. Values that are frequent in the training table meet by a
broadcast of at most `HOT_BYTES`; the others, and rows without a value, spread evenly over the shuffle.

What a missing value of the keyed column means is worked out once, as one factor over the states
around it (its sum over all values), so such rows need no join either.

Limits, refused when the model is fitted: keyed columns have no keyed or continuous neighbours with
further continuous links; Gaussian families under a keyed column have discrete parents only. A row with a
missing key and a value of a Gaussian column under it has no closed form over all keys and gets
null answers.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field, replace
from itertools import product
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from posterion.functions.scalars import VARIANCE_FLOOR, as_double, quoted, state_index, state_text
from posterion.operators.fit import MAX_STATES, collect_cells, discover, statistics
from posterion.operators.inference import Batch, fresh_name, inputs, plan_answers, prior_marginals
from posterion.operators.junction import Engine, log_sum
from posterion.plans.model import Model
from posterion.plans.network import Network, Variable
from posterion.sources.storage import stage_path

STATES = MAX_STATES          # columns beyond so many values in all are keyed
DENSE = 10_000               # cells of a family (without its keyed column) in one array
HOT_BYTES = 8 << 20          # arrays of frequent values that may be sent to every executor
HOT_SHARE = 1_000            # a value with more than 1 / HOT_SHARE of all rows is frequent


@dataclass(frozen=True)
class Family:
    """A family around a keyed column: its arrays run over `scope`. Gaussian ones hold means and variances."""
    node: str
    key: str
    scope: tuple[str, ...]
    gaussian: bool = False


@dataclass
class KeyedModel:
    """network (keyed columns without states), the model that is left, and per keyed column its table:
    key, w (training weight), one array column f<i> (Gaussian: m<i> and v<i>) per family."""
    network: Network
    base: Model
    families: tuple[Family, ...]
    tables: dict[str, DataFrame]
    absent: dict[str, tuple[tuple[str, ...], list[float]]] = field(default_factory=dict)

    @property
    def keyed(self) -> tuple[str, ...]:
        return tuple(self.tables)

    def of(self, key: str) -> list[tuple[int, Family]]:
        return [(i, f) for i, f in enumerate(self.families) if f.key == key]

    def family_frame(self, node: str) -> DataFrame:
        """P1/P2 of a family around a keyed column, in long form: key, scope states, and p or mean and variance."""
        i, f = next((i, f) for i, f in enumerate(self.families) if f.node == node)
        states = [self.network[v].states for v in f.scope]
        combos = F.array(*[F.struct(F.lit(k).alias("at"), *[F.lit(s).alias(v) for v, s in zip(f.scope, c)]) for k, c in enumerate(product(*states))])
        rows = self.tables[f.key].select(F.col("key").alias(f.key), *([f"m{i}", f"v{i}"] if f.gaussian else [f"f{i}"]), F.explode(combos).alias("c"))
        value = [F.get(f"m{i}", F.col("c.at")).alias("mean"), F.get(f"v{i}", F.col("c.at")).alias("variance")] if f.gaussian else [
            F.exp(F.get(f"f{i}", F.col("c.at"))).alias("p")]
        out = rows.select(quoted(f.key), *[F.col(f"c.{v}").alias(v) for v in f.scope], *value)
        return out.filter(F.col("mean").isNotNull() if f.gaussian else F.col("p") > 0)

    def save(self, spark: SparkSession, path: str) -> None:
        """The model that is left, the tables as they are, and a JSON line for the rest."""
        self.base.save(spark, f"{path}/base")
        spec = {"variables": [[v.name, v.kind, list(v.states), v.latent, v.selector] for v in self.network.variables],
                "edges": [list(e) for e in self.network.edges], "blocks": [list(b) for b in self.network.blocks],
                "families": [[f.node, f.key, list(f.scope), f.gaussian] for f in self.families], "keyed": list(self.tables),
                "absent": {k: [list(s), [v if math.isfinite(v) else None for v in a]] for k, (s, a) in self.absent.items()}}
        for i, table in enumerate(self.tables.values()):
            table.write.mode("overwrite").parquet(f"{path}/key{i}")
        spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/keyed")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "KeyedModel":
        """The tables are read when rows are scored; nothing of them comes to the driver."""
        spec = json.loads(spark.read.text(f"{path}/keyed").head()[0])
        network = Network(tuple(Variable(n, k, tuple(s), *rest) for n, k, s, *rest in spec["variables"]), tuple(map(tuple, spec["edges"])),
                          tuple(map(tuple, spec["blocks"])))
        absent = {k: (tuple(s), [-math.inf if v is None else v for v in a]) for k, (s, a) in spec["absent"].items()}
        return KeyedModel(network, Model.load(spark, f"{path}/base"), tuple(Family(n, k, tuple(s), g) for n, k, s, g in spec["families"]),
                          {k: spark.read.parquet(f"{path}/key{i}") for i, k in enumerate(spec["keyed"])}, absent)


def wide_columns(df: DataFrame, network: Network, limit: int = STATES) -> list[str]:
    """The discrete columns of most values (counted approximately, in one scan), as many as leave the others fewer
    than `limit` in all."""
    names = [n for n in network.observed("discrete") if not network[n].states]
    if not names:
        return []
    row = df.agg(*[F.approx_count_distinct(quoted(n), 0.02).alias(f"a{i}") for i, n in enumerate(names)]).head()
    sizes = sorted(((row[f"a{i}"], n) for i, n in enumerate(names)), reverse=True)
    wide = []
    while sizes and sum(a for a, _ in sizes) > 0.9 * limit:
        wide.append(sizes.pop(0)[1])
    return sorted(wide, key=names.index)


def fit_keyed(df: DataFrame, network: Network, keyed=None, *, weight: str | None = None, dense: int = DENSE) -> KeyedModel:
    """Maximum-likelihood parameters with the `keyed` columns (by default those of more than STATES values) kept as
    tables. Families without them are learned as ever; nothing that grows with the number of keys is collected."""
    keyed = list(keyed if keyed is not None else wide_columns(df, network))
    for k in keyed:
        if network[k].kind != "discrete" or network[k].latent:
            raise ValueError(f"{k} cannot be keyed: it is no observed discrete column")
    around = {n for k in keyed for n in (k, *network.children(k))}
    families = []
    rest, _ = discover(df, network.without(keyed)) if len(keyed) < len(network.variables) else (network.without(keyed), {})
    network = replace(network, variables=tuple(rest[v.name] if v.name not in keyed else v for v in network.variables))
    for n in network.order():
        members = [*network.parents(n), n]
        keys = [m for m in members if m in keyed]
        if not keys:
            if around & set(network.continuous_parents(n)):
                raise ValueError(f"{n} has a continuous parent under a keyed column")
            continue
        if len(keys) > 1 or network.continuous_parents(n) or len(network.members(n)) > 1:
            raise ValueError(f"the family of {n} has several keyed columns, or continuous links")
        gaussian = network[n].kind == "continuous"
        scope = tuple(m for m in members if m not in keys and network[m].kind == "discrete")
        if network.grid_size(scope) > dense:
            raise ValueError(f"the family of {n} has more than {dense} cells beside its key")
        families.append(Family(n, keys[0], scope, gaussian))
    base_net = _left_over(network, keyed, families)
    tables = {k: _key_table(df, network, k, [(i, f) for i, f in enumerate(families) if f.key == k], weight) for k in keyed}
    base = Model(base_net, {}, {})
    if base_net.variables:
        centres = discover(df, base_net)[1]
        base = Model.from_statistics(base_net, collect_cells(statistics(df, base_net, centres, weight=weight)), centres)
    model = KeyedModel(network, base, tuple(families), tables)
    model.absent = {k: _absent(model, k) for k in keyed}
    return model


def _left_over(network: Network, keyed, families) -> Network:
    """The network without keyed columns: nodes whose family is a table keep no links of their own."""
    gone = {f.node for f in families if f.gaussian}
    inner = network.without([*keyed, *gone])
    own = {f.node for f in families}
    return Network(inner.variables, tuple(e for e in inner.edges if e[1] not in own), inner.blocks)


def _key_table(df: DataFrame, network: Network, key: str, families, weight: str | None) -> DataFrame:
    fields = {f.name: f.dataType for f in df.schema.fields}
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    text = state_text(quoted(key), fields[key])

    def place(scope) -> Column:
        at = F.lit(0)
        for v in scope:
            at = at * F.lit(len(network[v].states)) + state_index(quoted(v), network[v].states, fields[v])
        return at

    def cells(name: str, value: Column, size: int, default: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at(value, i), default)).alias(name)

    out = df.filter(text.isNotNull()).groupBy(text.alias("key")).agg(F.sum(w).alias("w"))
    for i, f in families:
        size = prod(len(network[v].states) for v in f.scope)
        rows = df.select(text.alias("key"), place(f.scope).alias("at"), w.alias("w"),
                         (as_double(quoted(f.node), fields[f.node]) if f.gaussian else F.lit(0.0)).alias("x")).dropna().filter("w > 0")
        if f.gaussian:
            centre = rows.agg(F.avg("x")).head()[0] or 0.0
            dev = F.col("x") - F.lit(centre)
            part = rows.groupBy("key", "at").agg(F.sum("w").alias("n"), F.sum(F.col("w") * dev).alias("s"), F.sum(F.col("w") * dev * dev).alias("q"))
            part = part.select("key", "at", (F.col("s") / F.col("n") + centre).alias("m"),
                               F.greatest(F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2), F.lit(VARIANCE_FLOOR)).alias("v"))
            maps = part.groupBy("key").agg(*[F.map_from_entries(F.collect_list(F.struct("at", c))).alias(c) for c in ("m", "v")])
            nothing = F.lit(None).cast("double")
            got = maps.select("key", cells(f"m{i}", F.col("m"), size, nothing), cells(f"v{i}", F.col("v"), size, nothing))
        else:
            counts = rows.groupBy("key", "at").agg(F.sum("w").alias("n"))
            maps = counts.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("n"))
            arrays = maps.select("key", cells("n", F.col("n"), size, F.lit(0.0)))
            if f.node == key:            # P(key | scope): totals run over all keys, and are few
                total = {r["at"]: r["n"] for r in rows.groupBy("at").agg(F.sum("w").alias("n")).collect()}
                keys = out.count()
                const = F.array(*[F.lit(float(total.get(k, 0.0))) for k in range(size)])
                logs = F.zip_with("n", const, lambda a, t: F.when(t <= 0, F.lit(-math.log(max(keys, 1)))).when(a > 0, F.ln(a / t)).otherwise(F.lit(-math.inf)))
            else:                        # P(node | scope, key): totals over the node's own states, which come last
                own = len(network[f.node].states)
                sums = F.transform(F.sequence(F.lit(0), F.lit(size // own - 1)), lambda k: F.aggregate(F.slice("n", k * own + 1, F.lit(own)), F.lit(0.0), lambda a, b: a + b))
                logs = F.transform("n", lambda a, k: F.when(F.get(F.col("sums"), F.floor(k / own).cast("int")) <= 0, F.lit(-math.log(own)))
                                   .when(a > 0, F.ln(a / F.get(F.col("sums"), F.floor(k / own).cast("int")))).otherwise(F.lit(-math.inf)))
                arrays = arrays.withColumn("sums", sums)
            got = arrays.select("key", logs.alias(f"f{i}"))
        out = out.join(got, "key", "left")
    path = stage_path(df.sparkSession, "keys")
    out.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _aligned(scope, array, union, cards) -> np.ndarray:
    """Factor array[row, *scope] on the axes of `union`."""
    order = sorted(range(len(scope)), key=lambda k: union.index(scope[k]))
    array = array.reshape(len(array), *[cards[v] for v in scope]).transpose(0, *[k + 1 for k in order])
    return array.reshape(len(array), *[cards[v] if v in scope else 1 for v in union])


def _absent(model: KeyedModel, key: str) -> tuple[tuple[str, ...], list[float]]:
    """ln of the sum over all keys of the product of the key's discrete families, as an array over all their members."""
    own = [(i, f) for i, f in model.of(key) if not f.gaussian]
    union = tuple(sorted({v for _, f in own for v in f.scope}))
    cards = {v: len(model.network[v].states) for v in union}
    size = prod(cards.values())
    if size > 10 * DENSE:
        raise ValueError(f"the columns around {key} have more than {10 * DENSE} combinations")
    fill = {i: (-math.log(len(model.network[f.node].states)) if f.node != key else -math.inf) for i, f in own}
    step = max(1, 2_000_000 // size)

    def partial(batches):
        total = np.full(size, -np.inf)
        for b in batches:
            for at in range(0, b.num_rows, step):
                table = np.zeros((1,) * (1 + len(union)))
                for c, (i, f) in enumerate(own):
                    # a key that a family has not met is uniform there
                    n = prod(cards[v] for v in f.scope)
                    met, found = _stacked(b.column(c).slice(at, step), n)
                    values = np.full((len(met), n), fill[i])
                    values[met] = found
                    table = table + _aligned(f.scope, values, union, cards)
                total = np.logaddexp(total, log_sum(np.broadcast_to(table, (len(table), *[cards[v] for v in union])), (0,)).ravel())
        yield pa.RecordBatch.from_pydict({"at": np.arange(size, dtype=np.int32), "value": total})

    parts = model.tables[key].select(*[f"f{i}" for i, _ in own]).mapInArrow(partial, "at int, value double").filter("value > double('-infinity')")
    top = parts.groupBy("at").agg(F.max("value").alias("top"))
    found = parts.join(top, "at").groupBy("at").agg((F.ln(F.sum(F.exp(F.col("value") - F.col("top")))) + F.max("top")).alias("value")).collect()
    out = [-math.inf] * size
    for r in found:
        out[r["at"]] = float(r["value"])
    return union, out


def met_by_key(df: DataFrame, key: Column, table: DataFrame, names: dict[str, str]) -> DataFrame:
    """df with columns of the key's table row (new name -> table column), null where the key is missing or unknown.

    Frequent keys are broadcast: they are few by definition, and their arrays are held to HOT_BYTES. The
    other rows meet by shuffle; rows that have no key or a frequent one carry a key of their own there."""
    cells = max(1, table.select(F.max(sum((F.coalesce(F.size(c), F.lit(0)) for c in names.values() if c != "w"), F.lit(1)))).head()[0] or 1)
    keep = max(1, min(HOT_SHARE, HOT_BYTES // (8 * cells)))
    total = table.agg(F.sum("w")).head()[0] or 0.0
    columns = [F.col(c).alias(n) for n, c in names.items()]
    often = F.col("w") > F.lit(total / keep)         # fewer than `keep` keys can hold more than that each
    hot = table.filter(often).select(F.col("key").alias("__hot"), *[c.alias(f"{n}__h") for n, c in zip(names, columns)])
    cold = table.filter(~often).select(F.col("key").alias("__cold"), *[c.alias(f"{n}__c") for n, c in zip(names, columns)])
    met = df.withColumn("__key", key).join(F.broadcast(hot), F.col("__key") == F.col("__hot"), "left")
    own = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    met = met.withColumn("__key", F.when(F.col("__key").isNull() | F.col("__hot").isNotNull(), own).otherwise(F.col("__key")))
    met = met.join(cold, F.col("__key") == F.col("__cold"), "left")
    return met.select(*[quoted(c) for c in df.columns], *[F.coalesce(F.col(f"{n}__h"), F.col(f"{n}__c")).alias(n) for n in names])


def score_keyed(df: DataFrame, model: KeyedModel, queries=None, *, id_col: str | None = None, evidence=None, append: bool = True) -> DataFrame:
    """Q1, Q3-Q7 with keyed columns: any gaps, keyed or not. Queries may name columns that are not keyed."""
    from posterion.operators.score import LogLikelihood, MeanVariance, ModelStatistics, check_query
    net = model.network
    queries = list(queries) if queries else [ModelStatistics()]
    outer = {f.node: (i, f) for i, f in enumerate(model.families) if f.gaussian}
    for q in queries:
        check_query(q, net)
        if getattr(q, "variable", None) in model.keyed or isinstance(q, ModelStatistics) and q.conflict:
            raise ValueError("keyed columns are evidence; conflict is not asked of them")
        if isinstance(q, LogLikelihood) and set(q.variables) & set(outer) or isinstance(q, MeanVariance) and q.variable in outer:
            raise ValueError(f"{q} asks for a Gaussian column under a keyed one")
    fields = {f.name: f.dataType for f in df.schema.fields}
    usable = [n for n in net.observed() if n in fields and (evidence is None or n in evidence)]
    rows, arrays = df, {}
    for n, key in enumerate(k for k in model.keyed if k in usable):
        names = {f"__k{n}_w": "w"}
        for i, f in model.of(key):
            for c in ((f"m{i}", f"v{i}") if f.gaussian else (f"f{i}",)):
                names[f"__k_{c}"] = c
                arrays[c] = f"__k_{c}"
        rows = met_by_key(rows, state_text(quoted(key), fields[key]), model.tables[key], names)
        arrays[f"key:{key}"] = f"__k{n}_w"
    bound = inputs(rows, model.base, usable)
    names = list(bound)
    values = {n: as_double(quoted(n), fields[n]) for n in outer if n in usable}
    requests, columns = plan_answers(model.base, queries)
    schema = ", ".join(f"a{i} {kind}" for i, (_, kind, _, _) in enumerate(columns))
    sent = [*bound.values(), *values.values(), *[F.col(c) for c in arrays.values()]]
    outside = list(values)
    base, families, absent, keys = model.base, model.families, model.absent, model.keyed
    order = {c: len(bound) + len(values) + i for i, c in enumerate(arrays)}
    cards = {v: len(net[v].states) for v in net.names("discrete")}
    touched = frozenset(f.node for f in families if not f.gaussian and f.node not in keys)
    held: list = []

    @F.arrow_udf(schema)
    def answer(*cols: pa.Array) -> pa.Array:
        if not held:
            held.append(Engine(base, ones=touched))
        engine, n = held[0], len(cols[0])
        if n:
            plain = [c.to_numpy(zero_copy_only=False).astype(float) for c in cols[:len(names) + len(outside)]]
            given, x = dict(zip(names, plain)), dict(zip(outside, plain[len(names):]))
            data = {v: given.get(v, np.full(n, np.nan)) for v in base.network.names()}
            extra, lost = _row_factors(families, absent, keys, cards, cols, order, x, n)
            batch = Batch(engine, requests, data, n, extra=extra)
            batch.priors = lambda which: prior_marginals(engine, which)
            found = [np.where(lost, np.nan, of(batch)) for _, _, of, _ in columns]
        else:
            found = [np.empty(0)] * len(columns)
        return pa.StructArray.from_arrays([pa.array(f.astype(float), pa.float64(), from_pandas=True) for f in found], [f"a{i}" for i in range(len(columns))])

    name = fresh_name(rows, "__answers")
    scored = rows.select(*[quoted(c) for c in df.columns], answer(*(sent or [F.lit(0.0)])).alias(name))
    taken = {c[0] for c in columns}
    keep = df.columns if append else ([id_col] if id_col else [])
    last = [(finish(F.col(name)[f"a{i}"]) if finish else F.col(name)[f"a{i}"]).alias(c) for i, (c, _, _, finish) in enumerate(columns)]
    return scored.select(*[quoted(c) for c in keep if c not in taken], *last)


def _stacked(lists: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(which rows have an array, the arrays of these as one table); gaps in arrays are NaN."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    return lists.is_valid().to_numpy(zero_copy_only=False), flat.reshape(-1, size)


def _row_factors(families, absent, keys, cards, cols, order, x, n):
    """(factors of all keyed columns for a batch, rows that no closed form answers)."""
    extra, lost = [], np.zeros(n, bool)
    for key in keys:
        mark = f"key:{key}"
        here = cols[order[mark]].is_valid().to_numpy(zero_copy_only=False) if mark in order else np.zeros(n, bool)
        union, gone = absent[key]
        table = np.zeros((n, *[cards[v] for v in union]))
        table[~here] = np.array(gone, float).reshape([cards[v] for v in union])
        extra.append((union, table))
        for i, f in enumerate(families):
            if f.key != key:
                continue
            shape = [cards[v] for v in f.scope]
            table = np.zeros((n, prod(shape)))
            if f.gaussian:
                v = x.get(f.node, np.full(n, np.nan))
                seen = ~np.isnan(v)
                lost |= seen & ~here
                table[seen & here] = -np.inf         # a Gaussian that was never seen
                if mark in order:
                    (met, m), (_, s) = (_stacked(cols[order[f"{c}{i}"]], prod(shape)) for c in "mv")
                    with np.errstate(invalid="ignore"):
                        dens = -0.5 * np.log(2 * np.pi * s) - (v[met, None] - m) ** 2 / (2 * s)
                    table[seen & here & met] = np.where(np.isnan(dens), -np.inf, dens)[(seen & here)[met]]
            elif mark in order:
                met, found = _stacked(cols[order[f"f{i}"]], prod(shape))
                # a key that this family has not met is uniform there
                table[here] = -math.log(cards[f.node]) if f.node != key else -math.inf
                table[here & met] = found[here[met]]
            extra.append((f.scope, table.reshape(n, *shape)))
    return extra, lost
