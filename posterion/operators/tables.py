"""Jobs on probability tables: lookup, completion, divorcing nodes, distances, state grids."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from posterion.functions.scalars import key_text, quoted, state_text
from posterion.plans.network import Network
from posterion.sources.storage import sized


def lookup_probability(df: DataFrame, cpt: DataFrame, node: str, parents, *, name: str = "p") -> DataFrame:
    """The probability of each row's state given its parents' states.

    A join on (parent key, state), so the table may be of any size; a table counted to be small
    is broadcast, so a parent combination shared by many rows is no hot key. Rows with a
    missing value get null.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    parents = sorted(parents)
    key = F.concat(*[F.concat(F.lit(("|" if i else "") + f"{p}="), key_text(state_text(quoted(p), fields[p])))
                     for i, p in enumerate(parents)]) if parents else F.lit("")
    table = cpt.filter(F.col("node") == node).select(
        F.col("parent_key").alias("__pk"), F.col("state").alias("__st"), F.col("p").alias("__p"))
    keyed = df.withColumn("__k", key).withColumn("__s", state_text(quoted(node), fields[node]))
    joined = keyed.join(sized(table), (F.col("__k") == F.col("__pk")) & (F.col("__s") == F.col("__st")), "left")
    return joined.select(*[quoted(c) for c in df.columns], F.col("__p").alias(name))


def total_probability(df: DataFrame, cpt: DataFrame, node: str, parents) -> DataFrame:
    """Sum of the looked-up probabilities of all rows (state combinations)."""
    return lookup_probability(df, cpt, node, parents).agg(F.sum("p").alias("total_probability"))


def state_grid(spark: SparkSession, network: Network, names) -> DataFrame:
    """Every combination of the states of the named variables, one column each."""
    grid = spark.range(1).select(F.lit(1).alias("__one"))
    for n in names:
        grid = grid.withColumn(n, F.explode(F.array(*[F.lit(s) for s in network[n].states])))
    return grid.drop("__one")


def _family_grid(spark: SparkSession, network: Network, node: str) -> DataFrame:
    parents = network.parents(node)
    grid = state_grid(spark, network, [*parents, node])
    key = F.concat_ws("|", *[F.concat(F.lit(f"{p}="), key_text(quoted(p))) for p in parents]) if parents else F.lit("")
    return grid.select(F.lit(node).alias("node"), key.alias("parent_key"), quoted(node).alias("state"))


def complete(cpt: DataFrame, network: Network, nodes) -> DataFrame:
    """The full (parents x states) grid of each node. Families never seen are uniform, and
    missing states of a seen family have probability 0."""
    result = None
    for n in nodes:
        grid = _family_grid(cpt.sparkSession, network, n)
        j = grid.join(cpt.select("node", "parent_key", "state", "p"), ["node", "parent_key", "state"], "left")
        seen = F.max(F.col("p").isNotNull().cast("int")).over(Window.partitionBy("node", "parent_key"))
        part = j.select("node", "parent_key", "state",
                        F.when(seen == 0, F.lit(1.0 / len(network[n].states))).otherwise(F.coalesce("p", F.lit(0.0))).alias("p"))
        result = part if result is None else result.unionByName(part)
    return result


def complete_with_remainder(cpt: DataFrame, network: Network, node: str) -> DataFrame:
    """The last state of each family gets 1 - the sum of the others."""
    states = network[node].states
    grid = _family_grid(cpt.sparkSession, network, node)
    j = grid.join(cpt.select("node", "parent_key", "state", "p"), ["node", "parent_key", "state"], "left")
    last = F.col("state") == states[-1]
    others = F.sum(F.when(~last, F.coalesce("p", F.lit(0.0))).otherwise(0.0)).over(Window.partitionBy("node", "parent_key"))
    return j.select("node", "parent_key", "state", F.when(last, F.lit(1.0) - others).otherwise(F.coalesce("p", F.lit(0.0))).alias("p"))


def missing_families(cpt: DataFrame, network: Network, nodes) -> DataFrame:
    """Parent combinations without parameters (anti join of the grid)."""
    result = None
    for n in nodes:
        part = _family_grid(cpt.sparkSession, network, n).select("node", "parent_key").distinct()
        result = part if result is None else result.unionByName(part)
    return result.join(cpt.select("node", "parent_key").distinct(), ["node", "parent_key"], "left_anti")


def divorcing_probability(df: DataFrame, id_col: str, parents, states) -> DataFrame:
    """`id, state, p`: the share of the row's parent columns that are in the state."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    values = F.array(*[state_text(quoted(p), fields[p]) for p in parents])
    long = df.select(quoted(id_col), values.alias("__v"), F.explode(F.array(*[F.lit(s) for s in states])).alias("state"))
    hits = F.size(F.filter("__v", lambda v: v == F.col("state")))
    return long.select(quoted(id_col), "state", (hits / F.lit(float(len(parents)))).alias("p"))


@dataclass(frozen=True)
class StateSpec:
    """Wanted states of one variable and the number each state stands for."""
    states: tuple[str, ...]
    values: dict[str, float] = field(hash=False, default_factory=dict)
    flexible: bool = True


def distance(df: DataFrame, specs: dict[str, StateSpec], *, name: str = "distance") -> DataFrame:
    """Sum over variables of the smallest distance to a wanted state; a mismatch of an
    inflexible variable gives 2 x the number of variables."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    total, broken = F.lit(0.0), F.lit(False)
    for n, spec in specs.items():
        text = state_text(quoted(n), fields[n])
        expr = None
        for s, v in spec.values.items():
            d = F.lit(float(min(abs(v - spec.values[w]) for w in spec.states)))
            expr = F.when(text == s, d) if expr is None else expr.when(text == s, d)
        total = total + expr
        if not spec.flexible:
            broken = broken | ~text.isin(list(spec.states))
    return df.withColumn(name, F.when(broken, F.lit(2.0 * len(specs))).otherwise(total))
