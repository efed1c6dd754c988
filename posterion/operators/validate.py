"""Splits and cross-validation. The fold id is a column; all fold models are fitted from one
scan (total minus own fold) and scored in one scan (the fold picks the parameters)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from posterion.functions.scalars import finite, hash_bits, hash_uniform, quoted
from posterion.operators.fit import collect_cells, discover, statistics
from posterion.operators.mixture import (Run, column_starts, held_out_loglikelihoods, hub_of, run_batch, starting_model,
                                         training_loglikelihoods)
from posterion.operators.ranking import group_of_rank, hashed_rank
from posterion.operators.score import ModelStatistics, MostLikelyState, score
from posterion.plans.model import Model, Moments
from posterion.plans.network import Network, Variable
from posterion.plans.templates import mixture
from posterion.sources.storage import reused

FOLD = "__fold"


def hash_folds(df: DataFrame, id_col: str, k: int = 3, seed=0, *, name: str = FOLD) -> DataFrame:
    """A stable fold 0..k-1 per id; sizes are near-equal, and no shuffle is needed."""
    if k <= 1:
        raise ValueError("at least two folds are needed")
    return df.withColumn(name, (hash_bits(quoted(id_col), seed) % k).cast("int"))


def exact_folds(df: DataFrame, id_col: str, k: int = 3, seed=0, *, stratify: str | None = None,
                name: str = FOLD) -> DataFrame:
    """V7 with exact sizes, or V8 balanced within each class of `stratify`."""
    if k <= 1:
        raise ValueError("at least two folds are needed")
    ranked = hashed_rank(df, id_col, seed, by=stratify, name="__rank")
    fold = group_of_rank(F.col("__rank"), F.col("__rank_of"), k) - 1
    return ranked.withColumn(name, fold.cast("int")).drop("__rank", "__rank_of")


def split(df: DataFrame, fold: int, *, name: str = FOLD) -> tuple[DataFrame, DataFrame]:
    """Train (all other folds) and test (this fold)."""
    return df.filter(quoted(name) != fold), df.filter(quoted(name) == fold)


def custom_split(df: DataFrame, train: Column, test: Column) -> tuple[DataFrame, DataFrame]:
    """V9: the caller's two predicates."""
    return df.filter(train), df.filter(test)


def train_test_split(df: DataFrame, id_col: str, test_share: float = 0.33, seed=0, *, name: str = "is_test") -> DataFrame:
    """One reproducible random split."""
    return df.withColumn(name, hash_uniform(quoted(id_col), seed) < test_share)


def same_rows(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test on the same rows."""
    return df, df


def fit_folds(df: DataFrame, network: Network, k: int, *, weight: str | None = None, alpha: float = 0.0,
              fold: str = FOLD, known: tuple[Network, dict[str, float]] | None = None) -> Model:
    """One model whose parameters are indexed by fold, each fitted on all other folds."""
    network, centres = known or discover(df, network)
    whole = network.with_common_parent(Variable(fold, "discrete", tuple(str(i) for i in range(k))))
    cells = collect_cells(statistics(df, whole, centres, weight=weight))
    return Model.from_statistics(whole, _complement(whole, cells, k, fold), centres, alpha=alpha)


def _complement(network: Network, cells, k: int, fold: str) -> list[dict]:
    """Statistics of 'all but fold f' from per-fold statistics: total minus own."""
    groups: dict = {}
    out: list[dict] = []
    for r in cells:
        if r["node"] == fold:
            out.append({**r.asDict(), "w": 1.0})
            continue
        at = network.discrete_parents(r["node"]).index(fold)
        key = tuple(r["parents"])
        groups.setdefault((r["node"], r["kind"], key[:at] + key[at + 1:], r["state"], at), {})[int(key[at])] = r
    for (node, kind, rest, state, at), by in groups.items():
        for f in range(k):
            others = [r for g, r in by.items() if g != f]
            w = sum(r["w"] for r in others)
            if w <= 0:
                continue
            row = {"node": node, "kind": kind, "parents": list(rest[:at] + (str(f),) + rest[at:]), "state": state, "w": w,
                   "sums": None, "cross": None}
            if kind == "gauss":
                row["sums"] = [sum(v) for v in zip(*[r["sums"] for r in others])]
                row["cross"] = [sum(v) for v in zip(*[r["cross"] for r in others])]
            out.append(row)
    return out


def stack_models(models: dict[str, Model], variable: str) -> Model:
    """Several models of one network as one model indexed by a common parent."""
    first = next(iter(models.values()))
    network = first.network.with_common_parent(Variable(variable, "discrete", tuple(models)))
    tables: dict = {n: {} for n in network.names("discrete")}
    moments: dict = {g[0]: {} for g in network.nodes() if network[g[0]].kind == "continuous"}
    tables[variable][()] = {m: 1.0 / len(models) for m in models}
    for name, model in models.items():
        for source, target in ((model.tables, tables), (model.moments, moments)):
            for n, rows in source.items():
                at = network.discrete_parents(n).index(variable)
                for key, value in rows.items():
                    target[n][key[:at] + (name,) + key[at:]] = value
    return Model(network, tables, moments)


def cross_validate(df: DataFrame, templates: dict[str, Network], target: str, *, k: int = 3, weight: str | None = None,
                   alpha: float = 0.0, fold: str = FOLD) -> DataFrame:
    """`fold, template, accuracy` of the held-out most likely state.

    Columns with a single state are left out; a column without children that has a single state in
    a fold's training part is left out of that fold. Per template: one scan for states, one to fit
    all folds, one to score.
    """
    result = None
    for label, network in templates.items():
        rows = df.filter(quoted(target).isNotNull())
        found, centres = discover(rows, network)
        kept = found.without([n for n in found.observed("discrete") if n != target and len(found[n].states) <= 1])
        model = fit_folds(rows, kept, k, weight=weight, alpha=alpha, fold=fold, known=(kept, centres))
        for n in kept.observed("discrete"):
            if n != target and not kept.children(n):
                _leave_out_where_single(model, n, fold)
        scored = score(df, model, [MostLikelyState(target, suffix="__predicted")])
        right = (quoted(f"{target}__predicted") == quoted(target).cast("string")).cast("double")
        part = scored.groupBy(quoted(fold).alias("fold")).agg(F.avg(right).alias("accuracy")).select(
            "fold", F.lit(label).alias("template"), "accuracy")
        result = part if result is None else result.unionByName(part)
    return result


def _leave_out_where_single(model: Model, node: str, fold: str) -> None:
    """Uniform families for the folds in whose training part the node has one state: it then says nothing."""
    at, states = model.network.parents(node).index(fold), model.network[node].states
    seen: dict[str, set] = {}
    for key, row in model.tables[node].items():
        seen.setdefault(key[at], set()).update(s for s, p in row.items() if p > 0)
    for key in model.tables[node]:
        if len(seen[key[at]]) <= 1:
            model.tables[node][key] = dict.fromkeys(states, 1.0 / len(states))


def held_out_loglikelihood(df: DataFrame, templates: dict[str, Network], *, id_col: str, k: int = 3, target: str | None = None,
                           weight: str | None = None, fold: str = FOLD) -> DataFrame:
    """`id, label, loglikelihood` of every held-out case; infinities are null. Only
    templates over the same columns may be compared."""
    sets = {frozenset(n.observed()) for n in templates.values()}
    if len(sets) > 1:
        raise ValueError("loglikelihoods are comparable only across the same variables")
    result = None
    for label, network in templates.items():
        rows = df.filter(quoted(target).isNotNull()) if target else df
        model = fit_folds(rows, network, k, weight=weight, fold=fold)
        scored = score(df, model, [ModelStatistics()], id_col=id_col, append=False)
        part = scored.select(quoted(id_col), F.lit(label).alias("label"), _less_fold(F.col("loglikelihood"), k).alias("loglikelihood"))
        result = part if result is None else result.unionByName(part)
    return result


def _less_fold(ll: Column, k: int) -> Column:
    """The fold's own uniform prior is no part of the case's likelihood."""
    return finite(ll) + F.lit(math.log(k))


def held_out_mixture(df: DataFrame, network_of, counts, *, k: int = 3, iterations: int = 20, tolerance: float = 1e-6,
                     start: str | None = None, fold: str = FOLD) -> DataFrame:
    """`clusters, mean_ll`: held-out loglikelihood per number of clusters. All folds of
    all counts learn in the same scans, and every start comes from the training part alone."""
    table = reused(df)
    counts = list(counts)
    runs, centres = [], {}
    for c in counts:
        network, centres = discover(table, network_of(c))       # names of states and the origin of the sums
        runs += [Run(starting_model(table.filter(quoted(fold) != f), network, start=start)[1], fold=f) for f in range(k)]
    run_batch(table, runs, centres, iterations=iterations, tolerance=tolerance, fold=fold)
    held = held_out_loglikelihoods(table, runs, fold=fold)
    n = table.count()
    rows = [(c, float(sum(held[i * k:(i + 1) * k]) / n)) for i, c in enumerate(counts)]
    return df.sparkSession.createDataFrame(rows, "clusters int, mean_ll double")


def discretisation_analysis(df: DataFrame, columns, *, id_col: str, clusters=(1, 5, 10, 20, 30), k: int = 3, seed=0,
                            iterations: int = 10, tolerance: float = 1e-6, threshold: int = 5) -> DataFrame:
    """Per column the cluster count with the best training loglikelihood (mean over folds,
    weighted by training size); more than `threshold` clusters suggest discretising.

    Equal values are folded into one weighted row per fold first; all counts and folds of a
    column then share each scan. Starts come from the training part alone, and the compared
    loglikelihood is that of the parameters learned last.
    """
    folded = hash_folds(df, id_col, k, seed)
    rows = []
    for c in columns:
        table = reused(folded.filter(quoted(c).isNotNull()).groupBy(quoted(c), quoted(FOLD)).agg(
            F.count(F.lit(1)).cast("double").alias("__weight")))
        total = table.agg(F.sum("__weight")).head()[0] or 0.0
        if not total:                                   # a column without a value has nothing to discretise
            continue
        runs, centres = [], {}
        for f in range(k):
            starts, centres = column_starts(table.filter(quoted(FOLD) != f), c, lambda n: mixture(continuous=[c], latent_states=n),
                                            clusters, weight="__weight")
            runs += [Run(first, fold=f) for first in starts]
        run_batch(table, runs, centres, iterations=iterations, tolerance=tolerance, weight="__weight", fold=FOLD)
        best: dict[int, float] = {}
        for r, ll in zip(runs, training_loglikelihoods(table, runs, weight="__weight", fold=FOLD)):
            n = len(r.model.network[hub_of(r.model.network)].states)
            best[n] = best.get(n, 0.0) + ll / (total * (k - 1))
        rows += [(c, n, float(v)) for n, v in sorted(best.items())]
    spark = df.sparkSession
    scores = spark.createDataFrame(rows, "column_name string, clusters int, mean_ll double")
    from pyspark.sql import Window
    w = Window.partitionBy("column_name").orderBy(F.desc("mean_ll"), "clusters")
    return (scores.withColumn("r", F.row_number().over(w)).filter("r = 1")
            .select("column_name", F.col("clusters").alias("best_k"), (F.col("clusters") > threshold).alias("discretise")))
