"""Explaining a target state: which other states are typical for it.

Scenarios (evidence so far, model) are rows; every step of a greedy search is one small job
over all of them. Several models of one network are stacked into one model whose id is an
observed column (`validate.stack_models`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from posterion.functions.scalars import pack_state, quoted
from posterion.operators.posterior import pair_tables
from posterion.plans.model import Model

MODEL = "__model"


def explainable(model: Model, target: str) -> list[str]:
    net = model.network
    return [v.name for v in net.variables
            if v.kind == "discrete" and not v.latent and v.name != target and not v.selector]


def scenarios(spark: SparkSession, model: Model, evidence=({},), models=(None,)) -> DataFrame:
    """One row per (model, evidence): `scenario_id`, the evidence columns, and `__model`."""
    names = sorted({n for e in evidence for n in e})
    stacked = MODEL in model.network.names()
    rows = []
    for m in models:
        for e in evidence:
            rows.append((len(rows), *([str(m)] if stacked else []), *[e.get(n) for n in names]))
    schema = "scenario_id int" + (f", {MODEL} string" if stacked else "") + "".join(f", `{n}` string" for n in names)
    return spark.createDataFrame(rows, schema)


def calculate(frame: DataFrame, model: Model, target: str, state: str, *, key="scenario_id") -> DataFrame:
    """Per scenario and (variable, state): P(x|e), P(x|t,e), P(x|not t,e), P(t|x,e), their
    difference P(x|t)-P(x|not t) and lift P(x|t)/P(x).

    All measures come from the one joint table P(x, target | e) of each variable. Variables
    that are evidence of a scenario are left out of it.
    """
    key = [key] if isinstance(key, str) else list(key)
    names = explainable(model, target)
    joint = pair_tables(frame, model, names, key=key, target=target)
    # one small row per (scenario, variable, state) from here on
    per = joint.groupBy(*key, "variable", "state").agg(
        F.sum("probability").alias("probability"),
        F.sum(F.when(quoted(target) == state, F.col("probability")).otherwise(0.0)).alias("with_target"))
    per = per.withColumn("p_target", F.sum("with_target").over(Window.partitionBy(*key, "variable")))
    given = F.try_divide(F.col("with_target"), F.col("p_target"))
    other = F.try_divide(F.col("probability") - F.col("with_target"), F.lit(1.0) - F.col("p_target"))
    rows = per.select(*key, "variable", "state", "probability",
                      given.alias("probability_given_target"), other.alias("probability_given_other"),
                      F.try_divide(F.col("with_target"), F.col("probability")).alias("probability_target_given_this"),
                      (given - other).alias("difference"), F.try_divide(given, F.col("probability")).alias("lift"),
                      F.col("p_target").alias("probability_target"))
    seen = [v for v in names if v in frame.columns]
    if not seen:
        return rows
    marks = F.array_compact(F.array(*[F.when(quoted(v).isNotNull(), F.lit(v)) for v in seen]))
    known = frame.select(*key, F.explode(marks).alias("variable"))
    return rows.join(known, [*key, "variable"], "left_anti")


def top_per_scenario(frame: DataFrame, *, key: str = "scenario_id", by: str = "difference") -> DataFrame:
    """The best state of each scenario; values equal to twelve places tie, and names decide."""
    w = Window.partitionBy(key).orderBy(F.round(by, 12).desc_nulls_last(), "variable", "state")
    return frame.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def common_tuples(spark: SparkSession, model: Model, target: str, state: str, *, length: int = 2, top: int = 20,
                  models=(None,)) -> DataFrame:
    """From every starting state, greedily add the state with the largest difference;
    `evidence, difference, max_difference` averaged over models, best first (a top-k report)."""
    first = calculate(scenarios(spark, model, models=models), model, target, state)
    # one chain per (model, starting state); the number of chains is models x states
    chains = [(models[r["scenario_id"]], [(r["variable"], r["state"])], [r["difference"]])
              for r in first.orderBy("scenario_id", "variable", "state").collect()]
    for _ in range(length - 1):
        frame = _chain_scenarios(spark, model, [(m, dict(e)) for m, e, _ in chains])
        best = {r["scenario_id"]: r for r in top_per_scenario(calculate(frame, model, target, state)).collect()}
        for i, (m, e, d) in enumerate(chains):
            if i in best:
                e.append((best[i]["variable"], best[i]["state"]))
                d.append(best[i]["difference"])
    rows = [(",".join(f"{v}$${s}" for v, s in e), float(sum(d) / len(d)), float(sum(d))) for _, e, d in chains
            if all(x is not None for x in d)]
    frame = spark.createDataFrame(rows, "evidence string, difference double, max_difference double")
    return (frame.groupBy("evidence").agg(F.avg("difference").alias("difference"), F.avg("max_difference").alias("max_difference"))
            .orderBy(F.desc("max_difference"), "evidence").limit(top))


def _chain_scenarios(spark, model, chains) -> DataFrame:
    names = sorted({n for _, e in chains for n in e})
    stacked = MODEL in model.network.names()
    rows = [(i, *([str(m)] if stacked else []), *[e.get(n) for n in names]) for i, (m, e) in enumerate(chains)]
    schema = "scenario_id int" + (f", {MODEL} string" if stacked else "") + "".join(f", `{n}` string" for n in names)
    return spark.createDataFrame(rows, schema)


def _greedy(spark, model, target, state, models, steps: int, stop):
    """Greedy evidence chains of all models at once; `stop(chain)` ends a chain after a step."""
    chains = [{"model": m, "evidence": [], "difference": [], "probability": []} for m in models]
    live = list(range(len(chains)))
    for _ in range(steps):
        if not live:
            break
        frame = _chain_scenarios(spark, model, [(chains[i]["model"], dict(chains[i]["evidence"])) for i in live])
        best = {r["scenario_id"]: r for r in top_per_scenario(calculate(frame, model, target, state)).collect()}
        still = []
        for at, i in enumerate(live):
            if at not in best:
                continue
            r, c = best[at], chains[i]
            c["evidence"].append((r["variable"], r["state"]))
            c["difference"].append(r["difference"])
            c["probability"].append(r["probability_target"])
            if not stop(c):
                still.append(i)
        live = still
    return chains


def _steps_frame(spark, chains) -> DataFrame:
    rows = [(str(c["model"]), i, v, s, float(d) if d is not None else None, float(p))
            for c in chains for i, ((v, s), d, p) in enumerate(zip(c["evidence"], c["difference"], c["probability"]))]
    return spark.createDataFrame(rows, "model_id string, step int, variable string, state string, difference double, probability double")


def descriptive_combinations(spark, model, target, state, *, steps: int = 10, models=(None,)) -> DataFrame:
    """Greedy chains that stop after a difference below 0.05, with the chain's summed difference."""
    chains = _greedy(spark, model, target, state, models, steps, lambda c: c["difference"][-1] is None or c["difference"][-1] < 0.05)
    frame = _steps_frame(spark, chains)
    return frame.withColumn("max_difference", F.sum("difference").over(Window.partitionBy("model_id"))).orderBy("max_difference", "model_id", "step")


def top_variable_combinations(spark, model, target, state, *, top: int = 3, models=(None,)) -> DataFrame:
    """`top` greedy steps per model; per step the difference and P(t | evidence so far);
    chains with the largest probability first."""
    frame = _steps_frame(spark, _greedy(spark, model, target, state, models, top, lambda c: False))
    return frame.withColumn("max_probability", F.max("probability").over(Window.partitionBy("model_id"))).orderBy(
        F.desc("max_probability"), "model_id", "step")


def variable_combinations(spark, model, target, state, *, conditioned: int = 3, limit: int = 10, decimals: int = 4,
                          models=(None,)) -> DataFrame:
    """Greedy chains until P(t | evidence) is stable at `decimals` places; models are taken
    in order until `conditioned` + 1 chains end above 0.90, at most `limit`."""
    def stable(c):
        p = c["probability"]
        return len(p) > 1 and round(p[-1], decimals) == round(p[-2], decimals)
    chains = _greedy(spark, model, target, state, models[:limit], len(explainable(model, target)), stable)
    kept, over = [], 0
    for c in chains:
        kept.append(c)
        over += 1 if c["probability"] and c["probability"][-1] > 0.90 else 0
        if over > conditioned:
            break
    return _steps_frame(spark, kept)


def mean_over_models(rows: DataFrame) -> DataFrame:
    """Average of all measures per (variable, state) over models."""
    measures = ["probability", "probability_given_target", "probability_given_other", "probability_target_given_this",
                "difference", "lift"]
    return rows.groupBy("variable", "state").agg(*[F.avg(m).alias(m) for m in measures])


def exclusive_states(rows: DataFrame, *, top: int = 10, below: float = 0.02) -> DataFrame:
    """I4: states that hardly occur without the target, by difference (a top-k report)."""
    return (mean_over_models(rows).filter(F.col("probability_given_other") < below)
            .orderBy(F.desc("difference"), "variable", "state").limit(top))


def insightful_states(rows: DataFrame, *, using: str = "difference", top: int = 10) -> DataFrame:
    """States by mean difference or lift (a top-k report)."""
    if using not in ("difference", "lift"):
        raise ValueError("using is 'difference' (favours likely states) or 'lift' (relative change)")
    return mean_over_models(rows).orderBy(F.desc_nulls_last(using), "variable", "state").limit(top)


def summed_differences(rows: DataFrame, *, base: str = "probability_given_other", below: float | None = None,
                       low: float | None = None, high: float | None = None, top: int = 10) -> DataFrame:
    """Summed difference per state over models; I7 keeps rows with a base probability
    under `below` and a difference inside (low, high)."""
    kept = rows
    if below is not None:
        kept = kept.filter(F.col(base) < below)
    if low is not None:
        kept = kept.filter(F.col("difference") > low)
    if high is not None:
        kept = kept.filter(F.col("difference") < high)
    return (kept.groupBy("variable", "state").agg(F.sum("difference").alias("sum_difference"))
            .orderBy(F.desc("sum_difference"), "variable", "state").limit(top))


def exclusive_differences(rows: DataFrame, top: int = 10) -> DataFrame:
    """I7 with its fixed thresholds: base below 0.008, difference between 0.005 and 1."""
    return summed_differences(rows, below=0.008, low=0.005, high=1.0, top=top)


def enrich(chosen: DataFrame, rows: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """P(t | x) of the chosen states averaged over models; with `means(variable, state, mean,
    variance)` also the moments of the continuous column behind a cluster variable."""
    p = rows.groupBy("variable", "state").agg(F.avg("probability_target_given_this").alias("target_probability"))
    out = chosen.join(p, ["variable", "state"], "left")
    return out if means is None else out.join(means, ["variable", "state"], "left")


def cluster_rank(means: DataFrame, *, by=("model_id", "variable")) -> DataFrame:
    """Clusters numbered by their mean inside each model and variable, so that labels agree
    between models."""
    w = Window.partitionBy(*by).orderBy("mean", "k")
    return means.withColumn("rank", (F.row_number().over(w) - 1).cast("bigint"))


def rationalise(steps: DataFrame, num: int = 20) -> DataFrame:
    """Summed difference x probability per evidence item (a top-k report)."""
    return (steps.groupBy(pack_state(F.col("variable"), F.col("state")).alias("evidence"))
            .agg(F.sum(F.col("difference") * F.col("probability")).alias("score"))
            .orderBy(F.desc("score"), "evidence").limit(num))


def other_states(states: DataFrame, variable: Column | str, state: str) -> DataFrame:
    """All other states of the variable, from a states frame."""
    return states.filter((F.col("variable") == variable) & (F.col("state") != state))
