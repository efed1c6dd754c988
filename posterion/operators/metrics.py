"""Scores of predictions against actual values, lift tables and plot data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from posterion.functions.scalars import quoted
from posterion.operators.ranking import near_equal_groups
from posterion.sources.storage import reused


def r_squared(df: DataFrame, actual: str, predicted: str, *, by=()) -> DataFrame:
    """V1: 1 - residual sum of squares / total sum of squares, in one aggregate."""
    y, p = quoted(actual).cast("double"), quoted(predicted).cast("double")
    both = y.isNotNull() & p.isNotNull()
    err = F.when(both, (y - p) * (y - p))
    return df.groupBy(*[quoted(b) for b in by]).agg(
        (F.lit(1.0) - F.try_divide(F.sum(err), F.var_pop(F.when(both, y)) * F.count(err))).alias("r2"))


def accuracy(df: DataFrame, actual: str, predicted: str, *, weight: str | None = None, by=()) -> DataFrame:
    """V2/V6: (weighted) share of equal pairs among rows that have both."""
    same = (quoted(actual).cast("string") == quoted(predicted).cast("string")).cast("double")
    w = quoted(weight).cast("double") if weight else F.lit(1.0)
    value = F.try_divide(F.sum(w * same), F.sum(F.when(same.isNotNull(), w)))
    return df.groupBy(*[quoted(b) for b in by]).agg(value.alias("accuracy"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels) -> DataFrame:
    """V3: `actual, predicted, n, share` for every label pair, zero cells included."""
    labels = [str(s) for s in labels]
    counts = (df.groupBy(quoted(actual).cast("string").alias("actual"), quoted(predicted).cast("string").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    names = F.array(*[F.lit(s) for s in labels])
    grid = (df.sparkSession.range(1).select(F.explode(names).alias("actual"))
            .select("actual", F.explode(names).alias("predicted")))
    full = grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    total = F.sum("n").over(Window.partitionBy("actual"))
    return full.select("actual", "predicted", "n", F.try_divide(F.col("n").cast("double"), total).alias("share"))


def _cells(df: DataFrame, actual: str, predicted: str, positive: str) -> DataFrame:
    a = quoted(actual).cast("string") == str(positive)
    p = quoted(predicted).cast("string") == str(positive)
    return df.agg(*[F.count_if(c).cast("double").alias(n) for n, c in
                    (("tp", a & p), ("fn", a & ~p), ("fp", ~a & p), ("tn", ~a & ~p))])


def classification_measures(df: DataFrame, actual: str, predicted: str, positive: str) -> DataFrame:
    """V4: sensitivity, specificity, precision, their harmonic fmeasure and likelihood ratios
    (fmeasure combines sensitivity and specificity)."""
    base = _cells(df, actual, predicted, positive).select(
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("sensitivity"),
        F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))
    s, c = F.col("sensitivity"), F.col("specificity")
    return base.select("*", F.try_divide(F.lit(2.0) * s * c, s + c).alias("fmeasure"),
                       F.try_divide(s, F.lit(1.0) - c).alias("likelihood_ratio_positive"),
                       F.try_divide(F.lit(1.0) - s, c).alias("likelihood_ratio_negative"))


def predictive_values(df: DataFrame, actual: str, predicted: str, positive: str) -> DataFrame:
    """V5: positive and negative predictive value."""
    return _cells(df, actual, predicted, positive).select(
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("ppv"),
        F.try_divide(F.col("tn"), F.col("tn") + F.col("fn")).alias("npv"))


def cumulative_gains(df: DataFrame, *, id_col: str, probability: str, actual: str, predicted: str, positive: str,
                     groups: int = 10) -> DataFrame:
    """Rows predicted positive in near-equal groups by ascending probability, with
    running correct counts, best and average case, lift and response rate."""
    hit = quoted(actual).cast("string") == str(positive)
    chosen = df.filter(quoted(predicted).cast("string") == str(positive)).select(
        quoted(id_col), quoted(probability), hit.alias("__hit"))
    # locating the group boundaries takes several scans: they read three narrow columns
    ranked = near_equal_groups(reused(chosen), probability, id_col, groups, name="decile")
    per = ranked.groupBy("decile").agg(F.count(F.lit(1)).alias("cases"), F.count_if("__hit").alias("correct"))
    # from here on: one row per group
    upto = Window.partitionBy(F.lit(0)).orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("correct").over(Window.partitionBy(F.lit(0))).cast("double")
    t = per.select("*", F.sum("correct").over(upto).alias("running_correct"),
                   F.sum("cases").over(upto).alias("running_cases"), total.alias("t"))
    percent = F.try_divide(F.lit(100.0) * F.col("running_correct"), F.col("t"))
    best = F.least(F.lit(100.0), F.try_divide(F.lit(100.0) * F.col("running_cases"), F.col("t")))
    average = F.try_divide(F.lit(100.0) * F.col("decile") * (F.col("t") / groups), F.col("t"))
    return t.select("decile", "cases", "correct", F.col("running_correct"), percent.alias("percent_correct"),
                    F.when(F.col("t") > 0, best).alias("best_case"), (F.col("t") / groups).alias("average_case"),
                    average.alias("percent_average_case"), F.try_divide(percent, average).alias("lift"),
                    (F.col("correct") / F.col("cases")).alias("rate"))


def density_grid(df: DataFrame, column: str, components: DataFrame, *, mean: str = "mean", variance: str = "variance",
                 steps: int = 100) -> DataFrame:
    """`step, x, density`: the sum of the component densities on equal steps from the
    column's minimum less its standard deviation to its maximum plus it (end left out)."""
    c = quoted(column).cast("double")
    ends = df.agg((F.min(c) - F.stddev_samp(c)).alias("lo"), (F.max(c) + F.stddev_samp(c)).alias("hi"))
    grid = ends.select(F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(steps - 1)),
        lambda i: F.struct(i.alias("step"), (F.col("lo") + (F.col("hi") - F.col("lo")) * i / steps).alias("x")))).alias("g"))
    # the components are model parameters: one small array next to every grid point
    parts = components.agg(F.collect_list(F.struct(quoted(mean).alias("m"), quoted(variance).alias("v"))).alias("parts"))
    joined = grid.select("g.step", "g.x", F.lit(1).alias("k")).join(parts.withColumn("k", F.lit(1)), "k")
    pdf = F.aggregate("parts", F.lit(0.0), lambda acc, p: acc + F.exp(
        -(F.col("x") - p["m"]) * (F.col("x") - p["m"]) / (F.lit(2.0) * p["v"])) / F.sqrt(F.lit(2 * math.pi) * p["v"]))
    return joined.select("step", "x", pdf.alias("density"))


def axis_limits(df: DataFrame, columns, margin: float = 3.0) -> DataFrame:
    """`column_name, lo, hi`: minimum - 3 and maximum + 3 of each head column, one scan."""
    row = df.agg(*[F.struct(F.lit(c).alias("column_name"), (F.min(quoted(c)).cast("double") - margin).alias("lo"),
                            (F.max(quoted(c)).cast("double") + margin).alias("hi")).alias(f"c{i}")
                   for i, c in enumerate(columns)])
    return row.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(columns))])).alias("r")).select("r.*")


def ellipse(var_a: Column, var_b: Column, cov: Column, *, nstd: float = 2.0) -> dict[str, Column]:
    """Width, height and angle of the covariance ellipse (closed form for 2x2)."""
    half = (var_a + var_b) / 2
    root = F.sqrt((var_a - var_b) * (var_a - var_b) / 4 + cov * cov)
    l1, l2 = half + root, F.greatest(half - root, F.lit(0.0))
    flat = F.when(var_a >= var_b, 0.0).otherwise(90.0)
    angle = F.when(cov == 0, flat).otherwise(F.degrees(F.atan2(l1 - var_a, cov)))
    return {"width": F.lit(2.0 * nstd) * F.sqrt(l1), "height": F.lit(2.0 * nstd) * F.sqrt(l2), "angle": angle}


def covariance_ellipses(pairs: DataFrame, *, nstd: float = 2.0) -> DataFrame:
    """V20 on a `pair_moments` frame."""
    shapes = ellipse(F.col("var_a"), F.col("var_b"), F.col("cov_ab"), nstd=nstd)
    return pairs.select("*", *[e.alias(n) for n, e in shapes.items()])


def residuals(df: DataFrame, actual: str, mean: str, variance: str) -> DataFrame:
    """Residual and the one-sigma band around the prediction."""
    m, s = quoted(mean), F.sqrt(quoted(variance))
    return df.select("*", (quoted(actual).cast("double") - m).alias("residual"), (m - s).alias("lo"), (m + s).alias("hi"))


def cluster_accuracy(df: DataFrame, weights, correct: str) -> DataFrame:
    """Q18/V6: `cluster, accuracy`: accuracy weighted by membership, all clusters in one scan."""
    row = df.agg(*[F.struct(F.lit(i).alias("cluster"), F.try_divide(F.sum(quoted(w) * quoted(correct)), F.sum(quoted(w))).alias("accuracy"))
                   .alias(f"c{i}") for i, w in enumerate(weights)])
    return row.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(weights))])).alias("r")).select("r.*")


def virtual_accuracy(df: DataFrame, id_col: str, weights, correct: str) -> DataFrame:
    """Q18: each row's membership-weighted mean of the cluster accuracies."""
    by = {r["cluster"]: r["accuracy"] for r in cluster_accuracy(df, weights, correct).collect()}
    total = sum((quoted(w) for w in weights[1:]), quoted(weights[0]))
    value = sum((quoted(w) * F.lit(by[i] or 0.0) for i, w in enumerate(weights)), F.lit(0.0))
    return df.select(quoted(id_col), (value / total).alias("score"))
