"""Queries of splits, cross-validation, metrics and plot data, and the streaming score."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.models import FOLD_SQL, GAUSS, HEADS, OF, everyone
from catalogue.prepare import uniform_sql
from catalogue.scoring import GR_FIT, nb1
from catalogue.tables import (GR1, MG1, MX1, NB, NB1, NB1_CONTINUOUS, NB1_DISCRETE, NB_P, OC, TC, labelled, nb_ctes, order_cases, query,
                              rnd, table, turn_cases, with_ctes)
from posterion.operators import metrics as M
from posterion.operators import validate as V
from posterion.operators.fit import fit
from posterion.operators.posterior import gaussian_posterior, pair_moments
from posterion.operators.score import MeanVariance, ModelStatistics, MostLikelyState, StateProbability, score
from posterion.plans.templates import independent, mixture, naive_bayes
from posterion.sources.storage import stage_path
from posterion.streaming.scoring import read_stream, score_stream


def regression(spark, d):
    oc = order_cases(spark, d)
    return score(oc, fit(oc, GR1), [MeanVariance("price_k")])


@query("v1_r_squared", with_ctes(OC, GR_FIT) + """select round(1 - sum((price_k - a - b * sum_qty) * (price_k - a - b * sum_qty)) / (var_pop(price_k) * count(price_k)), 6) + 0.0 as r2 from oc, gr""")
def v1(spark, d):
    return M.r_squared(regression(spark, d), "price_k", "price_k_mean").select(rnd("r2", 6).alias("r2"))


def predicted(spark, d):
    return score(labelled(order_cases(spark, d)), nb1(spark, d), [MostLikelyState("any_return", "int"), StateProbability("any_return", "1")])


PRED = f"{NB}, {NB_P}, pr as (select case_id, any_return, pred::int as pred from npred where any_return is not null)"
CELLS = f"""{PRED}, cc as (select sum((any_return = 1 and pred = 1)::int)::double tp, sum((any_return = 1 and pred = 0)::int)::double fn,
  sum((any_return = 0 and pred = 1)::int)::double fp, sum((any_return = 0 and pred = 0)::int)::double tn from pr)"""


@query("v2_accuracy", with_ctes(PRED) + "select round(avg((any_return = pred)::int), 6) + 0.0 as accuracy from pr")
def v2(spark, d):
    return M.accuracy(predicted(spark, d), "any_return", "any_return_maxlikelihood").select(rnd("accuracy", 6).alias("accuracy"))


@query("v3_confusion_matrix", with_ctes(PRED) + """select cast(a as varchar) as actual, cast(p as varchar) as predicted, count(pr.case_id) as n,
  round(count(pr.case_id)::double / nullif((select count(*) from pr where any_return = a), 0), 6) + 0.0 as share
  from (select unnest([0, 1]) a) cross join (select unnest([0, 1]) p) left join pr on any_return = a and pred = p group by a, p""")
def v3(spark, d):
    m = M.confusion_matrix(predicted(spark, d), "any_return", "any_return_maxlikelihood", ["0", "1"])
    return m.select("actual", "predicted", "n", rnd("share", 6).alias("share"))


@query("v4_measures", with_ctes(CELLS) + """select round(s, 6) + 0.0 as sensitivity, round(c, 6) + 0.0 as specificity, round(tp / nullif(tp + fp, 0), 6) + 0.0 as precision,
  round(2 * s * c / nullif(s + c, 0), 6) + 0.0 as fmeasure, round(s / nullif(1 - c, 0), 6) + 0.0 as likelihood_ratio_positive,
  round((1 - s) / nullif(c, 0), 6) + 0.0 as likelihood_ratio_negative from (select *, tp / nullif(tp + fn, 0) s, tn / nullif(tn + fp, 0) c from cc)""")
def v4(spark, d):
    m = M.classification_measures(predicted(spark, d), "any_return", "any_return_maxlikelihood", "1")
    return m.select(*[rnd(c, 6).alias(c) for c in m.columns])


@query("v5_predictive_values", with_ctes(CELLS) + "select round(tp / nullif(tp + fp, 0), 6) + 0.0 as ppv, round(tn / nullif(tn + fn, 0), 6) + 0.0 as npv from cc")
def v5(spark, d):
    m = M.predictive_values(predicted(spark, d), "any_return", "any_return_maxlikelihood", "1")
    return m.select(*[rnd(c, 6).alias(c) for c in m.columns])


@query("v6_weighted_accuracy", with_ctes(PRED) + "select round(sum(n_lines * (pr.any_return = pred)::int)::double / sum(n_lines), 6) + 0.0 as accuracy from pr join oc using (case_id)")
def v6(spark, d):
    return M.accuracy(predicted(spark, d), "any_return", "any_return_maxlikelihood", weight="n_lines").select(rnd("accuracy", 6).alias("accuracy"))


HASH7 = "('0x' || substr(md5(cast(case_id as varchar) || ':7'), 1, 8))::ubigint"


@query("v7_kfold", with_ctes(OC) + f"select case_id, {FOLD_SQL} as fold from oc")
def v7(spark, d):
    return V.hash_folds(order_cases(spark, d).select("case_id"), "case_id", 3, 7, name="fold")


@query("v7_kfold_exact", with_ctes(OC) + f"select case_id, (ntile(3) over (order by {HASH7}, case_id) - 1)::int as fold from oc")
def v7e(spark, d):
    return V.exact_folds(order_cases(spark, d).select("case_id"), "case_id", 3, 7, name="fold")


@query("v8_stratified_kfold", with_ctes(OC) + f"select case_id, any_return, (ntile(3) over (partition by any_return order by {HASH7}, case_id) - 1)::int as fold from oc")
def v8(spark, d):
    return V.exact_folds(order_cases(spark, d).select("case_id", "any_return"), "case_id", 3, 7, stratify="any_return", name="fold")


@query("v9_custom_split", with_ctes(OC) + "select 'train' as part, count(*) as n from oc where o_totalprice < 200000 union all select 'test', count(*) from oc where n_lines > 4")
def v9(spark, d):
    oc = order_cases(spark, d)
    train, test = V.custom_split(oc, F.col("o_totalprice") < 200000, F.col("n_lines") > 4)
    return train.agg(F.lit("train").alias("part"), F.count(F.lit(1)).alias("n")).unionByName(
        test.agg(F.lit("test").alias("part"), F.count(F.lit(1)).alias("n")))


@query("v10_train_test_split", with_ctes(OC) + f"select case_id, {uniform_sql('case_id', 7)} < 0.33 as is_test from oc")
def v10(spark, d):
    return V.train_test_split(order_cases(spark, d).select("case_id"), "case_id", seed=7)


@query("v11_same_rows", with_ctes(PRED) + "select count(*) as n_train, count(*) as n_test, round(avg((any_return = pred)::int), 6) + 0.0 as accuracy from pr")
def v11(spark, d):
    train, test = V.same_rows(labelled(order_cases(spark, d)))
    scored = score(test, fit(train, NB1), [MostLikelyState("any_return", "int")])
    right = (F.col("any_return_maxlikelihood") == F.col("any_return")).cast("double")
    return scored.agg(F.count(F.lit(1)).alias("n_train"), F.count(F.lit(1)).alias("n_test"), rnd(F.avg(right), 6).alias("accuracy"))


@query("v12_split_parts", with_ctes(OC, f"f as (select case_id, ({HASH7} % 4)::int as fold from oc)") + """select k as fold, sum((fold <> k)::int)::bigint as n_train,
  sum((fold = k)::int)::bigint as n_test from f cross join (select unnest([0, 1, 2, 3]) k) group by k""")
def v12(spark, d):
    folded = V.hash_folds(order_cases(spark, d), "case_id", 4, 7, name="fold")
    parts = None
    for k in range(4):
        train, test = V.split(folded, k, name="fold")
        one = train.select(F.lit(k).alias("fold"), F.lit(1).alias("t"), F.lit(0).alias("s")).unionByName(
            test.select(F.lit(k).alias("fold"), F.lit(0).alias("t"), F.lit(1).alias("s")))
        parts = one if parts is None else parts.unionByName(one)
    return parts.groupBy("fold").agg(F.sum("t").alias("n_train"), F.sum("s").alias("n_test"))


NB_PLAIN = naive_bayes("any_return", discrete=NB1_DISCRETE)


def accuracy_sql(label, terms):
    return (f"select fold, '{label}' as template, avg(case when k = any_return then 1.0 else 0.0 end) as accuracy from (select fold, k, any_return, "
            f"row_number() over (partition by case_id order by {' + '.join(terms)} desc, k) r from ns) where r = 1 group by fold")


@query("v13_cross_validation", with_ctes(OF) + "select fold, template, round(accuracy, 6) + 0.0 as accuracy from (("
       + accuracy_sql("mixed", ["s"]) + ") union all (" + accuracy_sql("discrete", ["prior", "t_size_band", "t_o_orderpriority"]) + "))")
def v13(spark, d):
    df = V.hash_folds(order_cases(spark, d), "case_id", 3, 7)
    r = V.cross_validate(df, {"mixed": NB1, "discrete": NB_PLAIN}, "any_return", k=3)
    return r.select("fold", "template", rnd("accuracy", 6).alias("accuracy"))


def lone_sql(column):
    return (f"l_{column} as (select ff, {column} v, count(*)::double / sum(count(*)) over (partition by ff) p from ntrx where {column} is not null group by 1, 2)")


def lone_gauss(column):
    return f"l_{column} as (select ff, avg({column}) m, greatest(var_pop({column}), 1e-6) v from ntrx group by 1)"


LONE = ", ".join([lone_sql("any_return"), lone_sql("size_band"), lone_sql("o_orderpriority"), lone_gauss("sum_qty"), lone_gauss("price_k")])


@query("v14_held_out_loglikelihood", with_ctes(OF, LONE) + """select 'naive' as label, count(*) as n, round(avg(s), 6) + 0.0 as mean_ll from ns where k = any_return
  union all select 'independent', count(*), round(avg(ln(a.p) + ln(b.p) + ln(c.p) + """ + """(-0.5 * ln(2 * pi() * q.v) - (of.sum_qty - q.m) * (of.sum_qty - q.m) / (2 * q.v))
  + (-0.5 * ln(2 * pi() * w.v) - (of.price_k - w.m) * (of.price_k - w.m) / (2 * w.v))), 6) + 0.0
  from of join l_any_return a on a.ff = fold and a.v = any_return join l_size_band b on b.ff = fold and b.v = size_band join l_o_orderpriority c on c.ff = fold and c.v = o_orderpriority
  join l_sum_qty q on q.ff = fold join l_price_k w on w.ff = fold""")
def v14(spark, d):
    df = V.hash_folds(labelled(order_cases(spark, d)), "case_id", 3, 7)
    lone = independent(discrete=["any_return", *NB1_DISCRETE], continuous=NB1_CONTINUOUS)
    ll = V.held_out_loglikelihood(df, {"naive": NB1, "independent": lone}, id_col="case_id", k=3)
    return ll.groupBy("label").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("loglikelihood"), 6).alias("mean_ll"))


@query("v15_discretisation_analysis")
def v15(spark, d):
    oc = order_cases(spark, d).select("case_id", "sum_qty", "n_lines")
    return V.discretisation_analysis(oc, ["sum_qty", "n_lines"], id_col="case_id", iterations=5, seed=7)


@query("v16_cluster_count")
def v16(spark, d):
    df = V.hash_folds(turn_cases(spark, d).select("case_id", "role", "text_len"), "case_id", 3, 7)
    return V.held_out_mixture(df, lambda k: mixture(discrete=["role"], continuous=["text_len"], latent_states=k), range(1, 5),
                              k=3, iterations=5, start="text_len")


GAINS = f"""{PRED}, g0 as (select pr.case_id, any_return, round(n.p, 9) p from pr join (select case_id, p from npost where k = 1) n using (case_id) where pred = 1),
g1 as (select *, ntile(10) over (order by p, case_id) decile from g0),
g2 as (select decile::int decile, count(*) cases, sum((any_return = 1)::int)::bigint correct from g1 group by 1),
g3 as (select *, sum(correct) over (order by decile)::bigint running_correct, sum(cases) over (order by decile) running_cases, sum(correct) over ()::double t from g2)"""


@query("v17_cumulative_gains", with_ctes(GAINS) + """select decile, cases, correct, running_correct, round(100.0 * running_correct / t, 6) + 0.0 as percent_correct,
  round(least(100.0, 100.0 * running_cases / t), 6) + 0.0 as best_case, round(t / 10, 6) + 0.0 as average_case, round(100.0 * decile * (t / 10) / t, 6) + 0.0 as percent_average_case,
  round((100.0 * running_correct / t) / (100.0 * decile * (t / 10) / t), 6) + 0.0 as lift from g3""")
def v17(spark, d):
    g = gains(spark, d)
    return g.select("decile", "cases", "correct", "running_correct", *[rnd(c, 6).alias(c) for c in
                    ("percent_correct", "best_case", "average_case", "percent_average_case", "lift")])


def gains(spark, d):
    p = predicted(spark, d).withColumn("p", F.round("any_return_probability", 9))
    return M.cumulative_gains(p, id_col="case_id", probability="p", actual="any_return", predicted="any_return_maxlikelihood", positive="1")


@query("v18_response_rate", with_ctes(GAINS) + "select decile, round(correct::double / cases, 6) + 0.0 as rate from g3")
def v18(spark, d):
    return gains(spark, d).select("decile", rnd("rate", 6).alias("rate"))


@query("v19_density_grid", with_ctes(OC, GAUSS, "e as (select min(sum_qty) - stddev_samp(sum_qty) lo, max(sum_qty) + stddev_samp(sum_qty) hi from oc where any_return is not null)",
       "x as (select i::int step, lo + (hi - lo) * i / 100 x from e cross join (select unnest(range(100)) i))") + """select step, round(x, 6) + 0.0 as x,
  round(sum(exp(-(x - ma) * (x - ma) / (2 * va)) / sqrt(2 * pi() * va)), 9) + 0.0 as density from x cross join c group by step, x""")
def v19(spark, d):
    oc = labelled(order_cases(spark, d))
    parts = gaussian_posterior(everyone(spark, d), fit(oc, NB1), ["sum_qty"], key="scenario_id", tail=["any_return"]).select(
        F.get("mean", F.lit(0)).alias("mean"), F.get("cov", F.lit(0)).alias("variance"))
    return M.density_grid(oc, "sum_qty", parts).select("step", rnd("x", 6).alias("x"), rnd("density", 9).alias("density"))


@query("v20_covariance_ellipse", with_ctes(OC, GAUSS, """l as (select k, va, c, (va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + c * c) l1,
  greatest((va + vb) / 2 - sqrt((va - vb) * (va - vb) / 4 + c * c), 0) l2 from c)""") + """select cast(k as varchar) as any_return, round(6 * sqrt(l1), 4) + 0.0 as width,
  round(6 * sqrt(l2), 4) + 0.0 as height, round(degrees(atan2(l1 - va, c)), 4) + 0.0 as angle from l""")
def v20(spark, d):
    model = fit(labelled(order_cases(spark, d)), MG1)
    pairs = pair_moments(gaussian_posterior(everyone(spark, d), model, HEADS, key="scenario_id", tail=["any_return"]), HEADS, *HEADS)
    e = M.covariance_ellipses(pairs, nstd=3.0)
    return e.select("any_return", *[rnd(c, 4).alias(c) for c in ("width", "height", "angle")])


@query("v20_axis_limits", with_ctes(OC) + """select 'sum_qty' as column_name, min(sum_qty) - 3 as lo, max(sum_qty) + 3 as hi from oc
  union all select 'price_k', round(min(price_k) - 3, 6), round(max(price_k) + 3, 6) from oc""")
def v20b(spark, d):
    return M.axis_limits(order_cases(spark, d), HEADS).select("column_name", rnd("lo", 6).alias("lo"), rnd("hi", 6).alias("hi"))


@query("v21_residuals", with_ctes(OC, GR_FIT) + """select case_id, round(price_k - m, 5) + 0.0 as residual, round(m - sqrt(v), 5) + 0.0 as lo, round(m + sqrt(v), 5) + 0.0 as hi
  from (select case_id, price_k, a + b * coalesce(sum_qty, mx) as m, case when sum_qty is null then s2 + b * b * vx else s2 end as v from oc, gr)""")
def v21(spark, d):
    r = M.residuals(regression(spark, d), "price_k", "price_k_mean", "price_k_variance")
    return r.select("case_id", *[rnd(c, 5).alias(c) for c in ("residual", "lo", "hi")])


# -- streaming -----------------------------------------------------------------

EVENT_NB = f"""ev as (select event_id as case_id, event_type, value from events), {nb_ctes('e', 'ev', 'event_type', [], ['value'])},
  ell as (select case_id, s ll from es where k = event_type)"""


@query("x1_streaming_score", with_ctes(EVENT_NB) + "select case_id, round(ll, 6) + 0.0 as loglikelihood from ell")
def x1(spark, d):
    events = table(spark, d, "events")
    cases = events.select(F.col("event_id").alias("case_id"), "event_type", "value")
    model = fit(cases, naive_bayes("event_type", continuous=["value"]))
    stream = read_stream(spark, d, events.schema, pattern="events.parquet").select(F.col("event_id").alias("case_id"), "event_type", "value")
    out = stage_path(spark, "stream-scores")
    score_stream(stream, model, [ModelStatistics()], path=out, checkpoint=stage_path(spark, "stream-state"), id_col="case_id", append=False)
    return spark.read.parquet(out).select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"))
