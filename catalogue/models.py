"""Queries of model-level posteriors, probability tables and variable selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import (DN, DN1, DN_CPT, DN_WIDE, MG1, NB1, NB1_CONTINUOUS, NB1_DISCRETE, OC, dn_cases, labelled, nb_ctes,
                              order_cases, query, rnd, table, with_ctes)
from posterion.operators import selection as S
from posterion.operators import tables as W
from posterion.operators.fit import cpt_frame, discover, fit, statistics
from posterion.operators.posterior import (difference, gaussian_posterior, pair_moments, posterior, state_posteriors)
from posterion.operators.validate import hash_folds


def everyone(spark, d):
    """One scenario without evidence, derived from the case table."""
    return table(spark, d, "orders").agg(F.lit(0).alias("scenario_id"))


def dn1(spark, d):
    return fit(dn_cases(spark, d), DN1)


@query("m1_joint", with_ctes(DN, DN_WIDE) + "select any_return, o_orderpriority, round(sum(p), 6) + 0.0 as probability from joint group by 1, 2")
def m1(spark, d):
    return posterior(everyone(spark, d), dn1(spark, d), ["any_return", "o_orderpriority"], key="scenario_id").select(
        "any_return", "o_orderpriority", rnd("probability", 6).alias("probability"))


@query("m2_conditional_joint", with_ctes(DN, DN_WIDE) + """select any_return, size_band, round(sum(p) / sum(sum(p)) over (partition by size_band), 6) + 0.0 as probability
  from joint group by 1, 2""")
def m2(spark, d):
    return posterior(everyone(spark, d), dn1(spark, d), ["any_return"], tail=["size_band"], key="scenario_id").select(
        "any_return", "size_band", rnd("probability", 6).alias("probability"))


GAUSS = """c as (select any_return k, count(*)::double / sum(count(*)) over () p, avg(sum_qty) ma, avg(price_k) mb, greatest(var_pop(sum_qty), 1e-6) va,
  greatest(var_pop(price_k), 1e-6) vb, covar_pop(sum_qty, price_k) c from oc where any_return is not null group by 1)"""


def pair_out(frame, heads, *keys):
    p = pair_moments(frame, heads, *heads)
    return p.select(*keys, "distribution", rnd("mean_a", 4).alias("mean_a"), rnd("mean_b", 4).alias("mean_b"), rnd("var_a", 3).alias("var_a"),
                    rnd("var_b", 3).alias("var_b"), rnd("cov_ab", 3).alias("cov_ab"), rnd("std_a", 5).alias("std_a"), rnd("std_b", 5).alias("std_b"))


MOMENTS = """round(ma, 4) + 0.0 as mean_a, round(mb, 4) + 0.0 as mean_b, round(va, 3) + 0.0 as var_a, round(vb, 3) + 0.0 as var_b,
  round({cov}, 3) + 0.0 as cov_ab, round(sqrt(va), 5) + 0.0 as std_a, round(sqrt(vb), 5) + 0.0 as std_b"""
HEADS = ["sum_qty", "price_k"]


@query("m3_gaussian_given_class", with_ctes(OC, GAUSS) + "select cast(k as varchar) as any_return, 'P(sum_qty, price_k | any_return=' || k || ')' as distribution, "
       + MOMENTS.format(cov="0.0::double") + " from c")
def m3(spark, d):
    model = fit(labelled(order_cases(spark, d)), NB1)
    return pair_out(gaussian_posterior(everyone(spark, d), model, HEADS, key="scenario_id", tail=["any_return"]), HEADS, "any_return")


@query("m4_gaussian_no_tail", with_ctes(OC, GAUSS, """t as (select sum(p * ma) ma, sum(p * mb) mb, sum(p * (va + ma * ma)) - sum(p * ma) * sum(p * ma) va,
  sum(p * (vb + mb * mb)) - sum(p * mb) * sum(p * mb) vb, sum(p * ma * mb) - sum(p * ma) * sum(p * mb) c from c)""")
       + "select 'P(sum_qty, price_k)' as distribution, " + MOMENTS.format(cov="c") + " from t")
def m4(spark, d):
    model = fit(labelled(order_cases(spark, d)), NB1)
    return pair_out(gaussian_posterior(everyone(spark, d), model, HEADS, key="scenario_id"), HEADS)


@query("m5_pair_moments", with_ctes(OC, GAUSS) + "select cast(k as varchar) as any_return, 'P(sum_qty, price_k | any_return=' || k || ')' as distribution, "
       + MOMENTS.format(cov="c") + " from c")
def m5(spark, d):
    model = fit(labelled(order_cases(spark, d)), MG1)
    return pair_out(gaussian_posterior(everyone(spark, d), model, HEADS, key="scenario_id", tail=["any_return"]), HEADS, "any_return")


LONG_JOINT = """jl as (select 'size_band' as variable, size_band as state, any_return, p from joint union all select 'o_orderpriority', o_orderpriority, any_return, p from joint
  union all select 'qty_band', qty_band, any_return, p from joint)"""


@query("m6_posterior_difference", with_ctes(DN, DN_WIDE, LONG_JOINT) + """select variable, state, round(b, 6) + 0.0 as base_probability, round(n, 6) + 0.0 as probability,
  round(n - b, 6) + 0.0 as difference from (select variable, state, sum(case when any_return = '0' then p else 0 end) / sum(sum(case when any_return = '0' then p else 0 end)) over (partition by variable) b,
  sum(case when any_return = '1' then p else 0 end) / sum(sum(case when any_return = '1' then p else 0 end)) over (partition by variable) n from jl group by 1, 2)""")
def m6(spark, d):
    model = dn1(spark, d)
    # the scenarios are the classes seen in the data
    classes = labelled(order_cases(spark, d)).select("any_return").distinct().withColumn("scenario_id", F.col("any_return"))
    p = state_posteriors(classes, model, ["size_band", "o_orderpriority", "qty_band"], key="scenario_id")
    return difference(p.filter("scenario_id = 0"), p.filter("scenario_id = 1")).select(
        "variable", "state", rnd("base_probability", 6).alias("base_probability"), rnd("probability", 6).alias("probability"),
        rnd("difference", 6).alias("difference"))


# -- tables --------------------------------------------------------------------

def dn_tables(spark, d):
    df = dn_cases(spark, d)
    network, centres = discover(df, DN1)
    return df, network, cpt_frame(statistics(df, network, centres))


@query("w8_probability_lookup", with_ctes(DN, DN_WIDE) + """select case_id, round(r.p, 6) + 0.0 as p from dn left join p_ret r
  on r.size_band = dn.size_band and r.qty_band = dn.qty_band and r.any_return = dn.any_return""")
def w8(spark, d):
    df, network, cpt = dn_tables(spark, d)
    return W.lookup_probability(df, cpt, "any_return", network.parents("any_return")).select("case_id", rnd("p", 6).alias("p"))


@query("w8_total_probability", with_ctes(DN, DN_WIDE) + """select round(sum(r.p), 4) + 0.0 as total_probability from dn join p_ret r
  on r.size_band = dn.size_band and r.qty_band = dn.qty_band and r.any_return = dn.any_return""")
def w8t(spark, d):
    df, network, cpt = dn_tables(spark, d)
    return W.total_probability(df, cpt, "any_return", network.parents("any_return")).select(rnd("total_probability", 4).alias("total_probability"))


GRID = """grid as (select s.size_band, q.qty_band, r.any_return from (select distinct size_band from dn where size_band is not null) s
  cross join (select distinct qty_band from dn where qty_band is not null) q cross join (select distinct any_return from dn where any_return is not null) r),
  pm as (select size_band, qty_band, any_return, count(*)::double / sum(count(*)) over (partition by size_band, qty_band) p from dn
    where any_return is not null and size_band is not null and qty_band is not null group by 1, 2, 3)"""


@query("w9_complete_uniform", with_ctes(DN, GRID) + """select 'any_return' as node, 'qty_band=' || g.qty_band || '|size_band=' || g.size_band as parent_key, cast(g.any_return as varchar) as state,
  round(case when max(p) over (partition by g.size_band, g.qty_band) is null then 0.5 else coalesce(p, 0) end, 6) + 0.0 as p from grid g left join pm using (size_band, qty_band, any_return)""")
def w9(spark, d):
    _, network, cpt = dn_tables(spark, d)         # some families have no case: small orders of large quantity
    return W.complete(cpt, network, ["any_return"]).select("node", "parent_key", "state", rnd("p", 6).alias("p"))


@query("w9_remainder", with_ctes(DN, GRID) + """select 'any_return' as node, 'qty_band=' || g.qty_band || '|size_band=' || g.size_band as parent_key, cast(g.any_return as varchar) as state,
  round(case when g.any_return = 1 then 1 - sum(case when g.any_return = 0 then coalesce(p, 0) else 0 end) over (partition by g.size_band, g.qty_band) else coalesce(p, 0) end, 6) + 0.0 as p
  from grid g left join pm using (size_band, qty_band, any_return)""")
def w9r(spark, d):
    _, network, cpt = dn_tables(spark, d)         # some families have no case: small orders of large quantity
    return W.complete_with_remainder(cpt, network, "any_return").select("node", "parent_key", "state", rnd("p", 6).alias("p"))


BANDS = """bands as (select case_id, size_band as a, case when last_line <= 2 then 'S' when last_line <= 5 then 'M' when last_line > 5 then 'L' end as b,
  case when sum_qty <= 50 then 'S' when sum_qty <= 130 then 'M' when sum_qty > 130 then 'L' end as c from oc)"""


@query("w10_divorcing", with_ctes(OC, BANDS) + """select case_id, state, round(((case when a = state then 1 else 0 end) + (case when b = state then 1 else 0 end)
  + (case when c = state then 1 else 0 end)) / 3.0::double, 6) + 0.0 as p from bands cross join (select unnest(['S', 'M', 'L']) as state)""")
def w10(spark, d):
    oc = order_cases(spark, d)
    def band(c, lo, hi):
        return F.when(F.col(c) <= lo, "S").when(F.col(c) <= hi, "M").when(F.col(c) > hi, "L")
    df = oc.select("case_id", F.col("size_band").alias("a"), band("last_line", 2, 5).alias("b"), band("sum_qty", 50, 130).alias("c"))
    return W.divorcing_probability(df, "case_id", ["a", "b", "c"], ["S", "M", "L"]).select("case_id", "state", rnd("p", 6).alias("p"))


@query("w11_state_distance", with_ctes(OC) + """select case_id, case when any_return <> 1 then 4.0::double
  else case size_band when 'S' then 1 when 'M' then 0 when 'L' then 1 end + abs(any_return - 1) end::double as distance from oc where any_return is not null""")
def w11(spark, d):
    specs = {"size_band": W.StateSpec(("M",), {"S": 0.0, "M": 1.0, "L": 2.0}),
             "any_return": W.StateSpec(("1",), {"0": 0.0, "1": 1.0}, flexible=False)}
    return W.distance(labelled(order_cases(spark, d)), specs).select("case_id", "distance")


@query("w12_state_grid", with_ctes(OC) + """select size_band, o_orderpriority, any_return from (select distinct size_band from oc where size_band is not null)
  cross join (select distinct o_orderpriority from oc) cross join (select distinct cast(any_return as varchar) any_return from oc where any_return is not null)""")
def w12(spark, d):
    network, _ = discover(order_cases(spark, d), NB1)
    return W.state_grid(spark, network, ["size_band", "o_orderpriority", "any_return"])


# -- variable selection ----------------------------------------------------------

FEATURES = NB1_DISCRETE + NB1_CONTINUOUS
FOLD_SQL = "(('0x' || substr(md5(cast(case_id as varchar) || ':7'), 1, 8))::ubigint % 3)::int"
OF = f"{OC}, of as (select *, {FOLD_SQL} as fold from oc where any_return is not null), " + nb_ctes("n", "of", "any_return", NB1_DISCRETE, NB1_CONTINUOUS, by="fold")


def selection_sql(chosen):
    parts = [f"select '{','.join(s)}' as subset, fold, avg(case when k = any_return then 1.0 else 0.0 end) as score from ("
             f"select fold, k, any_return, row_number() over (partition by case_id order by {' + '.join(['prior'] + ['t_' + v for v in s])} desc, k) r from ns) where r = 1 group by fold"
             for s in chosen]
    return "wsel as (" + " union all ".join(f"({p})" for p in parts) + ")"


def selection(spark, d, chosen):
    df = hash_folds(order_cases(spark, d), "case_id", 3, 7)
    return S.pick_variables(df, "any_return", chosen, discrete=NB1_DISCRETE, continuous=NB1_CONTINUOUS)


def selection_query(name, chosen):
    @query(name, with_ctes(OF, selection_sql(chosen)) + "select subset, fold, round(score, 6) + 0.0 as score from wsel")
    def run(spark, d):
        return selection(spark, d, chosen).select("subset", "fold", rnd("score", 6).alias("score"))
    return run


UNIVARIATE, PAIRS = S.univariate(FEATURES), S.subsets(FEATURES, 2)
selection_query("w1_univariate", UNIVARIATE)
selection_query("w2_pairs", PAIRS)
selection_query("w3_leave_some_out", S.leave_some_out(FEATURES, 1))
selection_query("w4_forward_and_back", S.forward_first(FEATURES) + S.back_first(FEATURES)[:-1])
selection_query("w5_pick_variables", UNIVARIATE + PAIRS)


def regressor_sql(*names: str) -> str:
    """Held-out r2 of a linear fit of price_k on one or two columns, per fold."""
    a, b = names[0], names[-1]
    centred = f"""(select f.ff, o.fold, o.price_k - avg(case when o.fold <> f.ff then o.price_k end) over (partition by f.ff) y,
      o.{a} - avg(case when o.fold <> f.ff then o.{a} end) over (partition by f.ff) u, o.{b} - avg(case when o.fold <> f.ff then o.{b} end) over (partition by f.ff) v
      from rx o cross join (select distinct fold ff from rx) f)"""
    own = "sum(case when fold <> ff then {} end)"
    uu, vv, uv, uy, vy = (own.format(x) for x in ("u * u", "v * v", "u * v", "u * y", "v * y"))
    if a == b:
        beta = f"select ff, {uy} / {uu} p, 0.0::double q from c group by 1"
    else:
        beta = f"select ff, ({uy} * {vv} - {vy} * {uv}) / ({uu} * {vv} - {uv} * {uv}) p, ({vy} * {uu} - {uy} * {uv}) / ({uu} * {vv} - {uv} * {uv}) q from c group by 1"
    return f"""(with c as {centred}, beta as ({beta}) select '{','.join(names)}' as subset, ff::int as fold,
      round(1 - sum((y - p * u - q * v) * (y - p * u - q * v)) / (var_pop(y) * count(*)), 6) + 0.0 as score from c join beta using (ff) where fold = ff group by ff)"""


@query("w5_pick_regressors", with_ctes(OF, "rx as (select fold, price_k, sum_qty, n_lines::double n_lines from of where price_k is not null and sum_qty is not null and n_lines is not null)")
       + " union all ".join("select * from " + regressor_sql(*n) for n in (("sum_qty",), ("n_lines",), ("sum_qty", "n_lines"))))
def w5r(spark, d):
    df = hash_folds(order_cases(spark, d), "case_id", 3, 7)
    return S.pick_regressors(df, "price_k", [("sum_qty",), ("n_lines",), ("sum_qty", "n_lines")]).withColumn("score", rnd("score", 6))


@query("w6_summarise_variables", with_ctes(OF, selection_sql(UNIVARIATE + PAIRS)) + """select variable, round(sum(score), 6) + 0.0 as score from (
  select unnest(string_split(subset, ',')) as variable, score from (select subset, avg(score) score from wsel group by 1)) group by 1""")
def w6(spark, d):
    return S.summarise_variables(selection(spark, d, UNIVARIATE + PAIRS)).select("variable", rnd("score", 6).alias("score"))


@query("w7_best_combinations", with_ctes(OF, selection_sql(UNIVARIATE + PAIRS)) + "select subset, round(avg(score), 6) + 0.0 as score from wsel group by 1")
def w7(spark, d):
    return S.best_combinations(selection(spark, d, UNIVARIATE + PAIRS)).select("subset", rnd("score", 6).alias("score"))
