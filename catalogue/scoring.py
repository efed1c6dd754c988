"""Queries of case scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import (DN, DN1, DN_WIDE, GR1, MG1, MX, NB, NB1, NB1_CONTINUOUS, NB1_DISCRETE, NB_LL, NB_P, OC, dn_cases,
                              fit_mx1, labelled, log_normal, nb_ctes, order_cases, query, rnd, table, turn_cases, with_ctes)
from posterion.operators.fit import fit
from posterion.operators.metrics import virtual_accuracy
from posterion.operators.posterior import posterior, score_general, soft_except
from posterion.operators.sampling import sample
from posterion.operators.score import (KLDivergence, LogLikelihood, MeanVariance, ModelStatistics, MostLikelyState,
                                       StateProbability, anomalies, impute, score)
from posterion.plans.network import Network, Variable
from posterion.plans.templates import mixture


def nb1(spark, d):
    return fit(labelled(order_cases(spark, d)), NB1)


def flagship(spark, d):
    oc = order_cases(spark, d)
    scored = score(oc, fit(labelled(oc), NB1), [ModelStatistics(), MostLikelyState("any_return", "int"), StateProbability("any_return", "1")],
                   id_col="case_id", append=False)
    return scored.select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"), "any_return_maxlikelihood",
                         rnd("any_return_probability", 6).alias("any_return_probability"))


def nb_query(spark, d, queries, **options):
    return score(order_cases(spark, d), nb1(spark, d), queries, id_col="case_id", append=False, **options)


@query("q1_loglikelihood_nb", with_ctes(NB, NB_LL) + "select case_id, round(ll, 6) + 0.0 as loglikelihood from nll")
def q1(spark, d):
    return nb_query(spark, d, [ModelStatistics()]).select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"))


@query("q1_loglikelihood_mixture", with_ctes(MX) + "select case_id, round(ll, 6) + 0.0 as loglikelihood from mr4 where k = 0")
def q1m(spark, d):
    return score(turn_cases(spark, d), fit_mx1(spark, d), id_col="case_id", append=False).select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"))


MARGINALS = """mb as (select x.v, sum(c.p * x.p) p from nd_size_band x join nprior c on c.k = x.k group by 1),
mo as (select x.v, sum(c.p * x.p) p from nd_o_orderpriority x join nprior c on c.k = x.k group by 1)"""


@query("q2_conflict", with_ctes(NB, NB_LL, MARGINALS) + f"""select case_id, round(
    coalesce(ln(c.p), 0) + coalesce(ln(mb.p), 0) + coalesce(ln(mo.p), 0)
    + case when sum_qty is null then 0 else (select ln(sum(p.p * exp({log_normal('oc.sum_qty', 'g.m', 'g.v')}))) from ng_sum_qty g join nprior p on p.k = g.k) end
    + case when price_k is null then 0 else (select ln(sum(p.p * exp({log_normal('oc.price_k', 'g.m', 'g.v')}))) from ng_price_k g join nprior p on p.k = g.k) end
    - ll, 6) + 0.0 as conflict
  from oc join nll using (case_id) left join nprior c on c.k = any_return left join mb on mb.v = size_band left join mo on mo.v = o_orderpriority""")
def q2(spark, d):
    return nb_query(spark, d, [ModelStatistics(loglikelihood=False, conflict=True)]).select("case_id", rnd("conflict", 6).alias("conflict"))


@query("q3_most_likely_state", with_ctes(NB, NB_P) + "select case_id, pred::int as any_return_maxlikelihood from npred")
def q3(spark, d):
    return nb_query(spark, d, [MostLikelyState("any_return", "int")])


LEAF = """r as (select case_id, k, exp(e - m) / sum(exp(e - m)) over (partition by case_id) r from (select *, max(e) over (partition by case_id) m from (
    select case_id, k, case when any_return is null or any_return = k then prior + t_o_orderpriority + t_sum_qty + t_price_k else '-infinity'::double end e from ns))),
  p as (select case_id, v, sum(r * x.p) p from r join nd_size_band x on x.k = r.k group by 1, 2)"""


@query("q3_most_likely_leaf", with_ctes(NB, LEAF) + """select case_id, v as size_band_maxlikelihood, round(p, 6) + 0.0 as probability
  from (select *, row_number() over (partition by case_id order by p desc, v) i from p) where i = 1""")
def q3b(spark, d):
    s = nb_query(spark, d, [MostLikelyState("size_band"), StateProbability("size_band")])
    p = F.greatest(*[F.col(f"`size_band$${x}_probability`") for x in "LMS"])
    return s.select("case_id", "size_band_maxlikelihood", rnd(p, 6).alias("probability"))


@query("q4_state_probability", with_ctes(NB, NB_P) + """select case_id, round(sum(case when k = 0 then p else 0 end), 6) + 0.0 as "any_return$$0_probability",
  round(sum(case when k = 1 then p else 0 end), 6) + 0.0 as "any_return$$1_probability" from npost group by case_id""")
def q4(spark, d):
    s = nb_query(spark, d, [StateProbability("any_return")])
    return s.select("case_id", *[rnd(F.col(f"`{c}`"), 6).alias(c) for c in s.columns if c != "case_id"])


def retracted_sql(terms):
    """Class weights of each case from the named terms, class evidence kept."""
    return f"""r as (select case_id, k, exp(e - m) / sum(exp(e - m)) over (partition by case_id) r from (select *, max(e) over (partition by case_id) m from (
    select case_id, k, case when any_return is null or any_return = k then {' + '.join(terms)} else '-infinity'::double end e from ns)))"""


@query("q5_mean_variance", with_ctes(NB, retracted_sql(["prior", "t_size_band", "t_o_orderpriority", "t_price_k"])) + """select case_id,
  round(sum(r * m), 4) + 0.0 as sum_qty_mean, round(sum(r * (v + m * m)) - sum(r * m) * sum(r * m), 3) + 0.0 as sum_qty_variance
  from r join ng_sum_qty g on g.k = r.k group by case_id""")
def q5(spark, d):
    return nb_query(spark, d, [MeanVariance("sum_qty")]).select(
        "case_id", rnd("sum_qty_mean", 4).alias("sum_qty_mean"), rnd("sum_qty_variance", 3).alias("sum_qty_variance"))


@query("q5_mean_variance_mixture", with_ctes(MX) + """, r as (select case_id, k, exp(e - max(e) over (partition by case_id)) r from (
    select tc.case_id, h.k, case when d.p > 0 then ln(h.p) + ln(d.p) when tc.role is null then ln(h.p) else '-infinity'::double end e
    from tc cross join mh3 h left join md3_role d on d.k = h.k and d.v = tc.role))
  select case_id, round(sum(r * m) / sum(r), 4) + 0.0 as text_len_mean,
  round(sum(r * (v + m * m)) / sum(r) - (sum(r * m) / sum(r)) * (sum(r * m) / sum(r)), 2) + 0.0 as text_len_variance from r join mg3_text_len g on g.k = r.k group by case_id""")
def q5m(spark, d):
    s = score(turn_cases(spark, d), fit_mx1(spark, d), [MeanVariance("text_len")], id_col="case_id", append=False)
    return s.select("case_id", rnd("text_len_mean", 4).alias("text_len_mean"), rnd("text_len_variance", 2).alias("text_len_variance"))


GR_FIT = """gr as (select avg(sum_qty) mx, var_pop(sum_qty) vx, regr_slope(price_k, sum_qty) b, regr_intercept(price_k, sum_qty) a,
  var_pop(price_k) - regr_slope(price_k, sum_qty) * covar_pop(price_k, sum_qty) s2 from oc)"""


@query("q5_gaussian_parent", with_ctes(OC, GR_FIT) + """select case_id, round(case when price_k is null then mx else mx + b * vx / (b * b * vx + s2) * (price_k - a - b * mx) end, 4) + 0.0 as sum_qty_mean,
  round(case when price_k is null then vx else vx - b * vx * b * vx / (b * b * vx + s2) end, 3) + 0.0 as sum_qty_variance,
  round(case when sum_qty is null then a + b * mx else a + b * sum_qty end, 4) + 0.0 as price_k_mean from oc, gr""")
def q5g(spark, d):
    oc = order_cases(spark, d)
    s = score(oc, fit(oc, GR1), [MeanVariance("sum_qty"), MeanVariance("price_k")], id_col="case_id", append=False)
    return s.select("case_id", rnd("sum_qty_mean", 4).alias("sum_qty_mean"), rnd("sum_qty_variance", 3).alias("sum_qty_variance"),
                    rnd("price_k_mean", 4).alias("price_k_mean"))


def ll_of(terms, name):
    return f"""{name} as (select case_id, m + ln(sum(exp(e - m))) ll from (select *, max(e) over (partition by case_id) m from (
      select case_id, k, case when any_return is null or any_return = k then {' + '.join(terms)} else '-infinity'::double end e from ns)) group by case_id, m)"""


@query("q6_loglikelihood_of_columns", with_ctes(NB, NB_LL, ll_of(["prior", "t_size_band", "t_o_orderpriority"], "rest")) +
       'select case_id, round(nll.ll - rest.ll, 6) + 0.0 as "sum_qty:price_k_loglikelihood" from nll join rest using (case_id)')
def q6(spark, d):
    s = nb_query(spark, d, [LogLikelihood(("sum_qty", "price_k"))])
    return s.select("case_id", rnd(F.col("`sum_qty:price_k_loglikelihood`"), 6).alias("sum_qty:price_k_loglikelihood"))


@query("q6_joint_gaussian", with_ctes(OC, """mg as (select any_return k, count(*)::double / sum(count(*)) over () p, avg(sum_qty) ma, avg(price_k) mb, var_pop(sum_qty) va,
  var_pop(price_k) vb, covar_pop(sum_qty, price_k) c from oc where any_return is not null group by 1)""") + """select case_id,
  round(case when any_return is null then 0 else -ln(2 * pi()) - 0.5 * ln(va * vb - c * c)
  - 0.5 * (vb * (sum_qty - ma) * (sum_qty - ma) - 2 * c * (sum_qty - ma) * (price_k - mb) + va * (price_k - mb) * (price_k - mb)) / (va * vb - c * c) end, 5) + 0.0
  as "sum_qty:price_k_loglikelihood" from oc left join mg on mg.k = oc.any_return""")
def q6g(spark, d):
    oc = order_cases(spark, d)
    s = score(oc, fit(labelled(oc), MG1), [LogLikelihood(("sum_qty", "price_k"))], id_col="case_id", append=False)
    return s.select("case_id", rnd(F.col("`sum_qty:price_k_loglikelihood`"), 5).alias("sum_qty:price_k_loglikelihood"))


KL_SOURCE = f"{OC}, kc as (select *, case when o_totalprice > 250000 then 1 else 0 end as flag from oc where any_return is not null)"
KL_P = """kp as (select k.case_id, k.flag, k.any_return, b.p pb, f.p pf from kc k
  left join (select flag, avg(any_return) p from kc group by 1) b on b.flag = k.flag
  left join (select any_return, avg(flag) p from kc group by 1) f on f.any_return = k.any_return)"""


def kl_case(spark, d):
    return labelled(order_cases(spark, d)).withColumn("flag", F.when(F.col("o_totalprice") > 250000, 1).otherwise(0))


@query("q7_kl_discrete", with_ctes(KL_SOURCE, KL_P) + """select case_id, round(pb * ln(pb / pf) + (1 - pb) * ln((1 - pb) / (1 - pf)), 6) + 0.0 as any_return_flag from kp""")
def q7(spark, d):
    kc = kl_case(spark, d)
    model = fit(kc, Network((Variable("any_return"), Variable("flag")), (("any_return", "flag"),)))
    s = score(kc, model, [KLDivergence("any_return", "flag")], id_col="case_id", append=False)
    return s.select("case_id", rnd("any_return_flag", 6).alias("any_return_flag"))


@query("q7_kl_gaussian", with_ctes(OC, "t as (select any_return k, avg(sum_qty) ma, var_pop(sum_qty) va, avg(price_k) mb, var_pop(price_k) vb from oc where any_return is not null group by 1)")
       + """select case_id, round(0.5 * ln(vb / va) + (va + (ma - mb) * (ma - mb)) / (2 * vb) - 0.5, 6) + 0.0 as sum_qty_price_k from oc join t on t.k = oc.any_return""")
def q7g(spark, d):
    oc = labelled(order_cases(spark, d))
    s = score(oc, fit(oc, NB1), [KLDivergence("sum_qty", "price_k")], id_col="case_id", append=False, evidence=["any_return"])
    return s.select("case_id", rnd("sum_qty_price_k", 6).alias("sum_qty_price_k"))


@query("q8_default_query", with_ctes(NB, NB_LL) + "select case_id, round(ll, 6) + 0.0 as loglikelihood from nll")
def q8(spark, d):
    return nb_query(spark, d, None).select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"))


@query("q9_append_columns", with_ctes(NB, NB_LL) + "select case_id, o_orderpriority, n_lines, round(ll, 6) + 0.0 as loglikelihood from nll join oc using (case_id)")
def q9(spark, d):
    s = score(order_cases(spark, d), nb1(spark, d))
    return s.select("case_id", "o_orderpriority", "n_lines", rnd("loglikelihood", 6).alias("loglikelihood"))


@query("q10_evidence_subset", with_ctes(NB) + """, x as (select case_id, k, any_return, prior + t_size_band s from ns),
  y as (select *, max(s) over (partition by case_id) m from x)
  select case_id, round(sum(case when k = 1 then exp(s - m) else 0 end) / sum(exp(s - m)), 6) + 0.0 as any_return_probability from y group by case_id""")
def q10(spark, d):
    s = nb_query(spark, d, [StateProbability("any_return", "1")], evidence=["size_band", "no_such_column"])
    return s.select("case_id", rnd("any_return_probability", 6).alias("any_return_probability"))


@query("q11_many_queries", with_ctes(NB, NB_LL, NB_P, retracted_sql(["prior", "t_size_band", "t_o_orderpriority", "t_sum_qty"]).replace("r as (", "rp as (", 1)) + """
  select case_id, round(ll, 6) + 0.0 as loglikelihood, pred::int as any_return_maxlikelihood, round(p1, 6) + 0.0 as any_return_probability, round(mean, 4) + 0.0 as price_k_mean
  from nll join npred using (case_id) join (select case_id, p as p1 from npost where k = 1) using (case_id)
  join (select case_id, sum(r * m) as mean from rp join ng_price_k g on g.k = rp.k group by 1) using (case_id)""")
def q11(spark, d):
    s = nb_query(spark, d, [ModelStatistics(), MostLikelyState("any_return", "int"), StateProbability("any_return", "1"), MeanVariance("price_k")])
    return s.select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"), "any_return_maxlikelihood",
                    rnd("any_return_probability", 6).alias("any_return_probability"), rnd("price_k_mean", 4).alias("price_k_mean"))


@query("q12_general_inference", with_ctes(DN, DN_WIDE) + """select case_id, any_return_maxlikelihood, round(p1, 6) + 0.0 as p1 from (
  select h.case_id, sum(case when any_return = '1' then p else 0 end) / sum(p) as p1,
    case when sum(case when any_return = '1' then p else 0 end) > sum(case when any_return = '0' then p else 0 end) then 1 else 0 end as any_return_maxlikelihood
  from (select case_id, size_band sb, case when case_id % 3 > 0 then qty_band end qb from dn) h
  join joint j on (h.sb is null or h.sb = j.size_band) and (h.qb is null or h.qb = j.qty_band) group by h.case_id)""")
def q12(spark, d):
    dn = dn_cases(spark, d)
    model = fit(dn, DN1)
    hidden = dn.withColumn("qty_band", F.when(F.col("case_id") % 3 > 0, F.col("qty_band")))
    s = score_general(hidden, model, "any_return", id_col="case_id", evidence=["size_band", "qty_band"], dtype="int")
    return s.select("case_id", "any_return_maxlikelihood", rnd(F.col("`any_return$$1_probability`"), 6).alias("p1"))


SCENARIOS = """sc as (select scenario_id, size_band, o_orderpriority from (
  select (row_number() over (order by size_band, o_orderpriority) - 1)::int as scenario_id, size_band, o_orderpriority
  from (select distinct size_band, o_orderpriority from oc)))"""


def scenario_cases(spark, d):
    """Every combination of size_band and priority seen in the data is a scenario."""
    from pyspark.sql import Window
    pairs = order_cases(spark, d).select("size_band", "o_orderpriority").distinct()
    # a few dozen scenarios: the numbering runs on distinct state pairs, not on cases
    w = Window.partitionBy(F.lit(0)).orderBy(F.col("size_band").asc_nulls_last(), "o_orderpriority")
    return pairs.withColumn("scenario_id", F.row_number().over(w) - 1)


@query("q13_scenarios", with_ctes(DN, DN_WIDE, SCENARIOS) + """select scenario_id, any_return as state, round(sum(p) / sum(sum(p)) over (partition by scenario_id), 6) + 0.0 as probability
  from sc join joint j on (sc.size_band is null or sc.size_band = j.size_band) and sc.o_orderpriority = j.o_orderpriority group by 1, 2""")
def q13(spark, d):
    model = fit(dn_cases(spark, d), DN1)
    return posterior(scenario_cases(spark, d), model, ["any_return"], key="scenario_id").select(
        "scenario_id", F.col("any_return").alias("state"), rnd("probability", 6).alias("probability"))


@query("q14_soft_evidence", with_ctes(DN, DN_WIDE) + """select o_orderpriority as scenario, any_return as state, round(sum(w) / sum(sum(w)) over (partition by o_orderpriority), 6) + 0.0 as probability from (
  select o_orderpriority, any_return, p * case size_band when 'S' then 0.2 when 'M' then 0.8 else 0 end as w from joint) where w > 0 group by 1, 2""")
def q14(spark, d):
    model = fit(dn_cases(spark, d), DN1)
    soft = F.create_map(F.lit("S"), F.lit(0.2), F.lit("M"), F.lit(0.8))
    sc = order_cases(spark, d).select("o_orderpriority").distinct().select(
        F.col("o_orderpriority").alias("scenario"), "o_orderpriority", soft.alias("size_band"))
    return posterior(sc, model, ["any_return"], key="scenario", soft=["size_band"]).select(
        "scenario", F.col("any_return").alias("state"), rnd("probability", 6).alias("probability"))


@query("q14_all_except", with_ctes(DN, DN_WIDE) + """select o_orderpriority as scenario, any_return as state, round(sum(p) / sum(sum(p)) over (partition by o_orderpriority), 6) + 0.0 as probability
  from joint where size_band <> 'L' group by 1, 2""")
def q14b(spark, d):
    model = fit(dn_cases(spark, d), DN1)
    weights = soft_except(model, "size_band", "L")
    soft = F.create_map(*[x for s, w in weights.items() for x in (F.lit(s), F.lit(w))])
    sc = order_cases(spark, d).select("o_orderpriority").distinct().select(
        F.col("o_orderpriority").alias("scenario"), "o_orderpriority", soft.alias("size_band"))
    return posterior(sc, model, ["any_return"], key="scenario", soft=["size_band"]).select(
        "scenario", F.col("any_return").alias("state"), rnd("probability", 6).alias("probability"))


@query("q15_impute", with_ctes(NB) + """, z as (select case_id, k, exp(s - m) / sum(exp(s - m)) over (partition by case_id) r from (select *, max(s) over (partition by case_id) m from ns) where any_return is null),
  b as (select case_id, v from (select case_id, v, row_number() over (partition by case_id order by p desc, v) i from (
    select case_id, x.v, sum(r * x.p) p from z join nd_size_band x on x.k = z.k group by 1, 2)) where i = 1),
  q as (select case_id, sum(r * m) v from z join ng_sum_qty g on g.k = z.k group by 1)
  select oc.case_id, coalesce(size_band, b.v) as size_band, round(coalesce(sum_qty, q.v), 4) + 0.0 as sum_qty from oc left join b using (case_id) left join q using (case_id)""")
def q15(spark, d):
    filled = impute(order_cases(spark, d), nb1(spark, d), ["size_band", "sum_qty"])
    return filled.select("case_id", "size_band", rnd("sum_qty", 4).alias("sum_qty"))


def pick_sql(name, source, node, parents, seed):
    """Inverse distribution draw of one node for every row of `source`."""
    h = "('0x' || substr(md5(cast({i} as varchar) || ':{s}:{n}'), 1, 8))::ubigint::double / 4294967296.0".format(i="b.case_id", s=seed, n=node)
    match = " and ".join(f"c.{p} = b.{p}" for p in parents) or "true"
    return (f"{name} as (select * exclude (i) from (select b.*, c.{node}, row_number() over (partition by b.case_id order by case when c.last or u < c.cum then 0 else 1 end, c.o) i from "
            f"(select b.*, {h} u from {source} b) b join c_{node} c on {match}) where i = 1)")


def cum_sql(table, node, parents):
    part = f"partition by {', '.join(parents)}" if parents else ""
    text = f"cast({node} as varchar)"
    return (f"c_{node} as (select {''.join(p + ', ' for p in parents)}{text} as {node}, row_number() over ({part} order by {text}) o, "
            f"sum(p) over ({part} order by {text}) cum, row_number() over ({part} order by {text} desc) = 1 as last from {table} where p > 0)")


@query("q16_sample", with_ctes(
    DN, DN_WIDE, cum_sql("p_size", "size_band", []), cum_sql("p_prio", "o_orderpriority", []), cum_sql("p_qty", "qty_band", ["size_band"]),
    cum_sql("p_ret", "any_return", ["size_band", "qty_band"]), "b0 as (select case_id from oc)", pick_sql("b1", "b0", "size_band", [], 7),
    pick_sql("b2", "(select * exclude (u) from b1)", "o_orderpriority", [], 7), pick_sql("b3", "(select * exclude (u) from b2)", "qty_band", ["size_band"], 7),
    pick_sql("b4", "(select * exclude (u) from b3)", "any_return", ["size_band", "qty_band"], 7)) + "select case_id, size_band, o_orderpriority, qty_band, any_return from b4")
def q16(spark, d):
    model = fit(dn_cases(spark, d), DN1)
    ids = table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"))
    return sample(ids, model, id_col="case_id", seed=7)


# given a returned line: the band first, then the quantity given the band, then the priority
GIVEN = """e_size as (select s.size_band, s.p * sum(q.p * r.p) p from p_size s join p_qty q on q.size_band = s.size_band
  join p_ret r on r.size_band = q.size_band and r.qty_band = q.qty_band and r.any_return = 1 group by s.size_band, s.p),
e_size_n as (select size_band, p / sum(p) over () p from e_size),
e_qty as (select q.size_band, q.qty_band, q.p * r.p / sum(q.p * r.p) over (partition by q.size_band) p from p_qty q
  join p_ret r on r.size_band = q.size_band and r.qty_band = q.qty_band and r.any_return = 1)"""


@query("q16_sample_given", with_ctes(
    DN, DN_WIDE, GIVEN, cum_sql("e_size_n", "size_band", []), cum_sql("p_prio", "o_orderpriority", []), cum_sql("e_qty", "qty_band", ["size_band"]),
    "b0 as (select case_id from oc)", pick_sql("b1", "b0", "size_band", [], 7), pick_sql("b2", "(select * exclude (u) from b1)", "qty_band", ["size_band"], 7),
    pick_sql("b3", "(select * exclude (u) from b2)", "o_orderpriority", [], 7)) + "select case_id, size_band, o_orderpriority, qty_band, '1' as any_return from b3")
def q16b(spark, d):
    model = fit(dn_cases(spark, d), DN1)
    ids = table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"))
    return sample(ids, model, id_col="case_id", seed=7, evidence={"any_return": "1"})


@query("q17_anomalies", with_ctes(OC, nb_ctes("n", "oc", "any_return", NB1_DISCRETE, NB1_CONTINUOUS, train="n_lines <= 6"), NB_LL)
       + """select case_id, round(l, 6) + 0.0 as loglikelihood from (select case_id, case when isinf(ll) or isnan(ll) then null else ll end l from nll)
  order by l nulls first, case_id limit 20""")
def q17(spark, d):
    oc = order_cases(spark, d)
    model = fit(labelled(oc).filter("n_lines <= 6"), NB1)
    scored = anomalies(oc, model, 20, "case_id")
    return scored.select("case_id", rnd("loglikelihood", 6).alias("loglikelihood"))


@query("q18_virtual_accuracy", with_ctes(MX) + """, w as (select case_id, k, r from mr4), a as (select t.case_id, w.k, w.r, case when (t.text_len >= 300) = (t.role = 'assistant') then 1.0 else 0.0 end ok
    from tc t join w using (case_id)),
  c as (select k, sum(r * ok) / sum(r) acc from a group by k)
  select a.case_id, round(sum(a.r * c.acc) / sum(a.r), 6) + 0.0 as score from a join c using (k) group by 1""")
def q18(spark, d):
    tc = turn_cases(spark, d)
    scored = score(tc, fit_mx1(spark, d), [StateProbability("Cluster")])
    ok = ((F.col("text_len") >= 300) == (F.col("role") == "assistant")).cast("double")
    return virtual_accuracy(scored.withColumn("ok", ok), "case_id", ["Cluster$$Cluster0_probability", "Cluster$$Cluster1_probability"], "ok").select(
        "case_id", rnd("score", 6).alias("score"))
