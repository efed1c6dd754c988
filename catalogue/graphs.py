"""Queries on networks where gaps stand above values: mixed links, latent parents, EM with gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import DN, OC, ORACLES, labelled, log_normal, order_cases, query, rnd, with_ctes
from posterion.operators.fit import fit
from posterion.operators.mixture import fit_incomplete, fit_mixture
from posterion.operators.posterior import gaussian_posterior, mean_difference, mean_posteriors, pair_moments
from posterion.operators.score import (KLDivergence, LogLikelihood, MeanVariance, ModelStatistics, MostLikelyState,
                                       StateProbability, impute, score)
from posterion.plans.network import Network, Variable
from posterion.plans.templates import independent, with_edges, with_latent_node

# size_band above any_return and sum_qty; any_return and sum_qty above price_k
MD1 = with_edges(independent(discrete=["size_band", "any_return"], continuous=["sum_qty", "price_k"]),
                 [("size_band", "any_return"), ("size_band", "sum_qty"), ("any_return", "price_k"), ("sum_qty", "price_k")])
HOLES = {"size_band": 3, "any_return": 4, "sum_qty": 5, "price_k": 7}


def holes(df):
    """The order cases with values taken out by case id, parents included."""
    return df.withColumns({c: F.when(F.col("case_id") % n != 0, F.col(c)) for c, n in HOLES.items()})


def md1(spark, d):
    return fit(order_cases(spark, d), MD1)


def md_query(spark, d, queries, **options):
    return score(holes(order_cases(spark, d)), md1(spark, d), queries, id_col="case_id", append=False, **options)


HX = "hx as (select case_id, " + ", ".join(f"case when case_id % {n} <> 0 then {c} end as {c}" for c, n in HOLES.items()) + " from oc)"
MD_FIT = """ps as (select size_band s, count(*)::double / sum(count(*)) over () p from oc where size_band is not null group by 1),
pa as (select size_band s, any_return a, count(*)::double / sum(count(*)) over (partition by size_band) p from oc where size_band is not null and any_return is not null group by 1, 2),
gq as (select size_band s, avg(sum_qty) m, greatest(var_pop(sum_qty), 1e-6) v from oc where size_band is not null and sum_qty is not null group by 1),
gp as (select any_return a, regr_slope(price_k, sum_qty) b, regr_intercept(price_k, sum_qty) c, var_pop(price_k) - regr_slope(price_k, sum_qty) * covar_pop(price_k, sum_qty) v
  from oc where any_return is not null and sum_qty is not null and price_k is not null group by 1),
cell as (select pa.s, pa.a, ps.p * pa.p p, q.m qm, q.v qv, g.b, g.c, g.v pv, g.c + g.b * q.m pm, g.v + g.b * g.b * q.v pw
  from pa join ps on ps.s = pa.s join gq q on q.s = pa.s join gp g on g.a = pa.a)"""
MD = f"{OC}, {HX}, {MD_FIT}"


def cells(name, s="size_band", a="any_return", q="sum_qty", p="price_k", group="case_id"):
    """Per case and combination of states that fits its evidence: log weight and the Gaussian parameters."""
    return f"""{name} as (select h.*, c.*, ln(c.p) + case when {q} is not null then {log_normal(q, 'c.qm', 'c.qv')} else 0 end
    + case when {p} is null then 0 when {q} is not null then {log_normal(p, f'(c.c + c.b * {q})', 'c.pv')} else {log_normal(p, 'c.pm', 'c.pw')} end as e
  from hx h cross join cell c where ({s} is null or {s} = c.s) and ({a} is null or {a} = c.a)),
{name}ll as (select {group}, max(e) + ln(sum(exp(e - t))) ll from (select *, max(e) over (partition by {group}) t from {name}) group by {group}),
{name}r as (select *, exp(e - t) / sum(exp(e - t)) over (partition by {group}) r from (select *, max(e) over (partition by {group}) t from {name}))"""


@query("q1_loglikelihood_dag", with_ctes(MD, cells("w")) + "select case_id, round(ll, 5) + 0.0 as loglikelihood from wll")
def q1(spark, d):
    return md_query(spark, d, [ModelStatistics()]).select("case_id", rnd("loglikelihood", 5).alias("loglikelihood"))


@query("q2_conflict_dag", with_ctes(MD, cells("w")) + f"""select h.case_id, round(
    coalesce((select ln(sum(p)) from cell where s = h.size_band), 0) + coalesce((select ln(sum(p)) from cell where a = h.any_return), 0)
    + coalesce((select ln(sum(p * exp({log_normal('h.sum_qty', 'qm', 'qv')}))) from cell), 0)
    + coalesce((select ln(sum(p * exp({log_normal('h.price_k', 'pm', 'pw')}))) from cell), 0) - ll, 5) + 0.0 as conflict
  from hx h join wll using (case_id)""")
def q2(spark, d):
    return md_query(spark, d, [ModelStatistics(loglikelihood=False, conflict=True)]).select("case_id", rnd("conflict", 5).alias("conflict"))


@query("q3_most_likely_dag", with_ctes(MD, cells("w", s="null")) + """select case_id, s as size_band_maxlikelihood from (
  select case_id, s, row_number() over (partition by case_id order by sum(r) desc, s) i from wr group by 1, 2) where i = 1""")
def q3(spark, d):
    return md_query(spark, d, [MostLikelyState("size_band")])


@query("q4_state_dag", with_ctes(MD, cells("w", a="null")) + """select case_id, round(sum(case when a = 1 then r else 0 end), 6) + 0.0 as any_return_probability from wr group by 1""")
def q4(spark, d):
    return md_query(spark, d, [StateProbability("any_return", "1")]).select("case_id", rnd("any_return_probability", 6).alias("any_return_probability"))


# mean and variance of the quantity given the price of the case (its own value is left out), and of the price given the quantity
QTY = """(case when price_k is null then qm else qm + qv * b / pw * (price_k - pm) end)"""
QTY_V = """(case when price_k is null then qv else qv - qv * b * qv * b / pw end)"""
PRICE = "(case when sum_qty is null then pm else c + b * sum_qty end)"
PRICE_V = "(case when sum_qty is null then pw else pv end)"


def moments_sql(name, source, mean, variance):
    return f"{name} as (select case_id, sum(r * {mean}) m, sum(r * ({variance} + {mean} * {mean})) - sum(r * {mean}) * sum(r * {mean}) v from {source} group by 1)"


@query("q5_mean_dag", with_ctes(MD, cells("w", q="null::double"), moments_sql("k", "wr", QTY, QTY_V)) +
       "select case_id, round(m, 4) + 0.0 as sum_qty_mean, round(v, 2) + 0.0 as sum_qty_variance from k")
def q5(spark, d):
    return md_query(spark, d, [MeanVariance("sum_qty")]).select("case_id", rnd("sum_qty_mean", 4).alias("sum_qty_mean"),
                                                                rnd("sum_qty_variance", 2).alias("sum_qty_variance"))


@query("q6_columns_dag", with_ctes(MD, cells("w"), cells("x", q="null::double", p="null::double")) +
       'select case_id, round(wll.ll - xll.ll, 5) + 0.0 as "sum_qty:price_k_loglikelihood" from wll join xll using (case_id)')
def q6(spark, d):
    s = md_query(spark, d, [LogLikelihood(("sum_qty", "price_k"))])
    return s.select("case_id", rnd(F.col("`sum_qty:price_k_loglikelihood`"), 5).alias("sum_qty:price_k_loglikelihood"))


@query("q7_kl_dag", with_ctes(MD, cells("w", q="null::double"), moments_sql("k", "wr", QTY, QTY_V), cells("x", p="null::double"), moments_sql("l", "xr", PRICE, PRICE_V)) +
       "select case_id, round(0.5 * ln(l.v / k.v) + (k.v + (k.m - l.m) * (k.m - l.m)) / (2 * l.v) - 0.5, 5) + 0.0 as sum_qty_price_k from k join l using (case_id)")
def q7(spark, d):
    return md_query(spark, d, [KLDivergence("sum_qty", "price_k")]).select("case_id", rnd("sum_qty_price_k", 5).alias("sum_qty_price_k"))


@query("q15_impute_dag", with_ctes(MD, cells("w"), moments_sql("k", "wr", f"(case when sum_qty is null then {QTY} else sum_qty end)", QTY_V)) + """select hx.case_id,
  coalesce(hx.size_band, b.s) as size_band, round(coalesce(hx.sum_qty, k.m), 4) + 0.0 as sum_qty from hx join k using (case_id)
  join (select case_id, s, row_number() over (partition by case_id order by sum(r) desc, s) i from wr group by 1, 2) b on b.case_id = hx.case_id and b.i = 1""")
def q15(spark, d):
    filled = impute(holes(order_cases(spark, d)), md1(spark, d), ["size_band", "sum_qty"])
    return filled.select("case_id", "size_band", rnd("sum_qty", 4).alias("sum_qty"))


SCEN = """sc as (select row_number() over (order by o_orderpriority) - 1 as scenario_id, avg(price_k) price_k from oc where price_k is not null group by o_orderpriority)"""


def priced(spark, d):
    """One scenario per order priority: the mean price of its cases is the evidence."""
    rows = order_cases(spark, d).filter("price_k is not null").groupBy("o_orderpriority").agg(F.avg("price_k").alias("price_k"))
    from pyspark.sql import Window
    # a handful of priorities, numbered in order
    w = Window.partitionBy(F.lit(0)).orderBy("o_orderpriority")
    return rows.select((F.row_number().over(w) - 1).alias("scenario_id"), "price_k")


@query("m3_given_linked_column", with_ctes(MD, SCEN, f"""g as (select scenario_id, a, exp(ln(p) + {log_normal('price_k', 'pm', 'pw')}) w, {QTY} m, {QTY_V} v from sc cross join cell)""") + """
  select scenario_id, cast(a as varchar) as any_return, round(sum(w * m) / sum(w), 4) + 0.0 as mean,
    round(sum(w * (v + m * m)) / sum(w) - (sum(w * m) / sum(w)) * (sum(w * m) / sum(w)), 2) + 0.0 as variance from g group by 1, 2""")
def m3(spark, d):
    found = gaussian_posterior(priced(spark, d), md1(spark, d), ["sum_qty"], key="scenario_id", tail=["any_return"])
    return found.select(F.col("scenario_id").cast("bigint").alias("scenario_id"), "any_return", rnd(F.get("mean", F.lit(0)), 4).alias("mean"),
                        rnd(F.get("cov", F.lit(0)), 2).alias("variance"))


@query("m5_pair_dag", with_ctes(MD) + """select cast(a as varchar) as any_return, round(sum(p * qm) / sum(p), 4) + 0.0 as mean_a, round(sum(p * pm) / sum(p), 4) + 0.0 as mean_b,
  round(sum(p * (b * qv + qm * pm)) / sum(p) - sum(p * qm) / sum(p) * sum(p * pm) / sum(p), 2) + 0.0 as cov_ab from cell group by 1""")
def m5(spark, d):
    one = order_cases(spark, d).agg(F.lit(0).alias("scenario_id"))
    p = pair_moments(gaussian_posterior(one, md1(spark, d), ["sum_qty", "price_k"], key="scenario_id", tail=["any_return"]), ["sum_qty", "price_k"], "sum_qty", "price_k")
    return p.select("any_return", rnd("mean_a", 4).alias("mean_a"), rnd("mean_b", 4).alias("mean_b"), rnd("cov_ab", 2).alias("cov_ab"))


@query("m6_mean_difference", with_ctes(MD, """l as (select a, sum(p * qm) / sum(p) qm, sum(p * (qv + qm * qm)) / sum(p) - (sum(p * qm) / sum(p)) * (sum(p * qm) / sum(p)) qv,
    sum(p * pm) / sum(p) pm, sum(p * (pw + pm * pm)) / sum(p) - (sum(p * pm) / sum(p)) * (sum(p * pm) / sum(p)) pv from cell group by a)""") + """
  select 'sum_qty' as variable, round(x.qm, 4) + 0.0 as base_mean, round(x.qv, 2) + 0.0 as base_variance, round(y.qm, 4) + 0.0 as mean, round(y.qv, 2) + 0.0 as variance,
    round(y.qm - x.qm, 4) + 0.0 as difference from l x join l y on x.a = 0 and y.a = 1
  union all select 'price_k', round(x.pm, 4) + 0.0, round(x.pv, 2) + 0.0, round(y.pm, 4) + 0.0, round(y.pv, 2) + 0.0, round(y.pm - x.pm, 4) + 0.0 from l x join l y on x.a = 0 and y.a = 1""")
def m6(spark, d):
    classes = labelled(order_cases(spark, d)).select("any_return").distinct().withColumn("scenario_id", F.col("any_return"))
    p = mean_posteriors(classes, md1(spark, d), ["sum_qty", "price_k"], key="scenario_id")
    return mean_difference(p.filter("scenario_id = 0"), p.filter("scenario_id = 1")).select(
        "variable", *[rnd(c, n).alias(c) for c, n in (("base_mean", 4), ("base_variance", 2), ("mean", 4), ("variance", 2), ("difference", 4))])


# -- EM with gaps ----------------------------------------------------------------

def em_sql(prefix: str, source: str, init: list[str], steps: int) -> str:
    """Unrolled EM of size_band -> any_return, size_band -> sum_qty over the gapped cases `source`; `init` holds the
    first tables <prefix>s0 (s, p), <prefix>a0 (s, a, p) and <prefix>g0 (s, m, v). The quantity is centred."""
    out = list(init)
    for t in range(steps + 1):
        x = f"""select h.case_id, c.s, c.a, c.m, c.v, h.sum_qty q, ln(c.p) + case when h.sum_qty is null then 0 else {log_normal('h.sum_qty', 'c.m', 'c.v')} end e
          from {source} h join (select s.s, a.a, s.p * a.p p, g.m, g.v from {prefix}s{t} s join {prefix}a{t} a on a.s = s.s join {prefix}g{t} g on g.s = s.s where s.p * a.p > 0) c
          on (h.size_band is null or h.size_band = c.s) and (h.any_return is null or h.any_return = c.a)"""
        out.append(f"""{prefix}r{t} as materialized (select *, exp(e - top) / sum(exp(e - top)) over (partition by case_id) r, top + ln(sum(exp(e - top)) over (partition by case_id)) ll
          from (select *, max(e) over (partition by case_id) top from ({x})))""")
        if t < steps:
            out.append(f"{prefix}s{t + 1} as materialized (select s, sum(r) / sum(sum(r)) over () p from {prefix}r{t} group by 1)")
            out.append(f"{prefix}a{t + 1} as materialized (select s, a, sum(r) / sum(sum(r)) over (partition by s) p from {prefix}r{t} group by 1, 2)")
            mid = f"(select avg(sum_qty) from {source})"
            y = f"coalesce(q, m) - {mid}"
            out.append(f"""{prefix}g{t + 1} as materialized (select s, {mid} + sum(r * ({y})) / sum(r) m,
              greatest(sum(r * (({y}) * ({y}) + case when q is null then v else 0 end)) / sum(r) - (sum(r * ({y})) / sum(r)) * (sum(r * ({y})) / sum(r)), 1e-6) v
              from {prefix}r{t} group by 1)""")
    return ", ".join(out)


GAP_INIT = ["es0 as (select size_band s, count(*)::double / sum(count(*)) over () p from hx where size_band is not null group by 1)",
            "ea0 as (select size_band s, any_return a, count(*)::double / sum(count(*)) over (partition by size_band) p from hx where size_band is not null and any_return is not null group by 1, 2)",
            "eg0 as (select size_band s, avg(sum_qty) m, var_pop(sum_qty) v from hx where size_band is not null and sum_qty is not null group by 1)"]
GAP_EM = with_ctes(OC, HX, em_sql("e", "hx", GAP_INIT, 5))
GAP_NET = with_edges(independent(discrete=["size_band", "any_return"], continuous=["sum_qty"]), [("size_band", "any_return"), ("size_band", "sum_qty")])


@query("p6_gaps_mixed", GAP_EM + """select 'size_band' as node, '' as parent, s as state, round(p, 5) + 0.0 as a, null::double as b from es5
  union all select 'any_return', s, cast(a as varchar), round(p, 5) + 0.0, null from ea5
  union all select 'sum_qty', s, '', round(m, 3) + 0.0, round(v, 2) + 0.0 from eg5""")
def p6(spark, d):
    return parameters(spark, gap_model(spark, d))


def gap_model(spark, d):
    return fit_incomplete(holes(order_cases(spark, d)), GAP_NET, iterations=5, tolerance=0.0)


def parameters(spark, model):
    tables = model.cpt_frame(spark).select("node", F.coalesce(F.get("parents", F.lit(0)), F.lit("")).alias("parent"), "state", rnd("p", 5).alias("a"), F.lit(None).cast("double").alias("b"))
    moments = model.gauss_frame(spark).select("node", F.get("parents", F.lit(0)).alias("parent"), F.lit("").alias("state"), rnd(F.get("mean", F.lit(0)), 3).alias("a"),
                                              rnd(F.get("cov", F.lit(0)), 2).alias("b"))
    return tables.unionByName(moments)


@query("p6_gaps_loglikelihood", GAP_EM + "select round(sum(ll), 2) + 0.0 as loglikelihood, 5 as iterations from (select distinct case_id, ll from er5)")
def p6_ll(spark, d):
    m = gap_model(spark, d)
    return order_cases(spark, d).agg(rnd(F.lit(m.loglikelihood), 2).alias("loglikelihood"), F.lit(m.iterations).alias("iterations"))


# -- a latent parent above links ------------------------------------------------------

LATENT_NET = with_latent_node(with_edges(independent(discrete=["size_band", "any_return"], continuous=["sum_qty"]), [("size_band", "any_return")]), 2)


def latent_sql(steps: int, gaps: bool = True) -> str:
    """Unrolled EM of a cluster above size_band -> any_return and sum_qty, from the halves of sum_qty; cases `lx`."""
    half = "(select quantile_cont(sum_qty, 0.5) from lx)"
    band = "case when case_id % 3 <> 0 then size_band end" if gaps else "size_band"
    out = [f"lx as (select case_id, {band} as size_band, any_return, sum_qty from oc where any_return is not null)",
           f"y0 as materialized (select case_id, (sum_qty >= {half})::int k, size_band s, any_return a, sum_qty q, 1.0::double r from lx)"]
    mid = "(select avg(sum_qty) from lx)"
    for t in range(steps + 1):
        # a first model counts families of complete cases only; later ones the expected completions of all
        out.append(f"k{t} as materialized (select k, sum(r) / sum(sum(r)) over () p from y{t} group by 1)")
        out.append(f"s{t} as materialized (select k, s, sum(r) / sum(sum(r)) over (partition by k) p from y{t} where s is not null group by 1, 2)")
        out.append(f"a{t} as materialized (select k, s, a, sum(r) / sum(sum(r)) over (partition by k, s) p from y{t} where s is not null group by 1, 2, 3)")
        out.append(f"""g{t} as materialized (select k, {mid} + sum(r * (q - {mid})) / sum(r) m,
          sum(r * (q - {mid}) * (q - {mid})) / sum(r) - (sum(r * (q - {mid})) / sum(r)) * (sum(r * (q - {mid})) / sum(r)) v from y{t} group by 1)""")
        out.append(f"""y{t + 1} as materialized (select *, exp(e - top) / sum(exp(e - top)) over (partition by case_id) r, top + ln(sum(exp(e - top)) over (partition by case_id)) ll
          from (select *, max(e) over (partition by case_id) top from (
            select h.case_id, k.k, s.s, h.any_return a, h.sum_qty q, ln(k.p) + ln(s.p) + ln(a.p) + {log_normal('h.sum_qty', 'g.m', 'g.v')} e
            from lx h join k{t} k on true join s{t} s on s.k = k.k and (h.size_band is null or h.size_band = s.s)
            join a{t} a on a.k = k.k and a.s = s.s and a.a = h.any_return join g{t} g on g.k = k.k where k.p > 0 and s.p > 0 and a.p > 0)))""")
    return ", ".join(out)


def latent_cases(spark, d):
    return labelled(order_cases(spark, d)).withColumn("size_band", F.when(F.col("case_id") % 3 != 0, F.col("size_band")))


def latent_model(spark, d):
    return fit_mixture(latent_cases(spark, d), LATENT_NET, iterations=3, tolerance=0.0, start="sum_qty")


@query("p15_latent_parent_gaps", with_ctes(OC, latent_sql(3)) + """select 'size_band' as node, cast(k as varchar) as k, s as state, '' as a, round(p, 4) + 0.0 as p from s3
  union all select 'any_return', cast(k as varchar), s, cast(a as varchar), round(p, 4) + 0.0 from a3
  union all select 'sum_qty', cast(k as varchar), '', '', round(m, 3) + 0.0 from g3""")
def p15(spark, d):
    model = latent_model(spark, d)
    hub = next(v for v in model.network.variables if v.latent)
    number = {s: str(i) for i, s in enumerate(hub.states)}
    rows = []
    for node in ("size_band", "any_return"):
        names = model.network.parents(node)
        for key, row in model.tables[node].items():
            at = dict(zip(names, key))
            for s, p in row.items():
                if p > 0:
                    rows.append((node, number[at[hub.name]], s if node == "size_band" else at["size_band"], "" if node == "size_band" else s, round(float(p), 4)))
    rows += [("sum_qty", number[k[0]], "", "", round(float(m.mean[0]), 3)) for k, m in model.moments["sum_qty"].items()]
    return spark.createDataFrame(rows, "node string, k string, state string, a string, p double")


@query("q1_latent_dag", with_ctes(OC, latent_sql(3)) + "select case_id, round(max(ll), 5) + 0.0 as loglikelihood, round(sum(case when k = 1 then r else 0 end), 5) + 0.0 as second from y4 group by 1")
def q1_latent(spark, d):
    model = latent_model(spark, d)
    hub = next(v for v in model.network.variables if v.latent)
    s = score(latent_cases(spark, d), model, [ModelStatistics(), StateProbability(hub.name, hub.states[1])], id_col="case_id", append=False)
    return s.select("case_id", rnd("loglikelihood", 5).alias("loglikelihood"), rnd(f"{hub.name}_probability", 5).alias("second"))


# -- twins of queries registered elsewhere -----------------------------------------

HUB = next(v for v in LATENT_NET.variables if v.latent)
ORACLES["p15_latent_parent"] = with_ctes(OC, latent_sql(3, gaps=False)) + f"""select '{HUB.name}' as node, '' as parent_key, n.state, round(p, 4) + 0.0 as p from k3 join names n using (k)
  union all select 'size_band', '{HUB.name}=' || n.state, s, round(p, 4) + 0.0 from s3 join names n using (k)
  union all select 'any_return', '{HUB.name}=' || n.state || '|size_band=' || s, cast(a as varchar), round(p, 4) + 0.0 from a3 join names n using (k)""".replace(
    "names n", "(select unnest([0, 1]) k, unnest([" + ", ".join(f"'{x}'" for x in HUB.states) + "]) state) n")


def chain_em_sql(steps: int) -> str:
    """Unrolled EM of size_band -> qty_band -> any_return over `cx`, the bands of half the cases hidden."""
    out = ["cx as (select case_id, size_band s, case when case_id % 2 = 0 then qty_band end q, any_return a from dn)",
           "cs0 as (select s, count(*)::double / sum(count(*)) over () p from cx where s is not null group by 1)",
           "cq0 as (select s, q, count(*)::double / sum(count(*)) over (partition by s) p from cx where s is not null and q is not null group by 1, 2)",
           "ca0 as (select q, a, count(*)::double / sum(count(*)) over (partition by q) p from cx where q is not null and a is not null group by 1, 2)"]
    for t in range(steps):
        out.append(f"""cr{t} as materialized (select case_id, c.s, c.q, c.a, p / sum(p) over (partition by case_id) r from cx
          join (select s.s, q.q, a.a, s.p * q.p * a.p p from cs{t} s join cq{t} q on q.s = s.s join ca{t} a on a.q = q.q) c
          on (cx.s is null or cx.s = c.s) and (cx.q is null or cx.q = c.q) and (cx.a is null or cx.a = c.a))""")
        out.append(f"cs{t + 1} as materialized (select s, sum(r) / sum(sum(r)) over () p from cr{t} group by 1)")
        out.append(f"cq{t + 1} as materialized (select s, q, sum(r) / sum(sum(r)) over (partition by s) p from cr{t} group by 1, 2)")
        out.append(f"ca{t + 1} as materialized (select q, a, sum(r) / sum(sum(r)) over (partition by q) p from cr{t} group by 1, 2)")
    return ", ".join(out)


ORACLES["p6_missing_inner_node"] = with_ctes(DN, chain_em_sql(5)) + """select 'size_band' as node, '' as parent_key, s as state, round(p, 4) + 0.0 as p from cs5
  union all select 'qty_band', 'size_band=' || s, q, round(coalesce(p, 0), 4) + 0.0 from (select s from cs5) cross join (select distinct q from cq5) left join cq5 using (s, q) union all select 'any_return', 'qty_band=' || q, cast(a as varchar), round(p, 4) + 0.0 from ca5"""
