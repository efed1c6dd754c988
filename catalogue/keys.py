"""Queries on networks with a column of very many values: the parts of all order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.tables import log_normal, query, rnd, table, with_ctes
from posterion.operators.keyed import KeyedModel, fit_keyed, score_keyed
from posterion.operators.score import MeanVariance, ModelStatistics, StateProbability
from posterion.plans.network import Network, Variable
from posterion.sources.storage import stage_path

# the part is above the return flag and the price; the flag is above line status and quantity
PARTS = Network((Variable("l_partkey"), Variable("l_returnflag"), Variable("l_linestatus"), Variable("l_extendedprice", "continuous"),
                 Variable("l_quantity", "continuous")),
                (("l_partkey", "l_returnflag"), ("l_partkey", "l_extendedprice"), ("l_returnflag", "l_linestatus"), ("l_returnflag", "l_quantity")))


def line_cases(spark, d):
    return table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("case_id"), *PARTS.names())


def gapped(df):
    """Lines without their part (and price), and lines without their flag or quantity."""
    part = F.col("case_id") % 4 != 0
    return df.withColumns({"l_partkey": F.when(part, F.col("l_partkey")), "l_extendedprice": F.when(part, F.col("l_extendedprice")),
                           "l_returnflag": F.when(F.col("case_id") % 3 != 0, F.col("l_returnflag")), "l_quantity": F.when(F.col("case_id") % 5 != 0, F.col("l_quantity"))})


def parts_model(spark, d):
    return fit_keyed(line_cases(spark, d), PARTS, ["l_partkey"])


# a case id may repeat: lines are told apart by their place
LI = "li as (select row_number() over () as row, l_orderkey * 10 + l_linenumber as case_id, l_partkey k, l_returnflag r, l_linestatus s, l_extendedprice x, l_quantity q from lineitem)"
LH = """lh as (select row, case_id, case when case_id % 4 <> 0 then k end k, case when case_id % 3 <> 0 then r end r, s, case when case_id % 4 <> 0 then x end x,
  case when case_id % 5 <> 0 then q end q from li)"""
PARTS_FIT = """pk as (select k, count(*)::double / sum(count(*)) over () p from li group by 1),
pr as (select k, r, count(*)::double / sum(count(*)) over (partition by k) p from li group by 1, 2),
px as (select k, avg(x) m, greatest(var_pop(x), 1e-6) v from li group by 1),
pl as (select r, s, count(*)::double / sum(count(*)) over (partition by r) p from li group by 1, 2),
pq as (select r, avg(q) m, greatest(var_pop(q), 1e-6) v from li group by 1),
no_part as (select r, sum(pk.p * pr.p) p from pk join pr using (k) group by 1)"""


def line_cells(flag: str) -> str:
    """Log weight of every flag that fits a line's evidence (`flag`: the evidence on the flag itself)."""
    tail = f"coalesce(ln(pl.p), '-infinity'::double) + case when h.q is null then 0 else {log_normal('h.q', 'pq.m', 'pq.v')} end"
    joins = f"join pq on pq.r = c.r left join pl on pl.r = c.r and pl.s = h.s where ({flag} is null or {flag} = c.r)"
    return f"""cells as (
  select h.row, h.case_id, c.r, ln(pk.p) + ln(c.p) + case when h.x is null then 0 else {log_normal('h.x', 'px.m', 'px.v')} end + {tail} e
    from lh h join pk on pk.k = h.k join px on px.k = h.k join pr c on c.k = h.k {joins}
  union all select h.row, h.case_id, c.r, ln(c.p) + {tail} from lh h cross join no_part c {joins} and h.k is null),
w as (select *, exp(e - t) / sum(exp(e - t)) over (partition by row) p, t + ln(sum(exp(e - t)) over (partition by row)) ll
  from (select *, max(e) over (partition by row) t from cells where e > '-infinity'::double))"""


@query("p1_keyed_family", with_ctes(LI, PARTS_FIT) + "select cast(k as varchar) as l_partkey, r as l_returnflag, round(p, 6) + 0.0 as p from pr")
def p1(spark, d):
    return parts_model(spark, d).family_frame("l_returnflag").select("l_partkey", "l_returnflag", rnd("p", 6).alias("p"))


@query("p2_keyed_gaussian", with_ctes(LI, PARTS_FIT) + "select cast(k as varchar) as l_partkey, round(m + 1e-7, 3) + 0.0 as mean, round(v, 0) + 0.0 as variance from px")
def p2(spark, d):
    return parts_model(spark, d).family_frame("l_extendedprice").select("l_partkey", rnd(F.col("mean") + 1e-7, 3).alias("mean"), rnd("variance", 0).alias("variance"))


@query("q1_loglikelihood_keyed", with_ctes(LI, LH, PARTS_FIT, line_cells("h.r")) + "select case_id, round(max(ll), 4) + 0.0 as loglikelihood from w group by row, case_id")
def q1(spark, d):
    s = score_keyed(gapped(line_cases(spark, d)), parts_model(spark, d), [ModelStatistics()], id_col="case_id", append=False)
    return s.select("case_id", rnd("loglikelihood", 4).alias("loglikelihood"))


@query("q4_state_keyed", with_ctes(LI, LH, PARTS_FIT, line_cells("null")) + "select case_id, round(sum(case when r = 'R' then p else 0 end), 6) + 0.0 as l_returnflag_probability from w group by row, case_id")
def q4(spark, d):
    s = score_keyed(gapped(line_cases(spark, d)), parts_model(spark, d), [StateProbability("l_returnflag", "R")], id_col="case_id", append=False)
    return s.select("case_id", rnd("l_returnflag_probability", 6).alias("l_returnflag_probability"))


@query("q5_mean_keyed", with_ctes(LI, LH.replace("case when case_id % 5 <> 0 then q end q", "null::double q"), PARTS_FIT, line_cells("h.r")) +
       "select case_id, round(sum(w.p * pq.m), 4) + 0.0 as l_quantity_mean from w join pq using (r) group by row, case_id")
def q5(spark, d):
    s = score_keyed(gapped(line_cases(spark, d)), parts_model(spark, d), [MeanVariance("l_quantity")], id_col="case_id", append=False)
    return s.select("case_id", rnd("l_quantity_mean", 4).alias("l_quantity_mean"))


@query("s9_keyed_save_load", with_ctes(LI, PARTS_FIT) + """select cast(k as varchar) as l_partkey, round(pk.p, 6) + 0.0 as share, round(m + 1e-7, 3) + 0.0 as mean from pk join px using (k)""")
def s9(spark, d):
    path = stage_path(spark, "model")
    parts_model(spark, d).save(spark, path)
    model = KeyedModel.load(spark, path)
    return model.family_frame("l_partkey").join(model.family_frame("l_extendedprice"), "l_partkey").select(
        "l_partkey", rnd("p", 6).alias("share"), rnd(F.col("mean") + 1e-7, 3).alias("mean"))
