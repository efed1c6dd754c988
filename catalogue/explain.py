"""Queries of the insight operators: what is typical for orders with a return."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.models import FOLD_SQL, LONG_JOINT, dn1, everyone
from catalogue.tables import (DN, DN1, DN_WIDE, MX1, TC, dn_cases, em_ctes, labelled, order_cases, query, rnd, turn_cases, with_ctes)
from posterion.operators import insight as I
from posterion.operators.bins import discover_states
from posterion.operators.mixture import fit_mixture
from posterion.operators.validate import fit_folds, hash_folds

TARGET, STATE = "any_return", "1"
MEASURES = ["probability", "probability_given_target", "probability_given_other", "probability_target_given_this", "difference", "lift"]


def measures_sql(source: str, by: str = "") -> str:
    """I1 measures per (by, variable, state) from long joint rows (variable, state, any_return, p)."""
    b = by + ", " if by else ""
    part = f"partition by {b}variable"
    return f"""select {b}variable, state, px as probability, pxt / pt as probability_given_target, (px - pxt) / (1 - pt) as probability_given_other,
  pxt / px as probability_target_given_this, pxt / pt - (px - pxt) / (1 - pt) as difference, pxt / pt / px as lift from (
  select {b}variable, state, sp / sum(sp) over ({part}) px, st / sum(sp) over ({part}) pxt, sum(st) over ({part}) / sum(sp) over ({part}) pt from (
    select {b}variable, state, sum(p) sp, sum(case when any_return = '1' then p else 0 end) st from {source} group by all)) where px > 0"""


def out(names, digits=6):
    return ", ".join(f"round({n}, {digits}) + 0.0 as {n}" for n in names)


def rounded(frame, keys, names, digits=6):
    return frame.select(*keys, *[rnd(n, digits).alias(n) for n in names])


INS = with_ctes(DN, DN_WIDE, LONG_JOINT, f"ins as ({measures_sql('jl')})")


@query("i1_insight", INS + f"select variable, state, {out(MEASURES)} from ins")
def i1(spark, d):
    return rounded(I.calculate(everyone(spark, d), dn1(spark, d), TARGET, STATE), ["variable", "state"], MEASURES)


PAIR_JOINT = """j2 as (select row_number() over () i, * from joint),
  cells as (select i, 'size_band' as variable, size_band as state, any_return, p from j2 union all select i, 'o_orderpriority', o_orderpriority, any_return, p from j2
    union all select i, 'qty_band', qty_band, any_return, p from j2),
  two as (select e.variable || '$$' || e.state as start, x.variable, x.state, x.any_return, x.p from cells e join cells x on e.i = x.i and e.variable <> x.variable),
  ins2 as (MEASURES),
  best as (select * from (select *, row_number() over (partition by start order by difference desc nulls last, variable, state) r from ins2) where r = 1)"""


@query("i2_common_tuples", INS + ", " + PAIR_JOINT.replace("MEASURES", measures_sql("two", "start")) + """
  select start || ',' || b.variable || '$$' || b.state as evidence, round((i.difference + b.difference) / 2, 6) + 0.0 as difference,
  round(i.difference + b.difference, 6) + 0.0 as max_difference from ins i join best b on b.start = i.variable || '$$' || i.state
  order by i.difference + b.difference desc, evidence limit 20""")
def i2(spark, d):
    return rounded(I.common_tuples(spark, dn1(spark, d), TARGET, STATE), ["evidence"], ["difference", "max_difference"])


def greedy_sql(steps: int, stop: str) -> str:
    """Unrolled greedy chains per model m over the joint cells `j2`: step k takes the state with the largest difference
    given the states so far. `stop` ends a chain after a step (b: this step, a: the one before)."""
    out = ["cells as (select m, i, 'size_band' as variable, size_band as state, any_return, p from j2 union all select m, i, 'o_orderpriority', o_orderpriority, any_return, p from j2"
           " union all select m, i, 'qty_band', qty_band, any_return, p from j2)", "alive0 as (select m, i from j2)"]
    for k in range(1, steps + 1):
        taken = " ".join(f"and not exists (select 1 from best{j} b where b.m = c.m and b.variable = c.variable)" for j in range(1, k))
        rows = f"(select c.m, c.variable, c.state, c.any_return, c.p from cells c join alive{k - 1} a on a.m = c.m and a.i = c.i where true {taken})"
        out.append(f"t{k} as (select j.m, sum(case when any_return = '1' then p else 0 end) / sum(p) pt from j2 j join alive{k - 1} a on a.m = j.m and a.i = j.i group by 1)")
        out.append(f"""best{k} as materialized (select x.m, variable, state, difference, pt from (select *, row_number() over (partition by m order by round(difference, 12) desc nulls last, variable, state) r
          from ({measures_sql(rows, 'm')})) x join t{k} using (m) where r = 1)""")
        before = f"left join best{k - 1} a on a.m = b.m" if k > 1 else "left join (select null::double pt) a on true"
        out.append(f"""alive{k} as (select o.m, o.i from alive{k - 1} o join cells c on c.m = o.m and c.i = o.i join best{k} b on b.m = c.m and b.variable = c.variable and b.state = c.state
          {before} where not coalesce({stop}, false))""")
    steps_ = " union all ".join(f"select cast(m as varchar) as model_id, {k - 1} as step, variable, state, difference, pt as probability from best{k}" for k in range(1, steps + 1))
    return ", ".join(out) + f", steps as ({steps_})"


STEPS = "model_id, step, variable, state, round(difference, 6) + 0.0 as difference, round(probability, 6) + 0.0 as probability"


def steps_out(frame, *more):
    return frame.select("model_id", "step", "variable", "state", *[rnd(c, 6).alias(c) for c in ("difference", "probability", *more)])


@query("i3_descriptive_combinations", with_ctes(DN, DN_WIDE, "j2 as (select 'None' as m, row_number() over () i, * from joint)", greedy_sql(3, "b.difference is null or b.difference < 0.05")) +
       f"select {STEPS}, round(sum(difference) over (partition by model_id), 6) + 0.0 as max_difference from steps")
def i3(spark, d):
    return steps_out(I.descriptive_combinations(spark, dn1(spark, d), TARGET, STATE), "max_difference")


def fold_models(spark, d):
    """Three models of one structure, each fitted on two thirds of the cases, as one model."""
    return fit_folds(hash_folds(dn_cases(spark, d), "case_id", 3, 7, name=I.MODEL), DN1, 3, fold=I.MODEL)


def fold_rows(spark, d, **options):
    model = fold_models(spark, d)
    ids = hash_folds(order_cases(spark, d), "case_id", 3, 7, name=I.MODEL).select(F.col(I.MODEL).cast("string").alias(I.MODEL)).distinct()
    return I.calculate(ids.withColumn("scenario_id", F.col(I.MODEL)), model, TARGET, STATE)


FOLD_JOINT = f"""df as (select *, {FOLD_SQL} as fold from dn), mm as (select distinct fold as m from df),
dm as (select df.*, m from df join mm on fold <> m),
p_size as (select m, size_band, count(*)::double / sum(count(*)) over (partition by m) p from dm where size_band is not null group by 1, 2),
p_prio as (select m, o_orderpriority, count(*)::double / sum(count(*)) over (partition by m) p from dm where o_orderpriority is not null group by 1, 2),
p_qty as (select m, size_band, qty_band, count(*)::double / sum(count(*)) over (partition by m, size_band) p from dm
  where size_band is not null and qty_band is not null group by 1, 2, 3),
p_ret as (select m, size_band, qty_band, any_return, count(*)::double / sum(count(*)) over (partition by m, size_band, qty_band) p from dm
  where size_band is not null and qty_band is not null and any_return is not null group by 1, 2, 3, 4),
joint as (select s.m, s.size_band, o.o_orderpriority, q.qty_band, cast(r.any_return as varchar) any_return, s.p * o.p * q.p * r.p p
  from p_size s join p_prio o on o.m = s.m join p_qty q on q.size_band = s.size_band and q.m = s.m
  join p_ret r on r.size_band = q.size_band and r.qty_band = q.qty_band and r.m = s.m)"""
FOLD_LONG = LONG_JOINT.replace("as variable,", "as variable, m,").replace("select 'o_orderpriority', ", "select 'o_orderpriority', m, ").replace("select 'qty_band', ", "select 'qty_band', m, ")
MEANS = ", ".join(f"avg({m}) as {m}" for m in MEASURES)
FINS = with_ctes(DN, FOLD_JOINT, FOLD_LONG, f"fins as ({measures_sql('jl', 'm')})", f"av as (select variable, state, {MEANS} from fins group by 1, 2)")


@query("i4_exclusive_states", FINS + f"select variable, state, {out(MEASURES)} from av where probability_given_other < 0.02 order by difference desc, variable, state limit 10")
def i4(spark, d):
    return rounded(I.exclusive_states(fold_rows(spark, d)), ["variable", "state"], MEASURES)


@query("i4_rare_states", FINS + f"select variable, state, {out(MEASURES)} from av where probability_given_other < 0.25 order by difference desc, variable, state limit 10")
def i4b(spark, d):
    # the fixed 2 percent rule keeps nothing on this table; a wider rule shows the ranking
    return rounded(I.exclusive_states(fold_rows(spark, d), below=0.25), ["variable", "state"], MEASURES)


@query("i5_insightful_difference", FINS + f"select variable, state, {out(MEASURES)} from av order by difference desc, variable, state limit 10")
def i5(spark, d):
    return rounded(I.insightful_states(fold_rows(spark, d)), ["variable", "state"], MEASURES)


@query("i5_insightful_lift", FINS + f"select variable, state, {out(MEASURES)} from av order by lift desc, variable, state limit 10")
def i5b(spark, d):
    return rounded(I.insightful_states(fold_rows(spark, d), using="lift"), ["variable", "state"], MEASURES)


STARTS = ["text_len", "turn", "role"]
TURN_INIT = """select case_id, k, case when (turn >= (select quantile_cont(turn, 0.5) from tc))::int = k then 1.0 else 0.0 end as r from tc cross join (select unnest([0, 1]) k)"""
LEN_INIT = TURN_INIT.replace("turn", "text_len")
ROLE_INIT = """select case_id, k, case when floor(o * 2.0 / n)::int = k then 1.0 else 0.0 end as r from tc join (select role, row_number() over (order by role) - 1 o, count(*) over () n
  from (select distinct role from tc where role is not null)) using (role) cross join (select unnest([0, 1]) k)"""
THREE = with_ctes(TC, *[em_ctes(f"s{i}", "tc", init, ["role"], ["text_len"], 3) for i, init in enumerate([LEN_INIT, TURN_INIT, ROLE_INIT])],
                  "i6 as (" + " union all ".join(f"select '{s}' as model_id, k, m as mean from s{i}g3_text_len" for i, s in enumerate(STARTS)) + ")")


def seeded_means(spark, d):
    tc, rows = turn_cases(spark, d), []
    for start in STARTS:
        model = fit_mixture(tc, MX1, iterations=3, tolerance=0.0, start=start)
        rows += [(start, k, float(model.moments["text_len"][(f"Cluster{k}",)].mean[0])) for k in range(2)]
    return spark.createDataFrame(rows, "model_id string, k int, mean double")


@query("i6_comparison_models", THREE + "select model_id, k, round(mean, 4) + 0.0 as mean from i6")
def i6(spark, d):
    return seeded_means(spark, d).select("model_id", "k", rnd("mean", 4).alias("mean"))


@query("i7_exclusive_differences", FINS + """select variable, state, round(sum(difference), 6) + 0.0 as sum_difference from fins
  where probability_given_other < 0.008 and difference > 0.005 and difference < 1 group by 1, 2 order by sum(difference) desc, variable, state limit 10""")
def i7(spark, d):
    return rounded(I.exclusive_differences(fold_rows(spark, d)), ["variable", "state"], ["sum_difference"])


@query("i7_rare_differences", FINS + """select variable, state, round(sum(difference), 6) + 0.0 as sum_difference from fins
  where probability_given_other < 0.3 and difference > 0.005 and difference < 1 group by 1, 2 order by sum(difference) desc, variable, state limit 10""")
def i7b(spark, d):
    # the fixed thresholds keep nothing on this table; wider ones show the sums
    rows = I.summed_differences(fold_rows(spark, d), below=0.3, low=0.005, high=1.0)
    return rounded(rows, ["variable", "state"], ["sum_difference"])


@query("i8_bivariate_differences", FINS + """select variable, state, round(sum(difference), 6) + 0.0 as sum_difference from fins
  group by 1, 2 order by sum(difference) desc, variable, state limit 10""")
def i8(spark, d):
    return rounded(I.summed_differences(fold_rows(spark, d)), ["variable", "state"], ["sum_difference"])


@query("i9_enriched_states", FINS + """, top as (select variable, state, sum(difference) sum_difference from fins group by 1, 2 order by 3 desc, variable, state limit 10)
  select variable, state, round(sum_difference, 6) + 0.0 as sum_difference, round(probability_target_given_this, 6) + 0.0 as target_probability from top join av using (variable, state)""")
def i9(spark, d):
    rows = fold_rows(spark, d)
    return rounded(I.enrich(I.summed_differences(rows), rows), ["variable", "state"], ["sum_difference", "target_probability"])


@query("i10_cluster_rank", THREE + "select model_id, k, row_number() over (partition by model_id order by mean, k) - 1 as rank from i6")
def i10(spark, d):
    return I.cluster_rank(seeded_means(spark, d), by=("model_id",)).select("model_id", "k", "rank")


FOLD_CELLS = with_ctes(DN, FOLD_JOINT, "j2 as (select row_number() over () i, * from joint)")


@query("i11_top_combinations", FOLD_CELLS + ", " + greedy_sql(3, "false") + f"select {STEPS}, round(max(probability) over (partition by model_id), 6) + 0.0 as max_probability from steps")
def i11(spark, d):
    return steps_out(I.top_variable_combinations(spark, fold_models(spark, d), TARGET, STATE, models=("0", "1", "2")), "max_probability")


@query("i12_variable_combinations", FOLD_CELLS + ", " + greedy_sql(3, "round(b.pt, 4) = round(a.pt, 4)") + f"select {STEPS} from steps")
def i12(spark, d):
    return steps_out(I.variable_combinations(spark, fold_models(spark, d), TARGET, STATE, models=("0", "1", "2")))


@query("i13_rationalise", FINS + """select variable || '$$' || state as evidence, round(sum(difference * probability), 6) + 0.0 as score from fins
  group by 1 order by sum(difference * probability) desc, 1 limit 20""")
def i13(spark, d):
    return rounded(I.rationalise(fold_rows(spark, d)), ["evidence"], ["score"])


@query("i14_other_states", with_ctes(DN) + """select distinct 'qty_band' as variable, qty_band as state from dn where qty_band is not null and qty_band <> (select min(qty_band) from dn)
  union all select distinct 'size_band', size_band from dn where size_band <> 'M'""")
def i14(spark, d):
    dn = dn_cases(spark, d)
    states = discover_states(dn, ["qty_band", "size_band"])
    first = dn.agg(F.min("qty_band")).head()[0]
    return I.other_states(states, "qty_band", first).unionByName(I.other_states(states, "size_band", "M")).select("variable", "state")
