"""Queries of parameter and structure learning."""

from __future__ import annotations

from itertools import combinations
from statistics import NormalDist

from pyspark.sql import functions as F

from catalogue.tables import (DC, DN, DN1, DN_CPT, DN_FAMILIES, EC, EM, GR1, MG1, MX, MX1, NB, NB1, NB_LL, OC, TC, band_sql,
                              cpt_sql, dn_cases, doc_cases, em_ctes, emb_cases, event_cases, fit_mx1, labelled, order_cases,
                              quartile_sql, query, rnd, table, turn_cases, with_ctes)
from posterion.operators import bins as B
from posterion.operators.fit import cpt_frame, discover, fit, moment_frame, statistics, training_metrics
from posterion.operators.mixture import fit_incomplete, fit_mixture
from posterion.operators.mixed import independence
from posterion.operators.score import ModelStatistics, score
from posterion.operators.structure import learn_greedy, learn_pc, learn_tan, links_frame, mutual_information
from posterion.operators.tables import missing_families
from posterion.operators.validate import hash_folds
from posterion.plans.templates import (from_links, independent, mixture, move_node, naive_bayes, with_edges,
                                       with_fully_connected_nodes, with_latent_node, with_multivariate_nodes, with_tree_structure)

FOLD_SQL = "(('0x' || substr(md5(cast(case_id as varchar) || ':7'), 1, 8))::ubigint % 3)::int"
CPT_OUT = "select node, parent_key, state, n, round(p, 6) + 0.0 as p from "


def cpt_of(df, network, weight=None):
    network, centres = discover(df, network)
    return cpt_frame(statistics(df, network, centres, weight=weight))


def cpt_out(df, network):
    return cpt_of(df, network).select("node", "parent_key", "state", "n", rnd("p", 6).alias("p"))


def family_union(source, families, where="true"):
    return "(" + " union all ".join(f"({cpt_sql(source, n, p, where=where)})" for n, p in families.items()) + ")"


@query("p1_cpt_mle", with_ctes(DN, DN_CPT) + CPT_OUT + "cpt")
def p1(spark, d):
    return cpt_out(dn_cases(spark, d), DN1)


NB_CPT = {"any_return": [], "size_band": ["any_return"], "o_orderpriority": ["any_return"]}
TARGET = "any_return is not null"


@query("p10_naive_bayes_cpt", with_ctes(OC) + CPT_OUT + family_union("oc", NB_CPT, TARGET))
def p10(spark, d):
    return cpt_out(labelled(order_cases(spark, d)), NB1)


@query("p13_marginals", with_ctes(OC) + CPT_OUT + family_union("oc", {"o_orderstatus": [], "o_orderpriority": [], "size_band": [], "any_return": []}))
def p13(spark, d):
    return cpt_out(order_cases(spark, d), independent(discrete=["o_orderstatus", "o_orderpriority", "size_band", "any_return"]))


@query("p14_tree_structure", with_ctes(OC) + CPT_OUT + family_union(
    "oc", {"size_band": [], "o_orderstatus": ["size_band"], "o_orderpriority": ["size_band"], "any_return": ["size_band"]}))
def p14(spark, d):
    base = independent(discrete=["size_band", "o_orderstatus", "o_orderpriority", "any_return"])
    return cpt_out(order_cases(spark, d), with_tree_structure(base, "size_band"))


@query("p18_moved_node", with_ctes(DN) + CPT_OUT + family_union(
    "dn", {"size_band": [], "qty_band": ["size_band"], "o_orderpriority": ["any_return"], "any_return": ["size_band"]}))
def p18(spark, d):
    moved = move_node(DN1, "any_return", parents=["size_band"], children=["o_orderpriority"])
    return cpt_out(dn_cases(spark, d), moved)


@query("p7_weighted_cpt", with_ctes(DN) + "select node, parent_key, state, w, round(p, 6) + 0.0 as p from (" + " union all ".join(
    f"({cpt_sql('dn', n, p, weight='coalesce(n_lines, 0)')})" for n, p in DN_FAMILIES.items()) + ")")
def p7(spark, d):
    df = dn_cases(spark, d).withColumn("weight", F.coalesce("n_lines", F.lit(0)))
    return cpt_of(df, DN1, weight="weight").select("node", "parent_key", "state", "w", rnd("p", 6).alias("p"))


def at(c, i):
    return F.get(c, F.lit(i))


def gauss_sql(source, node, parent=None, where="true"):
    key = f"'{parent}=' || {parent}" if parent else "''"
    null = f" and {parent} is not null" if parent else ""
    return (f"select '{node}' as node, {key} as parent_key, count(*) as n, round(avg({node}), 4) + 0.0 as mean, "
            f"round(greatest(var_pop({node}), 1e-6), 3) + 0.0 as var from {source} where {node} is not null{null} and {where} group by all")


@query("p2_gaussian_leaves", with_ctes(OC) + f"({gauss_sql('oc', 'sum_qty', 'any_return')}) union all ({gauss_sql('oc', 'price_k', 'any_return')})")
def p2(spark, d):
    df = labelled(order_cases(spark, d))
    network, centres = discover(df, NB1)
    g = moment_frame(statistics(df, network, centres), network, centres)
    return g.select("node", "parent_key", "n", rnd(at("mean", 0), 4).alias("mean"), rnd(F.greatest(at("cov", 0), F.lit(1e-6)), 3).alias("var"))


REG = """select 'price_k' as node, {key} as parent_key, round(regr_intercept(price_k, sum_qty), 4) + 0.0 as intercept, round(regr_slope(price_k, sum_qty), 5) + 0.0 as slope,
  round(var_pop(price_k) - regr_slope(price_k, sum_qty) * covar_pop(price_k, sum_qty), 3) + 0.0 as var from oc where sum_qty is not null {more} group by all"""


def regression(df, network):
    network, centres = discover(df, network)
    g = moment_frame(statistics(df, network, centres), network, centres).filter("node = 'price_k'")
    # vector: sum_qty (the continuous parent), then price_k
    slope = at("cov", 1) / at("cov", 0)
    return g.select("node", "parent_key", rnd(at("mean", 1) - slope * at("mean", 0), 4).alias("intercept"),
                    rnd(slope, 5).alias("slope"), rnd(at("cov", 3) - slope * at("cov", 1), 3).alias("var"))


@query("p3_linear_gaussian", with_ctes(OC) + REG.format(key="''", more=""))
def p3(spark, d):
    return regression(order_cases(spark, d), GR1)


@query("p16_fully_connected", with_ctes(OC) + REG.format(key="'any_return=' || any_return", more="and any_return is not null"))
def p16(spark, d):
    base = independent(discrete=["any_return"], continuous=["sum_qty", "price_k"])
    return regression(order_cases(spark, d), with_fully_connected_nodes(base, ["any_return", "sum_qty", "price_k"]))


def joint_out(df, network):
    network, centres = discover(df, network)
    g = moment_frame(statistics(df, network, centres), network, centres)
    return g.select("parent_key", "n", rnd(at("mean", 0), 4).alias("mean_a"), rnd(at("mean", 1), 4).alias("mean_b"),
                    rnd(at("cov", 0), 3).alias("var_a"), rnd(at("cov", 3), 3).alias("var_b"), rnd(at("cov", 1), 3).alias("cov"))


@query("p4_multivariate_gaussian", with_ctes(OC) + """select 'any_return=' || any_return as parent_key, count(*) as n, round(avg(sum_qty), 4) + 0.0 as mean_a,
  round(avg(price_k), 4) + 0.0 as mean_b, round(var_pop(sum_qty), 3) + 0.0 as var_a, round(var_pop(price_k), 3) + 0.0 as var_b,
  round(covar_pop(sum_qty, price_k), 3) + 0.0 as cov from oc where any_return is not null group by any_return""")
def p4(spark, d):
    return joint_out(labelled(order_cases(spark, d)), MG1)


@query("p17_multivariate_nodes", """with e as (select vec_id, label, generate_subscripts(embedding, 1) i, unnest(embedding)::double x from embeddings)
  select 'label=' || a.label as parent_key, a.i::int as i, b.i::int as j, count(*) as n, round(avg(a.x), 6) + 0.0 as mean, round(covar_pop(a.x, b.x), 6) + 0.0 as cov
  from e a join e b on b.vec_id = a.vec_id and b.i >= a.i group by all""")
def p17(spark, d):
    # the whole vector is one node
    raw = table(spark, d, "embeddings")
    size = raw.agg(F.max(F.size("embedding"))).head()[0]
    names = [f"e{i + 1}" for i in range(size)]
    df = raw.select("label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])
    net = with_multivariate_nodes(naive_bayes("label", continuous=names), [names])
    net, centres = discover(df, net)
    g = moment_frame(statistics(df, net, centres), net, centres)
    cells = g.select("parent_key", "n", "mean", F.posexplode("cov").alias("at", "cov"))
    i, j = F.floor(F.col("at") / size).cast("int"), (F.col("at") % size).cast("int")
    return cells.filter(i <= j).select("parent_key", (i + 1).alias("i"), (j + 1).alias("j"), "n", rnd(F.get("mean", i), 6).alias("mean"), rnd("cov", 6).alias("cov"))


def mixture_rows(spark, model, hub="Cluster"):
    """k, variable, state, value rows of a star mixture."""
    net = model.network
    rows = [(k, hub, "", "p", float(model.tables[hub][()][s])) for k, s in enumerate(net[hub].states)]
    for n in net.names():
        for k, s in enumerate(net[hub].states):
            if n != hub and net[n].kind == "discrete":
                rows += [(k, n, st, "p", float(p)) for st, p in model.tables[n][(s,)].items() if p > 0]
            elif n != hub:
                m = model.moments[n][(s,)]
                rows += [(k, n, "", "mean", float(m.mean[0])), (k, n, "", "var", max(float(m.cov[0][0]), 1e-6))]
    df = spark.createDataFrame(rows, "k int, variable string, state string, measure string, value double")
    return df.withColumn("value", F.round("value", 4) + F.lit(0.0))


def mixture_sql(p, t, discrete, continuous):
    parts = [f"select k, 'Cluster' as variable, '' as state, 'p' as measure, p as value from {p}h{t}"]
    parts += [f"select k, '{c}', cast(v as varchar), 'p', p from {p}d{t}_{c} where p > 0" for c in discrete]
    for c in continuous:
        parts += [f"select k, '{c}', '', 'mean', m from {p}g{t}_{c}", f"select k, '{c}', '', 'var', v from {p}g{t}_{c}"]
    return "select k, variable, state, measure, round(value, 4) + 0.0 as value from (" + " union all ".join(parts) + ")"


@query("p5_em_mixture_3iter", with_ctes(MX) + mixture_sql("m", 3, ["role"], ["text_len"]))
def p5(spark, d):
    return mixture_rows(spark, fit_mx1(spark, d))


MIX_INIT = """select case_id, k, case when sum_qty is null then 0.5 when (sum_qty >= (select quantile_cont(sum_qty, 0.5) from oc))::int = k then 1.0 else 0.0 end as r
  from oc cross join (select unnest([0, 1]) k)"""


@query("p11_mixture_naive_bayes", with_ctes(OC, em_ctes("m", "oc", MIX_INIT, ["size_band", "any_return"], ["sum_qty", "price_k"], 3))
       + mixture_sql("m", 3, ["size_band", "any_return"], ["sum_qty", "price_k"]))
def p11(spark, d):
    net = mixture(discrete=["size_band", "any_return"], continuous=["sum_qty", "price_k"], latent_states=2)
    model = fit_mixture(order_cases(spark, d), net, iterations=3, tolerance=0.0, start="sum_qty")
    return mixture_rows(spark, model)


P12_SOURCE = f"""{OC}, {quartile_sql('qa', 'sum_qty', 'oc')}, {quartile_sql('qb', 'price_k', 'oc')},
ob as (select case_id, {band_sql('sum_qty', 'qa')} as qty, {band_sql('price_k', 'qb')} as price, case when sum_qty is null then null when sum_qty < qa.q2 then 0 else 1 end as half from oc, qa, qb)"""
P12_INIT = """select case_id, k, case when half is null then 0.5 when half = k then 1.0 else 0.0 end as r from ob cross join (select unnest([0, 1]) k)"""


@query("p12_discretised_mixture", with_ctes(P12_SOURCE, em_ctes("m", "ob", P12_INIT, ["qty", "price"], [], 3)) + mixture_sql("m", 3, ["qty", "price"], []))
def p12(spark, d):
    oc = order_cases(spark, d).select("case_id", F.col("sum_qty").alias("qty"), F.col("price_k").alias("price"))
    df, net = B.discretise(oc, mixture(continuous=["qty", "price"], latent_states=2), ["qty", "price"])
    return mixture_rows(spark, fit_mixture(df, net, iterations=3, tolerance=0.0, start="qty"))


DC_INIT = """select case_id, k, case when quality = k then 1.0 else 0.0 end as r from dc cross join (select unnest([0, 1]) k) where quality is not null"""


@query("p6_partly_observed_class", with_ctes(DC, em_ctes("m", "dc", DC_INIT, ["lang"], ["ln_chars"], 3, hub="quality"))
       + mixture_sql("m", 3, ["lang"], ["ln_chars"]).replace("'Cluster'", "'quality'"))
def p6(spark, d):
    dc = doc_cases(spark, d)
    net = naive_bayes("quality", discrete=["lang"], continuous=["ln_chars"])
    first = fit(dc.filter("quality is not null"), net)
    return mixture_rows(spark, fit_mixture(dc, net, iterations=3, tolerance=0.0, initial=first), hub="quality")


@query("p6_missing_inner_node")
def p6b(spark, d):
    # half of the bands are hidden; the bands sit above any_return
    df = dn_cases(spark, d).withColumn("qty_band", F.when(F.col("case_id") % 2 == 0, F.col("qty_band")))
    net = independent(discrete=["size_band", "qty_band", "any_return"])
    model = fit_incomplete(df, with_edges(net, [("size_band", "qty_band"), ("qty_band", "any_return")]), iterations=5, tolerance=0.0)
    return model.cpt_frame(spark).select("node", "parent_key", "state", rnd("p", 4).alias("p"))


@query("p8_metrics_naive_bayes", with_ctes(NB, NB_LL, "nl as (select ll from nll join oc using (case_id) where any_return is not null)",
       """k as (select (1 + 2 * (count(distinct size_band) - 1) + 2 * (count(distinct o_orderpriority) - 1) + 8)::double k from oc where any_return is not null)""")
       + """select round(sum(ll), 2) + 0.0 as loglikelihood, count(*) as case_count, count(*)::double as weighted_case_count, count(*) as unweighted_case_count,
  1::bigint as iteration_count, true as converged, round(-2 * sum(ll) + max(k) * ln(count(*)), 2) + 0.0 as bic from nl, k""")
def p8(spark, d):
    df = labelled(order_cases(spark, d))
    model = fit(df, NB1)
    return training_metrics(score(df, model, [ModelStatistics()]), model).withColumns(
        {"loglikelihood": rnd("loglikelihood", 2), "bic": rnd("bic", 2)})


@query("p8_metrics_mixture", with_ctes(MX) + """select round(sum(ll), 2) + 0.0 as loglikelihood, count(*) as case_count, count(*)::double as weighted_case_count,
  count(*) as unweighted_case_count, 3::bigint as iteration_count, false as converged,
  round(-2 * sum(ll) + (1 + 2 * ((select count(distinct role) from tc) - 1) + 4) * ln(count(*)), 2) + 0.0 as bic from mr4 where k = 0""")
def p8b(spark, d):
    model = fit_mx1(spark, d)
    scored = score(turn_cases(spark, d), model, [ModelStatistics()])
    return training_metrics(scored, model, iterations=model.iterations, converged=model.converged).withColumns(
        {"loglikelihood": rnd("loglikelihood", 2), "bic": rnd("bic", 2)})


@query("p9_missing_families", with_ctes(DN) + """select 'any_return' as node, 'qty_band=' || q || '|size_band=' || s as parent_key from
  (select distinct qty_band q from dn where qty_band is not null), (select distinct size_band s from dn where size_band is not null)
  where not exists (select 1 from dn where any_return is not null and qty_band = q and size_band = s)""")
def p9(spark, d):
    df = dn_cases(spark, d)
    network, centres = discover(df, DN1)
    # small orders never reach the upper quantity bands: families that no case has
    cpt = cpt_frame(statistics(df, network, centres))
    return missing_families(cpt, network, ["any_return"])


@query("p15_latent_parent")
def p15(spark, d):
    # a latent cluster above size_band -> any_return
    base = with_edges(independent(discrete=["size_band", "any_return"], continuous=["sum_qty"]), [("size_band", "any_return")])
    model = fit_mixture(labelled(order_cases(spark, d)), with_latent_node(base, 2), iterations=3, start="sum_qty")
    return model.cpt_frame(spark).select("node", "parent_key", "state", rnd("p", 4).alias("p"))


# -- structure -----------------------------------------------------------------

G_COLUMNS = ["size_band", "o_orderpriority", "o_orderstatus", "any_return"]


def mi_sql(source, a, b, c=None):
    ok = f"{a} is not null and {b} is not null" + (f" and {c} is not null" if c else "")
    z = c or "0"
    head = f"'{a}' as a, '{b}' as b" + (f", '{c}' as c" if c else "")
    name = "cmi" if c else "mi"
    return f"""select {head}, round(sum(n * ln(n::double * nz / (nxz::double * nyz))) / max(t), 6) + 0.0 as {name},
  round(2 * sum(n * ln(n::double * nz / (nxz::double * nyz))), 3) + 0.0 as g2,
  ((count(distinct x) - 1) * (count(distinct y) - 1) * count(distinct z))::bigint as df
  from (select *, sum(n) over (partition by x, z) nxz, sum(n) over (partition by y, z) nyz, sum(n) over (partition by z) nz, sum(n) over () t from
    (select {a} x, {b} y, {z} z, count(*) n from {source} where {ok} group by 1, 2, 3))"""


PAIRS = [(a, b) for i, a in enumerate(G_COLUMNS) for b in G_COLUMNS[i + 1:]]


@query("g1_mutual_information", with_ctes(OC) + " union all ".join(f"({mi_sql('oc', a, b)})" for a, b in PAIRS))
def g1(spark, d):
    return mutual_information(order_cases(spark, d), G_COLUMNS).withColumns({"mi": rnd("mi", 6), "g2": rnd("g2", 3)})


@query("g1_conditional_information", with_ctes(DN) + " union all ".join(
    f"({mi_sql('dn', a, b, 'any_return')})" for a, b in [("size_band", "o_orderpriority"), ("size_band", "qty_band"), ("o_orderpriority", "qty_band")]))
def g1c(spark, d):
    return mutual_information(dn_cases(spark, d), ["size_band", "o_orderpriority", "qty_band", "any_return"], given="any_return").withColumns(
        {"cmi": rnd("cmi", 6), "g2": rnd("g2", 3)})


G2_COLUMNS = ["size_band", "o_orderpriority", "qty_band", "any_return"]


@query("g2_pc_structure")
def g2(spark, d):
    return links_frame(dn_cases(spark, d), learn_pc(dn_cases(spark, d), discrete=G2_COLUMNS))


WEAK = 0.0001
CHI = "(df > 0 and (power(g2 / df, 1.0 / 3) - (1 - 2.0 / (9 * df))) / sqrt(2.0 / (9 * df)) >= {})"


@query("g2_pc_control", with_ctes(EC) + f"select count(*) as n_links from ({mi_sql('ec', 'event_type', 'hr')}) where {CHI.format(repr(NormalDist().inv_cdf(1 - WEAK)))}")
def g2b(spark, d):
    # independent columns: links only by chance at the test's level
    df = event_cases(spark, d)
    return links_frame(df, learn_pc(df, discrete=["event_type", "hr"], alpha=WEAK)).agg(F.count(F.lit(1)).alias("n_links"))


@query("g2_pc_continuous")
def g2c(spark, d):
    df = order_cases(spark, d)
    return links_frame(df, learn_pc(df, continuous=["n_lines", "sum_qty", "price_k", "o_totalprice"], alpha=0.001))


def tan_sql():
    """TAN over three features: the spanning tree leaves out the weakest of the three pairs."""
    pairs = [("size_band", "o_orderpriority"), ("size_band", "qty_band"), ("o_orderpriority", "qty_band")]
    w = " union all ".join(f"({mi_sql('dn', a, b, 'any_return')})" for a, b in pairs)
    return with_ctes(DN, f"w as ({w})", "kept as (select a, b from w order by cmi desc, a, b limit 2)") + """
  select 'any_return' as parent, unnest(['size_band', 'o_orderpriority', 'qty_band']) as child
  union all select 'size_band', case when a = 'size_band' then b else a end from kept where a = 'size_band' or b = 'size_band'
  union all select case when exists (select 1 from kept where a = 'size_band' and b = 'o_orderpriority') and not exists (select 1 from kept where a = 'size_band' and b = 'qty_band')
      then 'o_orderpriority' else 'qty_band' end,
    case when exists (select 1 from kept where a = 'size_band' and b = 'o_orderpriority') and not exists (select 1 from kept where a = 'size_band' and b = 'qty_band')
      then 'qty_band' else 'o_orderpriority' end
    from kept where a = 'o_orderpriority' and b = 'qty_band'"""


@query("g3_tan_structure", tan_sql())
def g3(spark, d):
    df = dn_cases(spark, d)
    return links_frame(df, learn_tan(df, "any_return", ["size_band", "o_orderpriority", "qty_band"]))


def held_out_sql(child: str, parents) -> str:
    """Held-out loglikelihood of one family over the folds, counts smoothed by 1."""
    names = [child, *parents]
    row = f"partition by {', '.join(parents)}" if parents else ""
    own = f"partition by {', '.join([*parents, 'fold'])}"
    return f"""select '{child}' as child, '{','.join(sorted(parents))}' as parents, sum(n * ln((sum_cell - n + 1) / (sum_row - sum_own + (select count(distinct {child}) from gf)))) as s from (
      select n, sum(n) over (partition by {', '.join(names)}) sum_cell, sum(n) over ({row}) sum_row, sum(n) over ({own}) sum_own
      from (select {', '.join(names)}, fold, count(*)::double n from gf where {' and '.join(x + ' is not null' for x in names)} group by all))"""


def greedy_structure_sql() -> str:
    """Links into each column from those before it, by falling mutual information, kept while they raise the score."""
    out = [f"gf as (select *, {FOLD_SQL} as fold from dn)",
           "mi as (" + " union all ".join(f"({mi_sql('gf', a, b)})" for a, b in combinations(G2_COLUMNS, 2)) + ")",
           "ranked as (select a, b, row_number() over (partition by b order by mi desc, a) r from mi)",
           "fs as materialized (" + " union all ".join(f"({held_out_sql(c, ps)})" for i, c in enumerate(G2_COLUMNS) for n in range(i + 1) for ps in combinations(G2_COLUMNS[:i], n)) + ")",
           "st0 as (select unnest([" + ", ".join(f"'{c}'" for c in G2_COLUMNS) + "]) child, []::varchar[] ps)"]
    score = lambda ps: f"(select s from fs where fs.child = st.child and fs.parents = array_to_string(list_sort({ps}), ','))"      # noqa: E731
    for k in range(1, len(G2_COLUMNS)):
        out.append(f"""st{k} as (select st.child, case when a is not null and {score('list_append(ps, a)')} > {score('ps')} + 1e-9 then list_append(ps, a) else ps end as ps
          from st{k - 1} st left join ranked on b = st.child and r = {k})""")
    return with_ctes(DN, *out) + f"select unnest(ps) as parent, child from st{len(G2_COLUMNS) - 1}"


@query("g4_greedy_structure", greedy_structure_sql())
def g4(spark, d):
    df = hash_folds(dn_cases(spark, d), "case_id", 3, 7, name="fold")
    return links_frame(df, learn_greedy(df, G2_COLUMNS, fold="fold", k=3))


def refit_sql() -> str:
    """CPTs of the TAN links: every family that the links may give, where they do."""
    other = {"size_band": [], "o_orderpriority": ["size_band", "qty_band"], "qty_band": ["size_band", "o_orderpriority"]}
    tan = tan_sql()
    # the links as one more table of the same statement
    head, links = tan[:tan.index("select 'any_return' as parent")], tan[tan.index("select 'any_return' as parent"):]
    parts = [cpt_sql("dn", "any_return")]
    for child, extra in other.items():
        none = " and ".join(f"not exists (select 1 from tan where parent = '{p}' and child = '{child}')" for p in extra) or "true"
        parts.append(f"select * from ({cpt_sql('dn', child, ['any_return'])}) where {none}")
        parts += [f"select * from ({cpt_sql('dn', child, ['any_return', p])}) where exists (select 1 from tan where parent = '{p}' and child = '{child}')" for p in extra]
    return f"{head.rstrip()}, tan as ({links}) " + CPT_OUT + "(" + " union all ".join(f"({p})" for p in parts) + ")"


@query("g4_refit_learned_links", refit_sql())
def g4b(spark, d):
    # a learned link list is used like any other edge list
    df = dn_cases(spark, d)
    links = learn_tan(df, "any_return", ["size_band", "o_orderpriority", "qty_band"])
    return cpt_out(df, from_links(independent(discrete=G2_COLUMNS), links))


# -- tests over both kinds of columns ------------------------------------------------

CG_TESTS = [("any_return", "sum_qty", ()), ("any_return", "price_k", ()), ("any_return", "price_k", ("sum_qty",)), ("any_return", "sum_qty", ("price_k",)),
            ("size_band", "price_k", ("sum_qty",)), ("size_band", "price_k", ("any_return",)), ("sum_qty", "price_k", ("any_return",)),
            ("any_return", "price_k", ("size_band", "sum_qty"))]
CG_CONTINUOUS = ["sum_qty", "price_k"]


def cg_sql(a: str, b: str, given) -> str:
    """Conditional-Gaussian likelihood ratio of one test: `g2`, `df` (at most two continuous columns)."""
    names = [a, b, *given]
    ds, cs = [n for n in names if n not in CG_CONTINUOUS], [n for n in names if n in CG_CONTINUOUS]
    keys = ", ".join(ds) or "0"
    source = (f"(select * from (select {', '.join(names)}, count(*) over (partition by {keys}) cell_n from oc where {' and '.join(n + ' is not null' for n in names)}) "
              f"where cell_n >= {len(cs) + 2})")
    terms, free = [], []
    for sign, own in (("", names), ("", list(given)), ("-", [a, *given]), ("-", [b, *given])):
        d, c = [n for n in ds if n in own], [n for n in cs if n in own]
        v = [f"(var_pop({n}) + 1e-9 * (select var_pop({n}) from oc))" for n in c]
        det = f"ln({v[0]} * {v[1]} - covar_pop({c[0]}, {c[1]}) * covar_pop({c[0]}, {c[1]}))" if len(c) == 2 else f"ln({v[0]})" if c else "0"
        group = f"group by {', '.join(d)}" if d else ""
        terms.append(f"{sign}coalesce((select sum(n * ln(n) - n / 2.0 * ld) from (select count(*) n, {det} ld from {source} {group})), 0)")
        free.append(f"{sign}{1 + len(c) + len(c) * (len(c) + 1) // 2} * (select count(*) from (select count(*) from {source} {group}))")
    return (f"select '{a}' as a, '{b}' as b, '{','.join(given)}' as given, round(greatest(2 * ({' + '.join(terms)}), 0), 2) + 0.0 as g2, "
            f"({' + '.join(free)})::int as df")


@query("g2_mixed_tests", with_ctes(OC) + " union all ".join(f"({cg_sql(*t)})" for t in CG_TESTS))
def g2_mixed_tests(spark, d):
    found = independence(order_cases(spark, d), ["any_return", "size_band"], CG_CONTINUOUS, CG_TESTS)
    return found.select("a", "b", "given", rnd("g2", 2).alias("g2"), "df")


ALPHA = 0.001
# p <= alpha in terms of the statistics themselves: the normal approximation of chi-square, and Fisher's z
DEPENDENT = f"""(df > 0 and (power(g2 / greatest(df, 1), 1.0 / 3) - (1 - 2.0 / (9 * greatest(df, 1)))) / sqrt(2.0 / (9 * greatest(df, 1))) >= {NormalDist().inv_cdf(1 - ALPHA)!r})"""
CORRELATED = f"(select sqrt(count(*) - 3) * abs(atanh(corr(sum_qty, price_k))) >= {NormalDist().inv_cdf(1 - ALPHA / 2)!r} from oc where sum_qty is not null and price_k is not null)"


@query("g2_pc_mixed", with_ctes(OC, *[f"{n} as (select {DEPENDENT} as yes from ({cg_sql(*t)}))" for n, t in (
    ("aq", ("any_return", "sum_qty", ())), ("ap", ("any_return", "price_k", ())), ("aq_p", ("any_return", "sum_qty", ("price_k",))),
    ("ap_q", ("any_return", "price_k", ("sum_qty",))), ("qp_a", ("sum_qty", "price_k", ("any_return",))))],
    f"first as (select (select yes from aq) aq, (select yes from ap) ap, {CORRELATED} qp)",
    # a test given the third column counts where that column is still linked to one of the two
    """second as (select aq and ((select yes from aq_p) or not (ap or qp)) aq, ap and ((select yes from ap_q) or not (aq or qp)) ap,
      qp and ((select yes from qp_a) or not (aq or ap)) qp from first)""") + """
  select 'any_return' as parent, 'sum_qty' as child from second where aq union all select 'any_return', 'price_k' from second where ap
  union all select 'sum_qty', 'price_k' from second where qp""")
def g2_pc_mixed(spark, d):
    df = order_cases(spark, d)
    return links_frame(df, learn_pc(df, discrete=["any_return"], continuous=CG_CONTINUOUS, alpha=ALPHA))
