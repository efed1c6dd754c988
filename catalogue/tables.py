"""Case tables over the given data, as DataFrames and as SQL for the comparison engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from posterion.operators.bins import assign, equal_frequency
from posterion.plans.network import Network, Variable
from posterion.plans.templates import independent, mixture, naive_bayes, with_edges

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, its SQL twin."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def rnd(c, digits: int):
    from posterion.functions.scalars import rounded
    return rounded(F.col(c) if isinstance(c, str) else c, digits)


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- case tables ---------------------------------------------------------------

def order_cases(spark, d) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("case_id")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"), F.sum("l_extendedprice").alias("sum_price"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("any_return"),
        F.max("l_linenumber").alias("last_line"))
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("case_id"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    band = F.when(F.col("n_lines") <= 2, "S").when(F.col("n_lines") <= 5, "M").when(F.col("n_lines") > 5, "L")
    return (orders.join(lines, "case_id", "left").withColumn("size_band", band)
            .withColumn("price_k", F.col("sum_price") / 1000))


def turn_cases(spark, d) -> DataFrame:
    return table(spark, d, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("case_id"), "conv_id", "turn", "role",
        F.length("text").alias("text_len"))


def doc_cases(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.ln(F.col("n_chars").cast("double")).alias("ln_chars"),
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("n_spaces"))
    return docs.join(table(spark, d, "labels"), "doc_id", "left").withColumnRenamed("doc_id", "case_id")


def event_cases(spark, d) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").alias("case_id"), "user_id", "event_type", "value", F.hour("ts").alias("hr"))


def emb_cases(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("case_id"), "label",
        *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i + 1}") for i in range(4)])


def prep_cases(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.alias("case_id"), "c_name", "c_acctbal", "c_mktsegment", F.lit("k").alias("const_col"),
        F.when(k % 20 == 0, "n/a").otherwise(F.col("c_nationkey").cast("string")).alias("num_text"),
        F.when(k % 15 == 0, F.col("c_acctbal")).alias("mostly_null"),
        F.when(k % 3 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("zero_infl"),
        F.when(k % 2 == 0, 1).otherwise(0).alias("flag01"),
        F.when(k % 5 != 0, F.concat(F.lit("X "), F.substring(F.lit("ABCDEFG"), (k % 7).cast("int") + 1, F.lit(1)),
                                    (k % 200).cast("string"))).alias("cabin"))


OC = """oc as (
  select o_orderkey as case_id, o_orderstatus, o_orderpriority, o_totalprice,
         n_lines, sum_qty, sum_price, any_return, last_line,
         case when n_lines <= 2 then 'S' when n_lines <= 5 then 'M' when n_lines > 5 then 'L' end as size_band,
         sum_price / 1000 as price_k
  from orders left join (
    select l_orderkey, count(*) as n_lines, sum(l_quantity) as sum_qty, sum(l_extendedprice) as sum_price,
           max(case when l_returnflag = 'R' then 1 else 0 end) as any_return, max(l_linenumber) as last_line
    from lineitem group by l_orderkey) x on o_orderkey = l_orderkey)"""
TC = """tc as (select conv_id * 100 + turn as case_id, conv_id, turn, role, length(text) as text_len from conversations)"""
DC = """dc as (select d.doc_id as case_id, lang, source, n_chars, ln(n_chars::double) as ln_chars,
  length(text) - length(replace(text, ' ', '')) as n_spaces, quality, toxic
  from documents d left join labels l on d.doc_id = l.doc_id)"""
EC = """ec as (select event_id as case_id, user_id, event_type, value, hour(ts) as hr from events)"""
EM = """em as (select vec_id as case_id, label, embedding[1]::double as e1, embedding[2]::double as e2,
  embedding[3]::double as e3, embedding[4]::double as e4 from embeddings)"""
PC = """pc as (select c_custkey as case_id, c_name, c_acctbal, c_mktsegment, 'k' as const_col,
  case when c_custkey % 20 = 0 then 'n/a' else cast(c_nationkey as varchar) end as num_text,
  case when c_custkey % 15 = 0 then c_acctbal end as mostly_null,
  case when c_custkey % 3 = 0 then 0.0 else c_acctbal end as zero_infl,
  case when c_custkey % 2 = 0 then 1 else 0 end as flag01,
  case when c_custkey % 5 = 0 then null else 'X ' || substr('ABCDEFG', cast(c_custkey % 7 as int) + 1, 1)
    || cast(c_custkey % 200 as varchar) end as cabin from customer)"""


# -- shared models ---------------------------------------------------------------

NB1_DISCRETE = ["size_band", "o_orderpriority"]
NB1_CONTINUOUS = ["sum_qty", "price_k"]
NB1 = naive_bayes("any_return", discrete=NB1_DISCRETE, continuous=NB1_CONTINUOUS)
MX1 = mixture(discrete=["role"], continuous=["text_len"], latent_states=2)
DN1 = with_edges(independent(discrete=["size_band", "o_orderpriority", "qty_band", "any_return"]),
                 [("size_band", "qty_band"), ("size_band", "any_return"), ("qty_band", "any_return")])
GR1 = with_edges(independent(continuous=["sum_qty", "price_k"]), [("sum_qty", "price_k")])
MG1 = Network((Variable("any_return"), Variable("sum_qty", "continuous"), Variable("price_k", "continuous")),
              (("any_return", "sum_qty"), ("any_return", "price_k")), (("sum_qty", "price_k"),))


def dn_cases(spark, d) -> DataFrame:
    """order_cases with qty_band: four equal-frequency bins of sum_qty."""
    oc = order_cases(spark, d)
    return assign(oc, "sum_qty", equal_frequency(oc, ["sum_qty"], 4)["sum_qty"], name="qty_band")


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("any_return").isNotNull())


def f4(x: str) -> str:
    return f"printf('%.4f', round({x}, 4))"


def band_sql(column: str, q: str) -> str:
    """Label of the equal-frequency bin of a column; q holds the three inner edges q1..q3."""
    return (f"case when {column} is null then null when {column} < {q}.q1 then '[-inf,' || {f4(q + '.q1')} || ')' "
            f"when {column} < {q}.q2 then '[' || {f4(q + '.q1')} || ',' || {f4(q + '.q2')} || ')' "
            f"when {column} < {q}.q3 then '[' || {f4(q + '.q2')} || ',' || {f4(q + '.q3')} || ')' "
            f"else '[' || {f4(q + '.q3')} || ',inf)' end")


def quartile_sql(name: str, column: str, source: str) -> str:
    return (f"{name} as (select quantile_cont({column}, 0.25) q1, quantile_cont({column}, 0.5) q2, "
            f"quantile_cont({column}, 0.75) q3 from {source})")


DN = f"""{OC}, {quartile_sql('eq', 'sum_qty', 'oc')},
dn as (select oc.*, {band_sql('sum_qty', 'eq')} as qty_band from oc, eq)"""


def cpt_sql(source: str, node: str, parents=(), weight: str = "1", where: str = "true") -> str:
    """select node, parent_key, state, n, w, p of one family."""
    parents = sorted(parents)
    ok = " and ".join(f"{c} is not null" for c in [node, *parents])
    key = " || '|' || ".join(f"'{p}=' || cast({p} as varchar)" for p in parents) or "''"
    return (f"select node, parent_key, state, n, w, w / sum(w) over (partition by parent_key) as p from ("
            f"select '{node}' as node, {key} as parent_key, cast({node} as varchar) as state, count(*) as n, sum({weight})::double as w "
            f"from {source} where {ok} and {where} and {weight} > 0 group by all)")


DN_FAMILIES = {"size_band": [], "o_orderpriority": [], "qty_band": ["size_band"], "any_return": ["qty_band", "size_band"]}
DN_CPT = "cpt as (" + " union all ".join(f"({cpt_sql('dn', n, p)})" for n, p in DN_FAMILIES.items()) + ")"
# the discrete network's tables with their columns side by side, for joins
DN_WIDE = """p_size as (select size_band, count(*)::double / sum(count(*)) over () p from dn where size_band is not null group by 1),
p_prio as (select o_orderpriority, count(*)::double / sum(count(*)) over () p from dn where o_orderpriority is not null group by 1),
p_qty as (select size_band, qty_band, count(*)::double / sum(count(*)) over (partition by size_band) p from dn
  where size_band is not null and qty_band is not null group by 1, 2),
p_ret as (select size_band, qty_band, any_return, count(*)::double / sum(count(*)) over (partition by size_band, qty_band) p from dn
  where size_band is not null and qty_band is not null and any_return is not null group by 1, 2, 3),
joint as (select s.size_band, o.o_orderpriority, q.qty_band, cast(r.any_return as varchar) any_return, s.p * o.p * q.p * r.p p
  from p_size s cross join p_prio o join p_qty q on q.size_band = s.size_band
  join p_ret r on r.size_band = q.size_band and r.qty_band = q.qty_band)"""


def log_normal(x: str, m: str, v: str) -> str:
    return f"(-0.5 * ln(2 * pi() * {v}) - ({x} - {m}) * ({x} - {m}) / (2 * {v}))"


def nb_ctes(prefix: str, source: str, target: str, discrete, continuous, train: str = "true", by: str | None = None,
            id_col: str = "case_id") -> str:
    """CTEs of a naive-Bayes fit and its per-class terms.

    Result `<prefix>s`: id, k, prior, t_<column> per feature, s (their sum). With `by` (a fold
    column) each row is scored with parameters of all other folds.
    """
    p = prefix
    tr = f"{p}tr as (select * from {source} where {target} is not null and {train})"
    inf = "'-infinity'::double"
    if by is None:
        on = lambda a: f"{a}.k = c.k"
        out = [tr, f"{p}prior as (select {target} k, count(*)::double / sum(count(*)) over () p from {p}tr group by 1)"]
        for f in discrete:
            out.append(f"{p}d_{f} as (select {target} k, {f} v, count(*)::double / sum(count(*)) over (partition by {target}) p "
                       f"from {p}tr where {f} is not null group by 1, 2)")
        for f in continuous:
            out.append(f"{p}g_{f} as (select {target} k, avg({f}) m, greatest(var_pop({f}), 1e-6) v from {p}tr where {f} is not null group by 1)")
        base = f"{p}b as (select t.*, c.k, c.p as prior_p from {source} t cross join {p}prior c)"
        match = lambda a: f"{a}.k = b.k"
    else:
        folds = f"{p}folds as (select distinct {by} ff from {source})"
        out = [tr, folds, f"{p}trx as (select t.*, x.ff from {p}tr t join {p}folds x on t.{by} <> x.ff)",
               f"{p}prior as (select ff, {target} k, count(*)::double / sum(count(*)) over (partition by ff) p from {p}trx group by 1, 2)"]
        for f in discrete:
            out.append(f"{p}d_{f} as (select ff, {target} k, {f} v, count(*)::double / sum(count(*)) over (partition by ff, {target}) p "
                       f"from {p}trx where {f} is not null group by 1, 2, 3)")
        for f in continuous:
            out.append(f"{p}g_{f} as (select ff, {target} k, avg({f}) m, greatest(var_pop({f}), 1e-6) v from {p}trx where {f} is not null group by 1, 2)")
        base = f"{p}b as (select t.*, c.k, c.p as prior_p from {source} t join {p}prior c on c.ff = t.{by})"
        match = lambda a: f"{a}.k = b.k and {a}.ff = b.{by}"
    out.append(base)
    terms = [f"ln(b.prior_p) as prior"]
    joins = []
    for i, f in enumerate(discrete):
        a = f"d{i}"
        joins.append(f"left join {p}d_{f} {a} on {match(a)} and {a}.v = b.{f}")
        terms.append(f"case when b.{f} is null then 0 when {a}.p > 0 then ln({a}.p) else {inf} end as t_{f}")
    for i, f in enumerate(continuous):
        a = f"g{i}"
        joins.append(f"left join {p}g_{f} {a} on {match(a)}")
        terms.append(f"case when b.{f} is null then 0 when {a}.m is null then {inf} else {log_normal('b.' + f, a + '.m', a + '.v')} end as t_{f}")
    total = " + ".join(["prior"] + [f"t_{f}" for f in [*discrete, *continuous]])
    out.append(f"{p}t as (select b.*, {', '.join(terms)} from {p}b b {' '.join(joins)})")
    out.append(f"{p}s as (select *, {total} as s from {p}t)")
    return ", ".join(out)


NB = f"{OC}, " + nb_ctes("n", "oc", "any_return", NB1_DISCRETE, NB1_CONTINUOUS)
NB_LL = """nll as (select case_id, m + ln(sum(exp(e - m))) ll from (
  select *, max(e) over (partition by case_id) m from (
    select case_id, k, case when any_return is null or any_return = k then s else '-infinity'::double end e from ns)) group by case_id, m)"""
NB_P = """npost as (select case_id, k, any_return, exp(s - m) / sum(exp(s - m)) over (partition by case_id) p from (
  select *, max(s) over (partition by case_id) m from ns)),
npred as (select case_id, any_return, cast(k as varchar) pred, p from (
  select *, row_number() over (partition by case_id order by p desc, k) r from npost) where r = 1)"""


def em_ctes(prefix: str, source: str, init: str, discrete, continuous, iterations: int, weight: str = "1",
            hub: str | None = None) -> str:
    """Unrolled EM of a star mixture. `init` selects case_id, k, r. The result of the last
    M-step is `<prefix>h<T>`, `<prefix>d<T>_<c>`, `<prefix>g<T>_<c>`; `<prefix>ll<t>` is the
    loglikelihood before the t-th M-step and `<prefix>r<t>` its responsibilities."""
    p, out = prefix, [f"{prefix}r0 as materialized ({init})"]
    inf = "'-infinity'::double"
    for t in range(iterations + 1):
        r = f"{p}r{t} r join {source} x on x.case_id = r.case_id"
        out.append(f"{p}h{t} as materialized (select k, sum(r * {weight}) w, sum(r * {weight}) / sum(sum(r * {weight})) over () p from {r} group by k)")
        for c in discrete:
            out.append(f"{p}d{t}_{c} as materialized (select k, {c} v, sum(r * {weight}) w, sum(r * {weight}) / sum(sum(r * {weight})) over (partition by k) p "
                       f"from {r} where {c} is not null group by 1, 2)")
        for c in continuous:
            # centred on the column mean, so that the moment form keeps its digits
            mid = f"(select avg({c}) from {source})"
            out.append(f"{p}g{t}_{c} as materialized (select k, w, m0 + mid m, greatest(q - m0 * m0, 1e-6) v from (select k, {mid} mid, sum(r * {weight}) w, "
                       f"sum(r * {weight} * ({c} - {mid})) / sum(r * {weight}) m0, sum(r * {weight} * ({c} - {mid}) * ({c} - {mid})) / sum(r * {weight}) q "
                       f"from {r} where {c} is not null group by 1 having sum(r * {weight}) > 0))")
        joins = [f"left join {p}d{t}_{c} d{i} on d{i}.k = h.k and d{i}.v = x.{c}" for i, c in enumerate(discrete)]
        joins += [f"left join {p}g{t}_{c} g{i} on g{i}.k = h.k" for i, c in enumerate(continuous)]
        terms = [f"case when x.{c} is null then 0 when d{i}.p > 0 then ln(d{i}.p) else {inf} end" for i, c in enumerate(discrete)]
        terms += [f"case when x.{c} is null then 0 when g{i}.m is null then {inf} else {log_normal('x.' + c, f'g{i}.m', f'g{i}.v')} end"
                  for i, c in enumerate(continuous)]
        s = " + ".join([f"case when h.p > 0 then ln(h.p) else {inf} end", *terms])
        if hub:
            s = f"case when x.{hub} is null or x.{hub} = h.k then {s} else {inf} end"
        out.append(f"{p}s{t} as materialized (select x.case_id, h.k, {s} as s from {source} x cross join {p}h{t} h {' '.join(joins)})")
        out.append(f"{p}r{t + 1} as materialized (select case_id, k, exp(s - m) / sum(exp(s - m)) over (partition by case_id) r, "
                   f"m + ln(sum(exp(s - m)) over (partition by case_id)) ll from (select *, max(s) over (partition by case_id) m from {p}s{t}))")
    return ", ".join(out)


MX_INIT = """select case_id, k, case when (text_len >= (select quantile_cont(text_len, 0.5) from tc))::int = k then 1.0 else 0.0 end as r
  from tc cross join (select unnest([0, 1]) k)"""
MX = f"{TC}, " + em_ctes("m", "tc", MX_INIT, ["role"], ["text_len"], 3)


def fit_mx1(spark, d):
    from posterion.operators.mixture import fit_mixture
    return fit_mixture(turn_cases(spark, d), MX1, iterations=3, tolerance=0.0, start="text_len")


def with_ctes(*parts: str) -> str:
    return "with " + ", ".join(parts) + " "
