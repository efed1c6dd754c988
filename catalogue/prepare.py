"""Queries of the case-table, type, pruning and binning operators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from catalogue.tables import (DN, NB1, OC, PC, TC, QUERIES, dn_cases, f4, labelled, order_cases, prep_cases, query, quartile_sql,
                              rnd, table, turn_cases, with_ctes, band_sql)
from posterion.functions.scalars import (cast_state, finite, first_token_match, pack_state, replace_zero_with_normal,
                                         unpack_state)
from posterion.operators import bins as B
from posterion.operators import profile as P
from posterion.operators.fit import fit
from posterion.operators.ranking import dense_ids
from posterion.plans.model import Model
from posterion.plans.network import Network, Variable
from posterion.sources import cases as C
from posterion.sources.storage import stage_path

HASH = "('0x' || substr(md5(cast({id} as varchar) || ':{seed}'), 1, 8))::ubigint"


@query("s1_scan", "select * from orders")
def s1(spark, d):
    return C.read_table(spark, f"{d}/orders.parquet")


@query("s1_csv_scan", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def s1_csv(spark, d):
    path = stage_path(spark, "orders-csv")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    orders.write.option("header", True).csv(path)
    return C.read_csv(spark, path, schema=orders.schema)


@query("s2_bind_cases", with_ctes(OC) + """select count(*)::bigint n_rows, count(distinct case_id)::bigint n_ids,
  sum(case when coalesce(n_lines, 0) < 0 then 1 else 0 end)::bigint n_bad_weight, sum(coalesce(n_lines, 0))::double sum_weight from oc""")
def s2(spark, d):
    oc = order_cases(spark, d).withColumn("w", F.coalesce("n_lines", F.lit(0)))
    return C.check_cases(oc, "case_id", "w")


@query("s3_stage", with_ctes(OC) + "select case_id, sum_qty from oc")
def s3(spark, d):
    return C.stage(order_cases(spark, d).select("case_id", "sum_qty"), stage_path(spark, "cases"))


@query("s4_rows_by_id", with_ctes(OC) + "select case_id, o_orderstatus from oc where case_id % 10 = 3")
def s4(spark, d):
    ids = table(spark, d, "orders").filter("o_orderkey % 10 = 3").select(F.col("o_orderkey").alias("case_id"))
    return C.rows_by_id(order_cases(spark, d), ids, "case_id").select("case_id", "o_orderstatus")


@query("s5_subset", with_ctes(OC) + "select case_id, o_orderstatus from oc where case_id % 10 <> 3")
def s5(spark, d):
    ids = table(spark, d, "orders").filter("o_orderkey % 10 <> 3").select(F.col("o_orderkey").alias("case_id"))
    return C.rows_by_id(order_cases(spark, d), ids, "case_id", ordered=False).select("case_id", "o_orderstatus")


@query("s6_dense_ids", with_ctes(TC) + "select case_id, row_number() over (order by case_id) as ix from tc")
def s6(spark, d):
    return dense_ids(turn_cases(spark, d).select("case_id"), "case_id")


@query("s7_gapped_ids")
def s7(spark, d):
    return C.gapped_ids(turn_cases(spark, d).select("case_id"))


@query("s7_gapped_distinct", with_ctes(TC) + "select count(*) as n, count(*) as ids, 0::bigint as missing, 0::bigint as negative from tc")
def s7_distinct(spark, d):
    # the ids themselves depend on the partitions; what they promise does not
    ids = C.gapped_ids(turn_cases(spark, d).select("case_id"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ix").alias("ids"), F.count_if(F.col("ix").isNull()).alias("missing"),
                   F.count_if(F.col("ix") < 0).alias("negative"))


@query("s8_bind_evidence", with_ctes(OC) + """select case_id, case when size_band in ('S', 'M') then size_band end as size_band,
  o_orderpriority from oc""")
def s8(spark, d):
    net = Network((Variable("size_band", states=("S", "M")), Variable("o_orderpriority")))
    return C.bind_evidence(order_cases(spark, d), net, keep=["case_id"])


@query("s9_save_load", with_ctes(OC) + """select * from (
  select 'any_return' node, '' parent_key, cast(any_return as varchar) state, round(count(*)::double / sum(count(*)) over (), 6) + 0.0 p
    from oc where any_return is not null group by any_return
  union all select 'size_band', 'any_return=' || any_return, size_band, round(count(*)::double / sum(count(*)) over (partition by any_return), 6) + 0.0
    from oc where any_return is not null and size_band is not null group by any_return, size_band
  union all select 'o_orderpriority', 'any_return=' || any_return, o_orderpriority, round(count(*)::double / sum(count(*)) over (partition by any_return), 6) + 0.0
    from oc where any_return is not null and o_orderpriority is not null group by any_return, o_orderpriority)""")
def s9(spark, d):
    path = stage_path(spark, "model")
    fit(labelled(order_cases(spark, d)), NB1).save(spark, path)
    return Model.load(spark, path).cpt_frame(spark).filter("p > 0").select("node", "parent_key", "state", rnd("p", 6).alias("p"))


@query("s10_long_rows", with_ctes(OC) + """select case_id, 'o_orderstatus' as variable, o_orderstatus as value from oc where o_orderstatus is not null
  union all select case_id, 'o_orderpriority', o_orderpriority from oc where o_orderpriority is not null
  union all select case_id, 'size_band', size_band from oc where size_band is not null""")
def s10(spark, d):
    return C.long_format(order_cases(spark, d), "case_id", ["o_orderstatus", "o_orderpriority", "size_band"])


@query("s11_add_values", with_ctes(OC) + "select case_id, case when case_id % 7 = 0 then 'late' else '' end as flag from oc")
def s11(spark, d):
    oc = order_cases(spark, d)
    values = table(spark, d, "orders").filter("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("case_id"), F.lit("late").alias("flag"))
    return C.add_values(oc.select("case_id"), values, "case_id", "flag")


# -- types ---------------------------------------------------------------------

PREP = ["c_name", "c_acctbal", "c_mktsegment", "const_col", "num_text", "mostly_null", "zero_infl", "flag01", "cabin"]
PREP_NUMERIC = {"c_acctbal", "mostly_null", "zero_infl", "flag01"}
OC_COLUMNS = ["o_orderstatus", "o_orderpriority", "o_totalprice", "n_lines", "sum_qty", "sum_price", "any_return", "last_line", "size_band"]
OC_NUMERIC = {"o_totalprice", "n_lines", "sum_qty", "sum_price", "any_return", "last_line"}


def values_sql(columns, source: str, select) -> str:
    """One row per column from its value count v (null counted), row count n and present count c."""
    return " union all ".join(
        f"(select '{c}' as column_name, {select(c)} from (select count(distinct {c}) + max(case when {c} is null then 1 else 0 end) v, "
        f"count(distinct {c}) dv, count(*) n, count({c}) c from {source}))" for c in columns)


@query("t1_autotype_continuous", with_ctes(PC) + values_sql(
    PREP, "pc", lambda c: ("true" if c == "flag01" else "false" if c == "zero_infl" else "v > 20" if c in PREP_NUMERIC else "false") + " as is_continuous"))
def t1(spark, d):
    df = prep_cases(spark, d).drop("case_id")
    return P.report_frame(df, P.continuous_columns(df, discrete=["zero_infl"], continuous=["flag01"]), "is_continuous")


@query("t1_autotype_orders", with_ctes(OC) + values_sql(
    OC_COLUMNS, "oc", lambda c: ("v > 20" if c in OC_NUMERIC else "false") + " as is_continuous"))
def t1b(spark, d):
    df = order_cases(spark, d).select(*OC_COLUMNS)
    return P.report_frame(df, P.continuous_columns(df), "is_continuous")


@query("t2_autotype_discrete", with_ctes(PC) + values_sql(
    PREP, "pc", lambda c: ("(1 < v and v <= 150)" + (" and v <= 20" if c in PREP_NUMERIC else "")) + " as is_discrete"))
def t2(spark, d):
    df = prep_cases(spark, d).drop("case_id")
    return P.report_frame(df, P.discrete_columns(df), "is_discrete")


@query("t2_autotype_orders", with_ctes(OC) + values_sql(
    OC_COLUMNS, "oc", lambda c: ("false" if c == "any_return" else "1 < v and v <= 150" if c == "n_lines" else
                                 "(1 < v and v <= 150)" + (" and v <= 20" if c in OC_NUMERIC else "")) + " as is_discrete"))
def t2b(spark, d):
    df = order_cases(spark, d).select(*OC_COLUMNS)
    return P.report_frame(df, P.discrete_columns(df, discrete=["n_lines"], continuous=["any_return"]), "is_discrete")


@query("t3_could_be_int", with_ctes(PC) + " union all ".join(
    f"(select '{c}' as column_name, {'count(*) >= 0' if c == 'flag01' else f'coalesce(bool_and({c} = floor({c})), false)' if c in PREP_NUMERIC else 'count(*) < 0'} as could_be_int from pc)"
    for c in PREP))
def t3(spark, d):
    df = prep_cases(spark, d).drop("case_id")
    return P.report_frame(df, P.could_be_int(df), "could_be_int")


NUMBER = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
RATIO = "(count(distinct {c}) - count(distinct case when regexp_matches({c}, " + NUMBER + ") then {c} end))::double / count(distinct {c})"


@query("t4_coerce_numeric", with_ctes(PC) + " union all ".join(
    f"(select '{c}' as column_name, round({RATIO.format(c=c)}, 6) + 0.0 as ratio, {RATIO.format(c=c)} <= 0.1 as converted from pc)"
    for c in ["c_name", "c_mktsegment", "const_col", "num_text", "cabin"]))
def t4(spark, d):
    df = prep_cases(spark, d)
    _, report = P.coerce_to_numeric(df)
    return spark.createDataFrame([(c, r, v) for c, (r, v) in report.items()], "column_name string, ratio double, converted boolean") \
        .select("column_name", rnd("ratio", 6).alias("ratio"), "converted")


@query("t4_coerced_values", with_ctes(PC) + f"select case_id, case when regexp_matches(num_text, {NUMBER}) then num_text::double end as num_text from pc")
def t4b(spark, d):
    df, _ = P.coerce_to_numeric(prep_cases(spark, d).select("case_id", "num_text"))
    return df


@query("t5_coerce_boolean", with_ctes(PC) + " union all ".join(
    f"(select '{c}' as column_name, count(distinct {c}) = 2 and (sum(case when {c} is null or {t} then 1 else 0 end) = "
    f"count(case when {c} = (select min({c}) from pc) then 1 end) or sum(case when {c} is null or {t} then 1 else 0 end) = "
    f"count(case when {c} = (select max({c}) from pc) then 1 end)) as converted from pc)"
    for c, t in [(c, f"{c} <> 0" if c in PREP_NUMERIC else f"{c} <> ''") for c in PREP]))
def t5(spark, d):
    df = prep_cases(spark, d).drop("case_id")
    _, report = P.coerce_to_boolean(df)
    return P.report_frame(df, report, "converted")


@query("t6_cast_state", with_ctes(OC) + "select case_id, any_return as value, any_return = 1 as flag from oc")
def t6(spark, d):
    text = F.col("any_return").cast("string")
    return order_cases(spark, d).select(
        "case_id", cast_state(text, "int").alias("value"),
        cast_state(F.when(text == "1", "True").when(text == "0", "False"), "boolean").alias("flag"))


def uniform_sql(ident: str, seed) -> str:
    return f"({HASH.format(id=ident, seed=seed)})::double / 4294967296.0"


@query("t7_zero_to_normal", with_ctes(PC) + f"""select case_id, round(case when zero_infl = 0 then
  3.0 * (sqrt(-2.0 * ln(greatest({uniform_sql('case_id', '7a')}, power(2.0, -32)))) * cos(2 * pi() * {uniform_sql('case_id', '7b')}))
  else zero_infl end, 6) + 0.0 as value from pc""")
def t7(spark, d):
    return prep_cases(spark, d).select("case_id", rnd(replace_zero_with_normal(F.col("zero_infl"), F.col("case_id"), 7), 6).alias("value"))


@query("t8_regex_features", with_ctes(PC) + """select case_id, case when m <> '' then substr(m, 1, 1) end as floor,
  case when m <> '' then substr(m, 2)::double end as cabin_number
  from (select case_id, coalesce(regexp_extract(cabin, '[A-Z][0-9]{1,3}'), '') m from pc)""")
def t8(spark, d):
    df = prep_cases(spark, d).select("case_id", first_token_match(F.col("cabin"), "[A-Z][0-9]{1,3}").alias("m"))
    hit = F.col("m") != ""
    return df.select("case_id", F.when(hit, F.substring("m", 1, 1)).alias("floor"),
                     F.when(hit, F.substring("m", 2, 9).cast("double")).alias("cabin_number"))


@query("t9_finite", with_ctes(OC) + """select case_id, case when case_id % 11 in (0, 1) then null else round(ln(o_totalprice), 6) + 0.0 end as value from oc""")
def t9(spark, d):
    v = F.when(F.col("case_id") % 11 == 0, F.lit(math.inf)).when(F.col("case_id") % 11 == 1, F.lit(-math.inf)).otherwise(F.ln("o_totalprice"))
    return order_cases(spark, d).select("case_id", rnd(finite(v), 6).alias("value"))


@query("t10_pack_state", with_ctes(OC) + "select case_id, 'size_band$$' || size_band as packed, case when size_band is not null then 'size_band' end as variable, size_band as state from oc")
def t10(spark, d):
    df = order_cases(spark, d).select("case_id", pack_state(F.lit("size_band"), F.col("size_band")).alias("packed"))
    variable, state = unpack_state(F.col("packed"))
    return df.select("case_id", "packed", variable.alias("variable"), state.alias("state"))


# -- pruning -------------------------------------------------------------------

def kept(name, flags):
    sql = with_ctes(PC) + values_sql(PREP, "pc", lambda c: flags(c) + " as kept")

    def add(fn):
        def run(spark, d):
            df = prep_cases(spark, d).drop("case_id")
            return P.report_frame(df, fn(df), "kept")
        return query(name, sql)(run)
    return add


@kept("f1_static", lambda c: "v > 1")
def f1(df):
    return P.keep_varying(P.profile(df, limit=1))


@kept("f2_unique", lambda c: "v <> n")
def f2(df):
    return P.keep_not_unique(P.profile(df, limit=0, unique=True))


@kept("f3_mostly_empty", lambda c: "c::double / n > 0.1")
def f3(df):
    return P.keep_filled(P.profile(df, limit=0))


@kept("f4_many_states", lambda c: "v < 30" if c not in PREP_NUMERIC else "true")
def f4_(df):
    return P.keep_few_states(P.profile(df, limit=30))


@kept("f5_all_filters", lambda c: "v > 1 and v <> n" + (" and v < 30" if c not in PREP_NUMERIC else ""))
def f5(df):
    return P.apply_filters(P.profile(df, limit=30, unique=True))


F6_COLUMNS = ["o_orderstatus", "o_orderpriority", "size_band", "any_return"]


@query("f6_single_state", with_ctes(PC) + " union all ".join(
    f"(select '{c}' as column_name, count(distinct {c}) > 1 as kept from pc)" for c in ["const_col", "c_mktsegment", "flag01", "num_text"]))
def f6(spark, d):
    cols = ["const_col", "c_mktsegment", "flag01", "num_text"]
    df = prep_cases(spark, d)
    gone = P.single_state_columns(df, cols)
    return P.report_frame(df, {c: c not in gone for c in cols}, "kept")


@query("f7_discrete_only", with_ctes(OC) + values_sql(OC_COLUMNS, "oc", lambda c: ("v <= 20" if c in OC_NUMERIC else "true") + " as kept"))
def f7(spark, d):
    df = order_cases(spark, d).select(*OC_COLUMNS)
    return P.report_frame(df, {c: not v for c, v in P.continuous_columns(df).items()}, "kept")


# -- bins ----------------------------------------------------------------------

@query("d1_states", with_ctes(OC) + """select variable, state, (row_number() over (partition by variable order by num, state) - 1)::int as ord, value_type from (
  select distinct 'size_band' as variable, size_band as state, null::double as num, 'NONE' as value_type from oc where size_band is not null
  union all select distinct 'o_orderpriority', o_orderpriority, null, 'NONE' from oc
  union all select distinct 'any_return', cast(any_return as varchar), any_return::double, 'INTEGER' from oc where any_return is not null
  union all select distinct 'sum_qty', cast(cast(sum_qty as bigint) as varchar), sum_qty, 'INTEGER' from oc where sum_qty is not null)""")
def d1(spark, d):
    return B.discover_states(order_cases(spark, d), ["size_band", "o_orderpriority", "any_return", "sum_qty"])


def bins_sql(parts) -> str:
    """variable, ord, lo, hi, flags, label from (variable, edges list) selects."""
    return f"""bl as (select variable, (i - 1)::int as ord, e[i] as lo, e[i + 1] as hi from (
    select variable, e, unnest(range(1, len(e))) as i from ({' union all '.join(parts)})))"""


LABELLED = f"""select variable, ord, round(lo, 4) + 0.0 as lo, round(hi, 4) + 0.0 as hi, lo_closed, hi_closed,
  (case when lo_closed then '[' else '(' end) || (case when lo = '-infinity' then '-inf' else {f4('lo')} end) || ','
  || (case when hi = 'infinity' then 'inf' else {f4('hi')} end) || (case when hi_closed then ']' else ')' end) as label from """


def edge_list(column: str, inner: str, source: str) -> str:
    return f"select '{column}' as variable, list_concat(['-infinity'::double], list_sort(list_distinct([{inner}])), ['infinity'::double]) e from {source}"


def bins_out(spark, bins):
    return B.bins_frame(spark, bins).select("variable", "ord", rnd("lo", 4).alias("lo"), rnd("hi", 4).alias("hi"), "lo_closed", "hi_closed", "label")


@query("d2_equal_frequency", with_ctes(OC, bins_sql([
    edge_list(c, ", ".join(f"quantile_cont({c}, {k / 4})" for k in (1, 2, 3)), "oc") for c in ("sum_qty", "sum_price")]))
    + LABELLED + "(select *, true as lo_closed, false as hi_closed from bl)")
def d2(spark, d):
    return bins_out(spark, B.equal_frequency(order_cases(spark, d), ["sum_qty", "sum_price"], 4))


@query("d3_equal_width", with_ctes(OC, bins_sql([
    edge_list(c, ", ".join(f"min({c}) + {k} * (max({c}) - min({c})) / 4" for k in (1, 2, 3)), "oc") for c in ("sum_qty", "sum_price")]))
    + LABELLED + "(select *, true as lo_closed, false as hi_closed from bl)")
def d3(spark, d):
    return bins_out(spark, B.equal_width(order_cases(spark, d), ["sum_qty", "sum_price"], 4))


D4_BINS = [B.Interval(-math.inf, 50.0), B.Interval(50.0, 100.0, True, True), B.Interval(100.0, math.inf, False, True)]


@query("d4_defined_bins", with_ctes(OC) + f"""select b.variable, b.ord, b.lo, b.hi, b.lo_closed, b.hi_closed, b.label, count(sum_qty) as n from
  ({LABELLED} (select * from (values ('sum_qty', 0, '-infinity'::double, 50.0::double, true, false), ('sum_qty', 1, 50.0, 100.0, true, true),
   ('sum_qty', 2, 100.0, 'infinity'::double, false, true)) t(variable, ord, lo, hi, lo_closed, hi_closed))) b
  left join oc on (sum_qty > b.lo or (b.lo_closed and sum_qty = b.lo)) and (sum_qty < b.hi or (b.hi_closed and sum_qty = b.hi)) group by all""")
def d4(spark, d):
    counts = B.assign(order_cases(spark, d), "sum_qty", D4_BINS, name="label").groupBy("label").agg(F.count("sum_qty").alias("n"))
    return bins_out(spark, {"sum_qty": D4_BINS}).join(counts, "label", "left").select(
        "variable", "ord", "lo", "hi", "lo_closed", "hi_closed", "label", F.coalesce("n", F.lit(0)).alias("n"))


@query("d5_zero_crossing", with_ctes(PC, quartile_sql("q", "case when zero_infl > 0 then zero_infl end", "pc")) + LABELLED + """(
  select 'zero_infl' as variable, (row_number() over (order by lo) - 1)::int as ord, lo, hi, true as lo_closed, false as hi_closed from (
    select '-infinity'::double as lo, 0.5::double as hi from q where q1 > 0.5
    union all select case when q1 > 0.5 then 0.5 else '-infinity'::double end, q1 from q
    union all select q1, q2 from q union all select q2, q3 from q union all select q3, 'infinity'::double from q))""")
def d5(spark, d):
    positive = prep_cases(spark, d).filter("zero_infl > 0")
    return bins_out(spark, B.equal_frequency(positive, ["zero_infl"], 4, zero_crossing=True))


@query("d6_interval_label", with_ctes(OC, quartile_sql("q", "o_totalprice", "oc")) + f"""select case_id,
  '[' || {f4('least(o_totalprice, q.q2)')} || ',' || {f4('greatest(o_totalprice, q.q2) + 1')} || ')' as label from oc, q""")
def d6(spark, d):
    oc = order_cases(spark, d)
    mid = B.equal_frequency_edges(oc, ["o_totalprice"], 4)["o_totalprice"][2]
    v = F.col("o_totalprice")
    return oc.select("case_id", B.interval_label(F.least(v, F.lit(mid)), F.greatest(v, F.lit(mid)) + 1, F.lit(True), F.lit(False)).alias("label"))


@query("d7_interval_join", with_ctes(DN) + "select case_id, qty_band as state from dn")
def d7(spark, d):
    return dn_cases(spark, d).select("case_id", F.col("qty_band").alias("state"))


@query("d8_zero_indicator", with_ctes(PC) + """select case when zero_infl < 0.5 then '0' else '1' end as indicator, count(*) as n,
  round(avg(zero_infl), 4) + 0.0 as mean, round(greatest(var_pop(zero_infl), 1e-6), 2) + 0.0 as var from pc where zero_infl is not null group by 1""")
def d8(spark, d):
    from posterion.plans.templates import independent, with_zero_indicators
    df = B.with_zero_indicator(prep_cases(spark, d), "zero_infl")
    model = fit(df, with_zero_indicators(independent(continuous=["zero_infl"]), ["zero_infl"]))
    g = model.gauss_frame(spark)
    return g.select(F.get("parents", F.lit(0)).alias("indicator"), F.col("w").cast("bigint").alias("n"),
                    rnd(F.get("mean", F.lit(0)), 4).alias("mean"), rnd(F.greatest(F.get("cov", F.lit(0)), F.lit(1e-6)), 2).alias("var"))


@query("d9_histogram_cdf", with_ctes(OC, """b as (select min(o_totalprice) lo, (max(o_totalprice) - min(o_totalprice)) / 10 w, count(*) n from oc)""",
       """h as (select least(floor((o_totalprice - lo) / w), 9)::int i, count(*) c from oc, b group by 1)""",
       """z as (select i, c, sum(c) over (order by i) - c as before from h)""") + """select case_id,
  round(before::double / n + c::double / n * ((o_totalprice - lo) / w - i), 6) + 0.0 as cdf
  from oc, b, z where i = least(floor((o_totalprice - lo) / w), 9)::int""")
def d9(spark, d):
    return B.histogram_cdf(order_cases(spark, d), "o_totalprice", 10).select("case_id", rnd("cdf", 6).alias("cdf"))


@query("d10_discretised_columns", with_ctes(OC, quartile_sql("a", "sum_qty", "oc"), quartile_sql("b", "price_k", "oc")) +
       f"select case_id, {band_sql('sum_qty', 'a')} as sum_qty, {band_sql('price_k', 'b')} as price_k from oc, a, b")
def d10(spark, d):
    df, _ = B.discretise(order_cases(spark, d), NB1, ["sum_qty", "price_k"])
    return df.select("case_id", "sum_qty", "price_k")
