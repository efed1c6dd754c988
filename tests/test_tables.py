import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from posterion.operators import bins as B
from posterion.operators import profile as P
from posterion.operators import ranking as R
from posterion.sources import cases as C


@pytest.mark.parametrize("limit", [500_000, 5])
def test_exact_quantiles_and_ranks(spark, monkeypatch, limit):
    # a small limit forces the narrowing passes
    monkeypatch.setattr(R, "EXACT_VALUES", limit)
    monkeypatch.setattr(R, "ACCURACY", 50)
    # a third of all rows share one value
    df = spark.range(3000).withColumn("v", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(4))).persist()
    values = sorted(r["v"] for r in df.collect())
    got = R.order_statistics(df, [(F.col("v"), r) for r in (0, 1, 777, 1500, 2999)])
    assert got == [values[r] for r in (0, 1, 777, 1500, 2999)]
    q = R.quantiles(df, {"v": F.col("v")}, [0.0, 0.25, 0.5, 0.9, 1.0])["v"]
    for f, x in zip([0.0, 0.25, 0.5, 0.9, 1.0], q):
        at = f * 2999
        lo, hi = values[math.floor(at)], values[math.ceil(at)]
        assert x == pytest.approx(lo + (hi - lo) * (at - math.floor(at)), abs=1e-12)
    groups = R.near_equal_groups(df, "v", "id", 7, name="g")
    order = sorted((r["v"], r["id"], r["g"]) for r in groups.collect())
    want = [i + 1 for i, n in enumerate(R.group_sizes(3000, 7)) for _ in range(n)]
    assert [g for _, _, g in order] == want


def test_dense_ids_and_hash_ranks(spark):
    df = spark.range(0, 5000, 7)
    got = sorted((r["id"], r["ix"]) for r in R.dense_ids(df, "id").collect())
    assert [ix for _, ix in got] == list(range(1, len(got) + 1))
    ranked = R.hashed_rank(df, "id", 1).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, len(ranked) + 1))


def test_interval_membership(spark):
    bins = B.defined([(-math.inf, 0.0), (0.0, 1.0, True, True), (2.0, 3.0, False, False)])
    df = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 1.0, 1.5, 2.0, 2.5, None, float("nan"))], "v double")
    got = [r["s"] for r in B.assign(df, "v", bins, name="s").collect()]
    a, b, c = [B.label(x) for x in bins]
    assert got == [a, b, b, None, None, c, None, None]
    assert a == "[-inf,0.0000)" and b == "[0.0000,1.0000]"
    crossing = B.zero_crossing(B.from_edges([-math.inf, 2.0, math.inf]))
    assert [(x.lo, x.hi) for x in crossing] == [(-math.inf, 0.5), (0.5, 2.0), (2.0, math.inf)]


def test_long_bin_lists_join_like_short_ones(spark, monkeypatch):
    edges = [float(i) for i in range(0, 101)]
    df = spark.range(1200).select((F.col("id") / 10 - 5).alias("v"))
    short = sorted((r["v"], r["s"]) for r in B.assign(df, "v", B.from_edges(edges), name="s").collect() if r["s"])
    monkeypatch.setattr(B, "DIRECT_BINS", 16)
    long = B.assign(df, "v", B.from_edges(edges), name="s")
    assert long.count() == 1200
    assert sorted((r["v"], r["s"]) for r in long.collect() if r["s"]) == short
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("limit", [3, 128])
def test_overlapping_bins_give_the_first_match_at_any_length(spark, monkeypatch, limit):
    monkeypatch.setattr(B, "DIRECT_BINS", limit)
    bins = B.defined([(0, 5), (3, 8, True, True), (-math.inf, 4), (8, 8, True, True), (7, math.inf, False, False)])
    values = [-1.0, 0.0, 3.0, 4.5, 5.0, 7.5, 8.0, 8.5, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["v"]: r["s"] for r in B.assign(df, "v", bins, name="s").collect()}
    names = [B.label(b) for b in bins]
    want = [names[i] for i in (2, 0, 0, 0, 1, 1, 1, 4)] + [None]
    assert got == dict(zip(values, want)) and B.assign(df, "v", bins, name="s").count() == len(values)


def test_groups_split_ties_by_ids_beyond_double(spark):
    df = spark.range(40).select((F.lit(2 ** 60) + F.col("id") - F.when(F.col("id") % 2 == 0, F.lit(2 ** 61)).otherwise(0)).alias("id"), F.lit(1.0).alias("v"))
    got = sorted((r["id"], r["g"]) for r in R.near_equal_groups(df, "v", "id", 4, name="g").collect())
    assert [g for _, g in got] == [g for g in (1, 2, 3, 4) for _ in range(10)]


def test_parent_keys_part_states_with_bars(spark):
    from posterion.operators import fit as L, tables as W
    from posterion.plans.network import Network, Variable
    net = Network(tuple(Variable(n, "discrete") for n in ("a", "b", "c")), (("a", "c"), ("b", "c")))
    df = spark.createDataFrame([("x|b=y", "z", "1"), ("x", "y|b=z", "0"), ("x", "y|b=z", "0")], "a string, b string, c string")
    model_net, centres = L.discover(df, net)
    cpt = L.cpt_frame(L.statistics(df, model_net, centres))
    assert [r["p"] for r in W.lookup_probability(df, cpt, "c", ["a", "b"]).collect()] == [1.0, 1.0, 1.0]
    model = L.fit(df, net)
    keys = {r["parent_key"] for r in cpt.filter("node = 'c'").collect()}
    assert keys == {r["parent_key"] for r in model.cpt_frame(spark).filter("node = 'c' and p > 0").collect()} and len(keys) == 2


def test_profile_and_coercion(spark):
    df = spark.createDataFrame([(i, str(i) if i else "x", 0.0 if i % 2 else 1.0, float(i), None) for i in range(30)],
                               "id int, t string, b double, c double, e string")
    p = P.profile(df)
    assert p["e"].values == 1 and p["t"].values == 30 and p["b"].distinct == 2
    assert P.continuous_columns(df)["c"] and not P.continuous_columns(df)["b"]
    assert P.discrete_columns(df)["b"] and not P.discrete_columns(df)["e"]
    out, report = P.coerce_to_numeric(df)
    assert report["t"][1] and report["e"] == (None, True) and dict(out.dtypes)["t"] == "double"
    assert P.coerce_to_boolean(df)[1]["b"]
    assert P.could_be_int(df)["c"]
    assert P.single_state_columns(df.withColumn("k", F.lit("k")), ["k", "b", "e"]) == ["k", "e"]


def test_cases(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0)], "id int, w double")
    assert C.bind(df, "id", "w") is df
    with pytest.raises(ValueError):
        C.bind(df.union(df), "id")
    with pytest.raises(ValueError):
        C.bind(df.withColumn("w", F.lit(-1.0)), "id", "w")
    path = str(tmp_path / "t")
    assert C.stage(df, path).count() == 2
    assert C.stage(df, path, mode="append").count() == 4
    assert C.stage(df, path, mode="skip").count() == 4
    assert C.stage(df, path).count() == 2


def test_text_ids_in_near_equal_groups(spark):
    from posterion.operators.ranking import near_equal_groups
    df = spark.createDataFrame([(f"id{i}", float(i % 3)) for i in range(101)], "id string, v double")
    got = near_equal_groups(df, "v", "id", 4, name="g").collect()
    assert sorted(np.bincount([r.g for r in got])[1:]) == [25, 25, 25, 26]
    assert all(a.v <= b.v for a in got for b in got if a.g < b.g)
    assert got == near_equal_groups(df, "v", "id", 4, name="g").collect()


def test_dense_ids_with_a_map_column(spark):
    from posterion.operators.ranking import dense_ids
    df = spark.createDataFrame([(i if i % 4 else None, {"a": i}) for i in range(40)], "id long, m map<string,int>")
    got = dense_ids(df, "id").collect()
    assert sorted(r.ix for r in got) == list(range(1, 41))
    known = [r for r in got if r.id is not None]
    assert [r.ix for r in sorted(known, key=lambda r: r.id)] == list(range(1, 31))
    only = spark.createDataFrame([({"a": 1}, None)] * 3, "m map<string,int>, id long")
    assert sorted(r.ix for r in dense_ids(only, "id").collect()) == [1, 2, 3]
