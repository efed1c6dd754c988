"""Keyed columns against the same network with all states listed."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from posterion.operators import keyed as K
from posterion.operators.fit import fit
from posterion.operators.inference import score_rows
from posterion.operators.score import LogLikelihood, MeanVariance, ModelStatistics, MostLikelyState, StateProbability, score
from posterion.plans.network import Network, Variable

NET = Network((Variable("s"), Variable("big"), Variable("c"), Variable("d"), Variable("x", "continuous"), Variable("y", "continuous")),
              (("s", "big"), ("big", "c"), ("s", "c"), ("c", "d"), ("big", "x"), ("c", "y")))


def cases(spark, n=3000, keys=40, seed=1):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        s = int(r.integers(0, 2))
        big = 0 if r.random() < .35 else int(r.integers(0, keys))        # a third of all rows share one key
        c = int((big + s + r.integers(0, 2)) % 3)
        rows.append((i, f"s{s}", f"k|{big}\\", f"c{c}", f"d{(c + (r.random() < .3)) % 2}", float(big % 7 + r.normal()), float(c + r.normal())))
    return spark.createDataFrame(rows, "id int, s string, big string, c string, d string, x double, y double")


def holes(df):
    return df.withColumns({"s": F.when(F.col("id") % 3 != 0, F.col("s")), "big": F.when(F.col("id") % 4 != 0, F.col("big")),
                           "c": F.when(F.col("id") % 5 != 0, F.col("c")), "x": F.when(F.col("id") % 4 != 0, F.col("x")),
                           "y": F.when(F.col("id") % 7 != 0, F.col("y"))})


QUERIES = [ModelStatistics(), MostLikelyState("c"), StateProbability("s", "s1"), StateProbability("d"), MeanVariance("y"), LogLikelihood(("y",))]


def same(want, got):
    want, got = ({r.id: r.asDict() for r in f.collect()} for f in (want, got))
    assert want.keys() == got.keys()
    for i, w in want.items():
        for c, v in w.items():
            if isinstance(v, float):
                assert got[i][c] == pytest.approx(v, abs=1e-8), (i, c)
            else:
                assert got[i][c] == v, (i, c)


@pytest.mark.parametrize("hot", [0, 8 << 20])
def test_scores_equal_the_listed_network(spark, monkeypatch, hot):
    monkeypatch.setattr(K, "HOT_BYTES", hot)
    df = cases(spark)
    plain, model = fit(df, NET), K.fit_keyed(df, NET, ["big"])
    assert model.keyed == ("big",) and "big" not in model.base.network.names()
    same(score_rows(holes(df), plain, QUERIES, id_col="id", append=False), K.score_keyed(holes(df), model, QUERIES, id_col="id", append=False))


def test_gaps_without_closed_form_are_null_and_unknown_keys_are_gaps(spark):
    df = cases(spark, 600)
    plain, model = fit(df, NET), K.fit_keyed(df, NET, ["big"])
    odd = holes(df).withColumn("big", F.when(F.col("id") % 4 == 1, F.lit("never seen")).otherwise(F.col("big"))).withColumn("x", F.when(F.col("id") % 8 == 0, 1.0).when(F.col("id") % 4 > 1, F.col("x")))
    got = {r.id: r for r in K.score_keyed(odd, model, QUERIES, id_col="id", append=False).collect()}
    want = {r.id: r for r in score_rows(odd, plain, QUERIES, id_col="id", append=False).collect()}
    for i, w in want.items():
        if i % 8 == 0:
            assert got[i].loglikelihood is None and got[i].y_mean is None
        else:
            assert got[i].loglikelihood == pytest.approx(w.loglikelihood, abs=1e-8)


def test_save_and_load_keep_the_tables_apart(spark, tmp_path):
    df = cases(spark, 500)
    model = K.fit_keyed(df, NET, ["big"])
    model.save(spark, str(tmp_path / "m"))
    again = K.KeyedModel.load(spark, str(tmp_path / "m"))
    assert again.network == model.network and again.families == model.families
    same(K.score_keyed(holes(df), model, QUERIES, id_col="id", append=False), K.score_keyed(holes(df), again, QUERIES, id_col="id", append=False))
    plain = fit(df, NET)
    for r in again.family_frame("c").collect():
        assert r.p == pytest.approx(plain.probability("c", (r.big, r.s), r.c), abs=1e-12)
    for r in again.family_frame("x").collect():
        m = plain.moments["x"][(r.big,)]
        assert (r["mean"], r.variance) == pytest.approx((m.mean[0], max(m.cov[0][0], 1e-6)), abs=1e-9)
    assert sum(r.p for r in again.family_frame("big").filter("s = 's0'").collect()) == pytest.approx(1)


def test_more_states_and_parameters_than_the_driver_takes(spark):
    """30,000 keys with two families each: found by their number, and the plan broadcasts no table of all keys."""
    n = 120_000
    df = spark.range(n).select(F.col("id"), (F.col("id") % 30_000).alias("big"), (F.col("id") % 5).cast("string").alias("c"), (F.col("id") % 11).cast("double").alias("x"))
    net = Network((Variable("big"), Variable("c"), Variable("x", "continuous")), (("big", "c"), ("big", "x")))
    model = fit(df, net)
    assert isinstance(model, K.KeyedModel) and model.keyed == ("big",)
    row = score(df, model, id_col="id", append=False).filter("id = 7").first()
    xs = [float(i % 11) for i in range(7, n, 30_000)]
    v = max(float(np.var(xs)), 1e-6)
    assert row.loglikelihood == pytest.approx(math.log(4 / n) - .5 * math.log(2 * math.pi * v) - (7 - np.mean(xs)) ** 2 / (2 * v), abs=1e-8)


def test_what_is_refused(spark):
    df = cases(spark, 50)
    for edges in ((("big", "c"), ("x", "y"), ("big", "x")), (("big", "x"), ("y", "x"))):
        with pytest.raises(ValueError):
            K.fit_keyed(df, Network(NET.variables, edges), ["big"])
    model = K.fit_keyed(df, NET, ["big"])
    for q in (StateProbability("big"), MeanVariance("x"), LogLikelihood(("x",)), ModelStatistics(conflict=True)):
        with pytest.raises(ValueError):
            K.score_keyed(df, model, [q])
    assert K.score_keyed(df.filter("false"), model).count() == 0


def test_factors_of_a_batch_come_from_arrow_lists():
    """Rows without key, with a key of no array, with gaps in the array, without a value: as one table, also from a slice."""
    families = (K.Family("big", "big", ()), K.Family("c", "big", ("c",)), K.Family("x", "big", ("c",), True))
    w = pa.array([9., 1., None, 1., 1., 2.])
    f0, f1 = pa.array([[9.], [-1.], None, None, [-2.], [-3.]]), pa.array([[9., 9.], [-.1, -.2], None, None, [-.3, -.4], [-.5, -.6]])
    m, v = pa.array([[9., 9.], [0., 1.], None, None, [1., None], [2., 3.]]), pa.array([[9., 9.], [1., 1.], None, None, [2., None], [1., 4.]])
    cols = [c.slice(1) for c in (w, f0, f1, m, v)]
    order = {"key:big": 0, "f0": 1, "f1": 2, "m2": 3, "v2": 4}
    extra, lost = K._row_factors(families, {"big": (("c",), [-5., -6.])}, ("big",), {"c": 2}, cols, order, {"x": np.array([1., 2., 3., 4., np.nan])}, 5)
    assert lost.tolist() == [False, True, False, False, False]
    (s0, absent), (s1, own), (s2, listed), (s3, dens) = extra
    assert (s0, s1, s2, s3) == (("c",), (), ("c",), ("c",))
    assert absent.tolist() == [[0, 0], [-5, -6], [0, 0], [0, 0], [0, 0]]
    assert own.tolist() == [-1, 0, -math.inf, -2, -3]
    assert listed.ravel().tolist() == pytest.approx([-.1, -.2, 0, 0, -math.log(2), -math.log(2), -.3, -.4, -.5, -.6])
    normal = lambda x, m, v: -.5 * math.log(2 * math.pi * v) - (x - m) ** 2 / (2 * v)
    assert dens.ravel().tolist() == pytest.approx([normal(1, 0, 1), normal(1, 1, 1), 0, 0, -math.inf, -math.inf, normal(4, 1, 2), -math.inf, 0, 0])
