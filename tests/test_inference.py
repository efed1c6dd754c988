"""Every query against full enumeration of small hand-made networks."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from posterion.operators.posterior import (gaussian_posterior, pair_moments, posterior, scenario_frame, score_general,
                                           soft_except, state_posteriors)
from posterion.operators.sampling import sample
from posterion.operators.score import (KLDivergence, LogLikelihood, MeanVariance, ModelStatistics, MostLikelyState,
                                       StateProbability, impute, score)
from posterion.plans.model import Model, Moments
from posterion.plans.network import Network, Variable

B = ("0", "1")


def chain() -> Model:
    net = Network((Variable("A", states=B), Variable("B", states=B), Variable("C", states=B)), (("A", "B"), ("B", "C")))
    return Model(net, {"A": {(): {"0": .3, "1": .7}}, "B": {("0",): {"0": .9, "1": .1}, ("1",): {"0": .25, "1": .75}},
                       "C": {("0",): {"0": .6, "1": .4}, ("1",): {"0": .2, "1": .8}}}, {})


def collider() -> Model:
    net = Network((Variable("A", states=B), Variable("B", states=B), Variable("C", states=B)), (("A", "C"), ("B", "C")))
    return Model(net, {"A": {(): {"0": .2, "1": .8}}, "B": {(): {"0": .55, "1": .45}},
                       "C": {("0", "0"): {"0": .9, "1": .1}, ("0", "1"): {"0": .4, "1": .6},
                             ("1", "0"): {"0": .3, "1": .7}, ("1", "1"): {"0": .05, "1": .95}}}, {})


def latent() -> Model:
    net = Network((Variable("K", states=("k0", "k1"), latent=True), Variable("a", states=B), Variable("b", states=B),
                   Variable("x", "continuous")), (("K", "a"), ("K", "b"), ("K", "x")))
    return Model(net, {"K": {(): {"k0": .4, "k1": .6}}, "a": {("k0",): {"0": .8, "1": .2}, ("k1",): {"0": .3, "1": .7}},
                       "b": {("k0",): {"0": .5, "1": .5}, ("k1",): {"0": .1, "1": .9}}},
                 {"x": {("k0",): Moments(1, (0.0,), ((1.0,),)), ("k1",): Moments(1, (3.0,), ((2.0,),))}})


def joint(model):
    """All discrete assignments with their probability."""
    net = model.network
    names = net.names("discrete")
    for combo in itertools.product(*[net[n].states for n in names]):
        at = dict(zip(names, combo))
        yield at, math.prod(model.probability(n, tuple(at[p] for p in net.parents(n)), at[n]) for n in names)


def brute(model, head, evidence, weight=lambda at: 1.0):
    table: dict = {}
    for at, p in joint(model):
        if all(at[k] == v for k, v in evidence.items() if v is not None):
            key = tuple(at[h] for h in head)
            table[key] = table.get(key, 0.0) + p * weight(at)
    total = sum(table.values())
    return {k: v / total for k, v in table.items()}, total


@pytest.mark.parametrize("make", [chain, collider])
def test_posteriors_match_enumeration(spark, make):
    model = make()
    cases = [dict(zip("ABC", c)) for c in itertools.product(["0", "1", None], repeat=3)]
    frame = scenario_frame(spark, model, cases)
    for head in (["A"], ["B", "C"], ["C", "A"]):
        got: dict = {}
        for r in posterior(frame, model, head, key="scenario_id").collect():
            got.setdefault(r["scenario_id"], {})[tuple(r[h] for h in head)] = (r["probability"], r["ln_evidence"])
        for i, e in enumerate(cases):
            kept = {k: v for k, v in e.items() if k not in head}
            want, total = brute(model, head, kept)
            for key, p in want.items():
                assert got[i][key][0] == pytest.approx(p, abs=1e-12)
                assert got[i][key][1] == pytest.approx(math.log(total), abs=1e-9)


@pytest.mark.parametrize("make", [chain, collider])
def test_general_scoring_with_any_missing_values(spark, make):
    model = make()
    cases = [dict(zip("ABC", c)) for c in itertools.product(["0", "1", None], repeat=3)]
    frame = scenario_frame(spark, model, cases)
    for target in "ABC":
        rows = {r["scenario_id"]: r for r in score_general(frame, model, target, id_col="scenario_id").collect()}
        assert len(rows) == len(cases)
        for i, e in enumerate(cases):
            want, total = brute(model, [target], {k: v for k, v in e.items() if k != target})
            assert rows[i][f"{target}$$1_probability"] == pytest.approx(want[("1",)], abs=1e-12)
            assert rows[i]["loglikelihood"] == pytest.approx(math.log(total), abs=1e-9)


def test_soft_evidence(spark):
    model = collider()
    frame = scenario_frame(spark, model, [{"B": "1"}]).withColumn(
        "C", F.create_map(F.lit("0"), F.lit(0.2), F.lit("1"), F.lit(0.7)))
    got = {r["A"]: r["probability"] for r in posterior(frame, model, ["A"], key="scenario_id", soft=["C"]).collect()}
    want, _ = brute(model, ["A"], {"B": "1"}, lambda at: {"0": 0.2, "1": 0.7}[at["C"]])
    assert got["1"] == pytest.approx(want[("1",)], abs=1e-12)
    assert soft_except(model, "C", "1") == {"0": 1.0}


def test_state_posteriors_list_every_state(spark):
    model = chain()
    frame = scenario_frame(spark, model, [{"B": "1"}, {}])
    rows = state_posteriors(frame, model, ["A", "C"], key="scenario_id").collect()
    assert len(rows) == 8
    for i, e in enumerate([{"B": "1"}, {}]):
        for v in ("A", "C"):
            want, _ = brute(model, [v], e)
            for r in rows:
                if r["scenario_id"] == i and r["variable"] == v:
                    assert r["probability"] == pytest.approx(want[(r["state"],)], abs=1e-12)


def normal(x, m, v):
    return math.exp(-(x - m) ** 2 / (2 * v)) / math.sqrt(2 * math.pi * v)


def mixture_weights(model, row, skip=()):
    out = []
    for k in ("k0", "k1"):
        p = model.probability("K", (), k)
        for n in ("a", "b"):
            if row[n] is not None and n not in skip:
                p *= model.probability(n, (k,), row[n])
        if row["x"] is not None and "x" not in skip:
            m = model.moments["x"][(k,)]
            p *= normal(row["x"], m.mean[0], m.cov[0][0])
        out.append(p)
    return np.array(out)


def test_mixture_queries(spark):
    model = latent()
    rows = [(i, a, b, x) for i, (a, b, x) in enumerate(itertools.product(["0", "1", None, "new"], ["0", "1", None], [-1.0, 2.5, None, float("nan")]))]
    df = spark.createDataFrame(rows, "id int, a string, b string, x double")
    s = score(df, model, [ModelStatistics(conflict=True), MostLikelyState("a"), StateProbability("K"), StateProbability("b", "1"),
                          MeanVariance("x"), LogLikelihood(("x",))])
    for r in s.collect():
        row = {"a": r["a"] if r["a"] in B else None, "b": r["b"], "x": None if r["x"] is None or math.isnan(r["x"]) else r["x"]}
        w = mixture_weights(model, row)
        assert r["loglikelihood"] == pytest.approx(math.log(w.sum()), abs=1e-9)
        assert r["K$$k1_probability"] == pytest.approx(w[1] / w.sum(), abs=1e-12)
        wa = mixture_weights(model, row, skip=("a",))
        pa = sum(wa[i] / wa.sum() * model.probability("a", (k,), "1") for i, k in enumerate(("k0", "k1")))
        assert r["a_maxlikelihood"] == ("1" if pa > 0.5 else "0")
        wb = mixture_weights(model, row, skip=("b",))
        pb = sum(wb[i] / wb.sum() * model.probability("b", (k,), "1") for i, k in enumerate(("k0", "k1")))
        assert r["b_probability"] == pytest.approx(pb, abs=1e-12)
        wx = mixture_weights(model, row, skip=("x",)) / mixture_weights(model, row, skip=("x",)).sum()
        mean = wx @ [0.0, 3.0]
        assert r["x_mean"] == pytest.approx(mean, abs=1e-9)
        assert r["x_variance"] == pytest.approx(wx @ [1.0, 2.0 + 9.0] - mean ** 2, abs=1e-9)
        assert r["x_loglikelihood"] == pytest.approx(math.log(w.sum()) - math.log(mixture_weights(model, row, skip=("x",)).sum()), abs=1e-9)
        alone = 0.0
        for n in ("a", "b", "x"):
            if row[n] is not None:
                alone += math.log(mixture_weights(model, {m: row[m] if m == n else None for m in row}).sum())
        assert r["conflict"] == pytest.approx(alone - math.log(w.sum()), abs=1e-9)


def test_bad_queries_are_refused(spark):
    df = spark.createDataFrame([(0, "0", "1", 1.0)], "id int, a string, b string, x double")
    for q in (MostLikelyState("x"), StateProbability("a", "7"), MeanVariance("a"), LogLikelihood(()), LogLikelihood(("x", "x")),
              LogLikelihood(("a",)), KLDivergence("a", "x")):
        with pytest.raises(ValueError):
            score(df, latent(), [q])
    with pytest.raises(ValueError):
        score(df.select("id"), latent())
    with pytest.raises(ValueError):
        scenario_frame(spark, chain(), [{"A": "7"}])
    with pytest.raises(ValueError):
        scenario_frame(spark, chain(), [{"Z": "1"}])


def test_filter_on_an_answer_is_not_copied_into_the_scores(spark):
    df = spark.createDataFrame([(i, "0", "1", float(i)) for i in range(5)], "id int, a string, b string, x double")
    s = score(df, latent(), [MostLikelyState("a"), StateProbability("K")]).filter("a_maxlikelihood = '1'")
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")
    assert "Python" not in plan and "Exchange" not in s._jdf.queryExecution().executedPlan().toString()


def test_linked_gaussians(spark):
    # x -> y under a class, and a two-column block
    net = Network((Variable("c", states=B), Variable("x", "continuous"), Variable("y", "continuous")),
                  (("c", "x"), ("c", "y"), ("x", "y")))
    rng = np.random.default_rng(1)
    moments, joints = {"x": {}, "y": {}}, {}
    for i, c in enumerate(B):
        b, a, vx, s2, mx = 1.5 - i, 0.3 + i, 1.0 + i, 0.5, 2.0 * i
        cov = np.array([[vx, b * vx], [b * vx, b * b * vx + s2]])
        mean = np.array([mx, a + b * mx])
        joints[c] = (mean, cov)
        moments["x"][(c,)] = Moments(1, (mx,), ((vx,),))
        moments["y"][(c,)] = Moments(1, tuple(mean), tuple(map(tuple, cov)))
    model = Model(net, {"c": {(): {"0": .35, "1": .65}}}, moments)
    rows = [(i, c, x, y) for i, (c, x, y) in enumerate(itertools.product(["0", "1", None], [0.5, None], [1.2, None]))]
    df = spark.createDataFrame(rows, "id int, c string, x double, y double")
    for r in score(df, model, [ModelStatistics(), StateProbability("c", "1"), MeanVariance("x"), MeanVariance("y")]).collect():
        w = {}
        for c in B:
            mean, cov = joints[c]
            ix = [i for i, n in enumerate(("x", "y")) if r[n] is not None]
            d = np.array([r[n] for n in ("x", "y") if r[n] is not None]) - mean[ix]
            dens = 1.0 if not ix else math.exp(-0.5 * d @ np.linalg.inv(cov[np.ix_(ix, ix)]) @ d) / math.sqrt(
                (2 * math.pi) ** len(ix) * np.linalg.det(cov[np.ix_(ix, ix)]))
            w[c] = model.probability("c", (), c) * dens
        seen = [w[c] for c in B if r["c"] in (None, c)]
        assert r["loglikelihood"] == pytest.approx(math.log(sum(seen)), abs=1e-9)
        assert r["c_probability"] == pytest.approx(w["1"] / sum(w.values()), abs=1e-9)
        if r["c"] is not None and r["y"] is not None:
            mean, cov = joints[r["c"]]
            assert r["x_mean"] == pytest.approx(mean[0] + cov[0, 1] / cov[1, 1] * (r["y"] - mean[1]), abs=1e-9)
            assert r["x_variance"] == pytest.approx(cov[0, 0] - cov[0, 1] ** 2 / cov[1, 1], abs=1e-9)
    frame = scenario_frame(spark, model, [{}])
    p = pair_moments(gaussian_posterior(frame, model, ["x", "y"], key="scenario_id", tail=["c"]), ["x", "y"], "x", "y").collect()
    for r in p:
        mean, cov = joints[r["c"]]
        assert (r["mean_a"], r["mean_b"], r["cov_ab"]) == pytest.approx((mean[0], mean[1], cov[0, 1]), abs=1e-9)
    with pytest.raises(ValueError):
        gaussian_posterior(frame, model, ["x"], key="scenario_id", tail=["y"])


def test_wide_gaussian_block_uses_null_patterns(spark):
    names = tuple(f"v{i}" for i in range(5))
    rng = np.random.default_rng(3)
    a = rng.normal(size=(5, 5))
    cov, mean = a @ a.T + np.eye(5), rng.normal(size=5)
    net = Network(tuple(Variable(n, "continuous") for n in names), (), (names,))
    model = Model(net, {}, {"v0": {(): Moments(1, tuple(mean), tuple(map(tuple, cov)))}})
    data = rng.normal(size=(40, 5))
    data[rng.random(size=data.shape) < 0.3] = np.nan
    df = spark.createDataFrame([(i, *[None if math.isnan(v) else float(v) for v in r]) for i, r in enumerate(data)],
                               "id int, " + ", ".join(f"{n} double" for n in names))
    for r in score(df, model).collect():
        ix = [i for i in range(5) if r[names[i]] is not None]
        want = 0.0
        if ix:
            d = np.array([r[names[i]] for i in ix]) - mean[ix]
            part = cov[np.ix_(ix, ix)]
            want = -0.5 * (len(ix) * math.log(2 * math.pi) + np.linalg.slogdet(part)[1] + d @ np.linalg.inv(part) @ d)
        assert r["loglikelihood"] == pytest.approx(want, abs=1e-8)


def test_wide_model_scores_match_expressions(spark, monkeypatch):
    import posterion.operators.score as S
    model = latent()
    df = spark.createDataFrame([(0, "0", "1", 0.2), (1, None, "0", None), (2, "1", None, 4.0)], "id int, a string, b string, x double")
    q = [ModelStatistics(), StateProbability("K"), MostLikelyState("a"), MeanVariance("x")]
    want = [tuple(r) for r in score(df, model, q).orderBy("id").collect()]
    monkeypatch.setattr(S, "MAX_TERMS", 0)
    got = [tuple(r) for r in score(df, model, q).orderBy("id").collect()]
    for g, w in zip(got, want):
        assert [x for x in g if isinstance(x, str)] == [x for x in w if isinstance(x, str)]
        assert [x for x in g if isinstance(x, float)] == pytest.approx([x for x in w if isinstance(x, float)], abs=1e-9)


def test_zero_probability_evidence_gives_null(spark):
    model = chain()
    model.tables["B"][("0",)] = {"0": 1.0, "1": 0.0}
    df = spark.createDataFrame([(0, "0", "1", "1"), (1, "1", "1", "0")], "id int, A string, B string, C string")
    got = {r["id"]: r["loglikelihood"] for r in score(df, model).collect()}
    assert got[0] is None and got[1] == pytest.approx(math.log(.7 * .75 * .2), abs=1e-9)


def test_impute_keeps_present_values(spark):
    df = spark.createDataFrame([(0, None, "1", None), (1, "0", None, 5.0)], "id int, a string, b string, x double")
    r = {row["id"]: row for row in impute(df, latent()).collect()}
    assert r[0]["b"] == "1" and r[1]["a"] == "0" and r[1]["x"] == 5.0
    assert None not in (r[0]["a"], r[0]["x"], r[1]["b"])


@pytest.mark.parametrize("evidence", [{}, {"C": "1"}])
def test_samples_follow_the_model(spark, evidence):
    model = collider()
    ids = spark.range(20000).withColumnRenamed("id", "case_id")
    s = sample(ids, model, id_col="case_id", seed=5, evidence=evidence)
    assert s.count() == 20000
    n = {(r["A"], r["B"], r["C"]): r["count"] / 20000 for r in s.groupBy("A", "B", "C").count().collect()}
    want, _ = brute(model, ["A", "B", "C"], evidence)
    for key, p in want.items():
        assert n.get(key, 0.0) == pytest.approx(p, abs=0.012)
    again = sample(ids, model, id_col="case_id", seed=5, evidence=evidence)
    assert s.exceptAll(again).count() == 0


def test_large_hidden_grid_is_summed_out(spark, monkeypatch):
    import posterion.operators.posterior as P
    monkeypatch.setattr(P, "GRID_LIMIT", 2)
    model = chain()
    frame = scenario_frame(spark, model, [{}, {"C": "1"}])
    got = {(r["scenario_id"], r["A"]): r["probability"] for r in posterior(frame, model, ["A"], key="scenario_id").collect()}
    for i, e in enumerate([{}, {"C": "1"}]):
        want, _ = brute(model, ["A"], e)
        assert got[i, "1"] == pytest.approx(want[("1",)], abs=1e-12)
