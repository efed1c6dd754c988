"""Junction-tree inference against enumeration of every hidden combination, on random networks."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from posterion.operators.inference import score_rows
from posterion.operators.junction import Engine, Tree
from posterion.operators.posterior import score_general
from posterion.operators.score import (KLDivergence, LogLikelihood, MeanVariance, ModelStatistics, MostLikelyState, StateProbability,
                                       impute, score)
from posterion.plans.model import Model, Moments
from posterion.plans.network import Network, Variable


def random_model(seed: int, discrete: int, continuous: int, block: bool = False, latent: bool = False, zeros: bool = False) -> Model:
    r = np.random.default_rng(seed)
    ds = [f"d{i}" for i in range(discrete)]
    cs = [f"x{i}" for i in range(continuous)]
    variables = [Variable(n, states=tuple("abc"[:r.integers(2, 4)]), latent=latent and i == 0) for i, n in enumerate(ds)]
    variables += [Variable(n, "continuous") for n in cs]
    edges = [(ds[i], ds[j]) for j in range(discrete) for i in range(j) if r.random() < .5]
    blocks = ((cs[0], cs[1]),) if block else ()
    for j, n in enumerate(cs):
        edges += [(p, n) for p in ds if r.random() < .4 and not (block and j < 2 and (p, n) in edges)]
        edges += [(cs[i], n) for i in range(j) if r.random() < .6 and not (block and j < 2)]
    net = Network(tuple(variables), tuple(edges), blocks)
    tables, moments = {}, {}
    for n in ds:
        tables[n] = {}
        for c in itertools.product(*[net[p].states for p in net.parents(n)]):
            p = r.random(len(net[n].states)) + .05
            if zeros and r.random() < .4:
                p[0] = 0.0
            tables[n][c] = dict(zip(net[n].states, p / p.sum()))
    for g in net.nodes():
        if net[g[0]].kind == "continuous":
            moments[g[0]] = {}
            for c in itertools.product(*[net[p].states for p in net.discrete_parents(g[0])]):
                k = len(net.continuous_parents(g[0])) + len(g)
                a = r.normal(size=(k, k))
                moments[g[0]][c] = Moments(1.0, tuple(2 * r.normal(size=k)), tuple(map(tuple, a @ a.T + .3 * np.eye(k))))
    return Model(net, tables, moments)


def worlds(model, row, gone=()):
    """Per combination of all discrete variables that agrees with the row: states, weight, and the joint Gaussian of
    the continuous variables with the row's values."""
    net = model.network
    names, cs = net.names("discrete"), net.names("continuous")
    for combo in itertools.product(*[net[n].states for n in names]):
        at = dict(zip(names, combo))
        if any(row.get(n) is not None and n not in gone and row[n] != at[n] for n in names):
            continue
        p = math.prod(model.probability(n, tuple(at[q] for q in net.parents(n)), at[n]) for n in names)
        if p == 0:
            continue
        order, mean, cov = model.joint_gaussian(cs, at) if cs else ([], np.zeros(0), np.zeros((0, 0)))
        seen = [i for i, n in enumerate(order) if row.get(n) is not None and n not in gone]
        log = math.log(p)
        if seen:
            part, dev = cov[np.ix_(seen, seen)], np.array([row[order[i]] for i in seen]) - mean[seen]
            log -= .5 * (len(seen) * math.log(2 * math.pi) + np.linalg.slogdet(part)[1] + dev @ np.linalg.solve(part, dev))
            mean = mean + cov[:, seen] @ np.linalg.solve(part, dev)
            cov = cov - cov[:, seen] @ np.linalg.solve(part, cov[seen])
        yield at, log, order, mean, cov


def weights(found):
    top = max((w[1] for w in found), default=0.0)
    return np.array([math.exp(w[1] - top) for w in found]), top


def loglikelihood(model, row, gone=()):
    found = list(worlds(model, row, gone))
    w, top = weights(found)
    return math.log(w.sum()) + top if found else None


def state_shares(model, row, v):
    found = list(worlds(model, row, (v,)))
    w, _ = weights(found)
    return {s: sum(x for x, f in zip(w, found) if f[0][v] == s) / w.sum() for s in model.network[v].states} if found else None


def moments(model, row, heads, gone=None):
    found = list(worlds(model, row, heads if gone is None else gone))
    w, _ = weights(found)
    w = w / w.sum()
    ix = [found[0][2].index(h) for h in heads]
    mean = sum(x * f[3][ix] for x, f in zip(w, found))
    return mean, sum(x * (f[4][np.ix_(ix, ix)] + np.outer(f[3][ix] - mean, f[3][ix] - mean)) for x, f in zip(w, found))


def random_rows(model, seed, n, gap=.4):
    r = np.random.default_rng(seed)
    net = model.network
    return [{v: None if r.random() < gap else (str(r.choice(net[v].states)) if net[v].kind == "discrete" else float(r.normal(scale=2)))
             for v in net.observed()} for _ in range(n)]


def frame(spark, model, rows):
    net = model.network
    names = net.observed()
    schema = "id int" + "".join(f", {n} {'string' if net[n].kind == 'discrete' else 'double'}" for n in names)
    return spark.createDataFrame([(i, *[r[n] for n in names]) for i, r in enumerate(rows)], schema)


def arrays(model, rows):
    net = model.network
    code = lambda v, x: math.nan if x is None else float(net[v].states.index(x)) if net[v].kind == "discrete" else x      # noqa: E731
    return {v: np.array([code(v, r.get(v)) for r in rows], float) for v in net.names()}


CASES = [dict(discrete=5, continuous=0), dict(discrete=4, continuous=3), dict(discrete=3, continuous=4, block=True),
         dict(discrete=4, continuous=2, latent=True), dict(discrete=0, continuous=4), dict(discrete=4, continuous=2, zeros=True)]


@pytest.mark.parametrize("seed,options", [(s, o) for s, o in enumerate(CASES * 3)])
def test_engine_against_enumeration(seed, options):
    model = random_model(seed, **options)
    net, rows = model.network, random_rows(model, seed, 40)
    engine = Engine(model)
    for v in [None, *net.names()]:
        continuous = v is not None and net[v].kind == "continuous"
        scopes = () if v is None else ((v,),)
        keep = frozenset() if v is None or continuous else frozenset([v])
        met = 0
        for pick, a in engine.runs(arrays(model, rows), without={v} if continuous else (), keep=keep, scopes=scopes):
            met += len(pick)
            for j, i in enumerate(pick):
                want = loglikelihood(model, rows[i], (v,) if continuous else ())
                assert (want is None) == (not np.isfinite(a.loglikelihood[j]))
                if want is not None:
                    assert a.loglikelihood[j] == pytest.approx(want, abs=1e-8)
                if continuous and want is not None:
                    mean, cov = moments(model, rows[i], [v])
                    got = a.moments((v,))
                    assert (got[0][j, 0, 0], got[1][j, 0, 0, 0]) == pytest.approx((mean[0], cov[0, 0]), abs=1e-7)
                elif v is not None and not continuous:
                    shares = state_shares(model, rows[i], v)
                    if shares is None:
                        assert np.isnan(a.states(v)[j]).all()
                    else:
                        assert a.states(v)[j] == pytest.approx(list(shares.values()), abs=1e-9)
        assert met == len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_joint_moments_given_a_tail(seed):
    model = random_model(seed + 50, discrete=3, continuous=4)
    rows = random_rows(model, seed, 12, gap=.6)
    heads, tail = ("x0", "x2"), "d1"
    for r in rows:
        r.update({"x0": None, "x2": None, "d1": None})
    states = model.network[tail].states
    for pick, a in Engine(model).runs(arrays(model, rows), scopes=((*heads, tail),)):
        mean, cov = a.moments(heads, (tail,))
        for j, i in enumerate(pick):
            for t, s in enumerate(states):
                m, v = moments(model, {**rows[i], tail: s}, list(heads))
                assert mean[j, t] == pytest.approx(m, abs=1e-8) and cov[j, t] == pytest.approx(v, abs=1e-8)


def test_score_answers_every_query_on_a_mixed_dag(spark):
    model = random_model(4, discrete=4, continuous=3)
    rows = random_rows(model, 9, 60)
    queries = [ModelStatistics(conflict=True), MostLikelyState("d0"), StateProbability("d1"), StateProbability("d2", "a"), MeanVariance("x0"),
               MeanVariance("x1", retract_evidence=False), LogLikelihood(("x0", "x2")), KLDivergence("x0", "x1")]
    df = frame(spark, model, rows)
    scored = score(df, model, queries)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = scored.collect()
    assert len(got) == len(rows) and scored.columns[:len(df.columns)] == df.columns
    prior = {}
    for r in got:
        row = rows[r.id]
        assert r.loglikelihood == pytest.approx(loglikelihood(model, row), abs=1e-8)
        alone = sum(loglikelihood(model, {v: x}) for v, x in row.items() if x is not None)
        assert r.conflict == pytest.approx(alone - r.loglikelihood, abs=1e-7)
        first = state_shares(model, row, "d0")
        assert first[r.d0_maxlikelihood] == pytest.approx(max(first.values()), abs=1e-9)
        for s, p in state_shares(model, row, "d1").items():
            assert r[f"d1$${s}_probability"] == pytest.approx(p, abs=1e-9)
        assert r.d2_probability == pytest.approx(state_shares(model, row, "d2")["a"], abs=1e-9)
        m0, v0 = moments(model, row, ["x0"])
        assert (r.x0_mean, r.x0_variance) == pytest.approx((m0[0], v0[0, 0]), abs=1e-7)
        m1, v1 = moments(model, row, ["x1"])
        assert (r.x1_mean, r.x1_variance) == pytest.approx((m1[0], v1[0, 0]) if row["x1"] is None else (row["x1"], 0.0), abs=1e-7)
        assert r["x0:x2_loglikelihood"] == pytest.approx(loglikelihood(model, row) - loglikelihood(model, row, ("x0", "x2")), abs=1e-7)
        a, b = v0[0, 0], moments(model, row, ["x1"])[1][0, 0]
        assert r.x0_x1 == pytest.approx(.5 * math.log(b / a) + (a + (m0[0] - m1[0]) ** 2) / (2 * b) - .5, abs=1e-6)
    assert prior == {}


def test_expressions_and_trees_agree(spark):
    """Where a network has column expressions, both ways give the same answers, nulls included."""
    net = Network((Variable("k", states=("u", "v"), latent=True), Variable("a", states=("0", "1")), Variable("x", "continuous")), (("k", "a"), ("k", "x")))
    model = Model(net, {"k": {(): {"u": .4, "v": .6}}, "a": {("u",): {"0": 1.0, "1": 0.0}, ("v",): {"0": 1.0, "1": 0.0}}},
                  {"x": {("u",): Moments(1, (0.0,), ((1.0,),)), ("v",): Moments(1, (3.0,), ((2.0,),))}})
    rows = [(0, "0", 1.0), (1, "1", 1.0), (2, None, None), (3, "9", float("nan")), (4, None, -4.0)]
    df = spark.createDataFrame(rows, "id int, a string, x double")
    queries = [ModelStatistics(conflict=True), MostLikelyState("a"), StateProbability("k"), MeanVariance("x"), LogLikelihood(("x",))]
    want = score(df, model, queries).orderBy("id").collect()
    got = score_rows(df, model, queries).orderBy("id").collect()
    for w, g in zip(want, got):
        for c in w.asDict():
            if isinstance(w[c], float) and not math.isnan(w[c]):
                assert g[c] == pytest.approx(w[c], abs=1e-9), c
            elif c not in ("x",):
                assert g[c] == w[c], (c, w, g)


def test_wide_groups_inner_nodes_and_two_latents(spark):
    names = tuple(f"v{i}" for i in range(12))
    r = np.random.default_rng(3)
    a = r.normal(size=(12, 12))
    cov, mean = a @ a.T + np.eye(12), r.normal(size=12)
    model = Model(Network(tuple(Variable(n, "continuous") for n in names), (), (names,)), {}, {"v0": {(): Moments(1, tuple(mean), tuple(map(tuple, cov)))}})
    rows = random_rows(model, 1, 30, gap=.3)
    for g in score(frame(spark, model, rows), model, [MeanVariance("v3"), LogLikelihood(("v1", "v2"))]).collect():
        m, v = moments(model, rows[g.id], ["v3"])
        assert (g.v3_mean, g.v3_variance) == pytest.approx((m[0], v[0, 0]), abs=1e-7)
    two = random_model(11, discrete=4, continuous=1)
    net = two.network
    two = Model(Network(tuple(Variable(v.name, v.kind, v.states, v.name in ("d0", "d1")) for v in net.variables), net.edges), two.tables, two.moments)
    rows = random_rows(two, 2, 20)
    for g in score(frame(spark, two, rows), two, [ModelStatistics(), StateProbability("d0", "a")]).collect():
        assert g.loglikelihood == pytest.approx(loglikelihood(two, rows[g.id]), abs=1e-8)
        assert g.d0_probability == pytest.approx(state_shares(two, rows[g.id], "d0")["a"], abs=1e-9)


def test_impute_on_a_dag_and_names_with_two_underscores(spark):
    model = random_model(21, discrete=4, continuous=2)
    renamed = {"d0": "__d0"}
    nn = lambda n: renamed.get(n, n)      # noqa: E731
    net = model.network
    other = Model(Network(tuple(Variable(nn(v.name), v.kind, v.states) for v in net.variables), tuple((nn(a), nn(b)) for a, b in net.edges)),
                  {}, {})
    # parent order follows names, so tables are rebuilt by name
    for n in net.names("discrete"):
        at = other.network.parents(nn(n))
        other.tables[nn(n)] = {tuple(dict(zip(map(nn, net.parents(n)), k))[p] for p in at): t for k, t in model.tables[n].items()}
    for g in net.nodes():
        if net[g[0]].kind == "continuous":
            at = other.network.discrete_parents(g[0])
            other.moments[g[0]] = {tuple(dict(zip(map(nn, net.discrete_parents(g[0])), k))[p] for p in at): m for k, m in model.moments[g[0]].items()}
    rows = random_rows(model, 5, 30)
    df = frame(spark, model, rows).withColumnRenamed("d0", "__d0")
    for g in score(df, other, [ModelStatistics(conflict=True), StateProbability("__d0")]).collect():
        assert g.loglikelihood == pytest.approx(loglikelihood(model, rows[g.id]), abs=1e-8)
        alone = sum(loglikelihood(model, {v: x}) for v, x in rows[g.id].items() if x is not None)
        assert g.conflict == pytest.approx(alone - g.loglikelihood, abs=1e-7)
    for g in impute(df, other).collect():
        for v, x in rows[g.id].items():
            if x is not None:
                assert g[nn(v)] == x
            elif net[v].kind == "discrete":
                shares = state_shares(model, rows[g.id], v)
                assert shares[g[nn(v)]] == pytest.approx(max(shares.values()), abs=1e-9)
            else:
                assert g[v] == pytest.approx(moments(model, rows[g.id], [v])[0][0], abs=1e-7)


def test_tree_is_a_junction_tree():
    r = np.random.default_rng(2)
    for _ in range(50):
        names = [f"n{i}" for i in range(8)]
        scopes = [tuple(sorted(r.choice(names, r.integers(1, 4), replace=False))) for _ in range(7)]
        tree = Tree(scopes, dict.fromkeys(names, 2))
        assert all(any(set(s) <= set(c) for c in tree.cliques) and set(s) <= set(tree.cliques[tree.home(s)]) for s in scopes)
        for i, p in enumerate(tree.parent):
            assert p is None or (p > i and set(tree.cliques[i][1:]) <= set(tree.cliques[p]))
    long = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(200)]         # a chain keeps buckets of two
    assert Tree(long, {n: 2 for s in long for n in s}).size == 4


def test_many_gaps_do_not_grow_the_work():
    n = 40
    net = Network(tuple(Variable(f"s{i:02d}", states=("0", "1")) for i in range(n)), tuple((f"s{i:02d}", f"s{i + 1:02d}") for i in range(n - 1)))
    tables = {"s00": {(): {"0": .5, "1": .5}}} | {f"s{i:02d}": {("0",): {"0": .9, "1": .1}, ("1",): {"0": .2, "1": .8}} for i in range(1, n)}
    engine = Engine(Model(net, tables, {}))
    data = {v: np.full(1, np.nan) for v in net.names()} | {"s00": np.zeros(1), f"s{n - 1}": np.zeros(1)}
    (_, found), = engine.runs(data)
    power = np.linalg.matrix_power(np.array([[.9, .1], [.2, .8]]), n - 1)[0, 0]
    assert found.loglikelihood[0] == pytest.approx(math.log(.5 * power), abs=1e-9) and found.pattern.tree.size <= 4


def test_empty_tables_and_no_evidence(spark):
    model = random_model(4, discrete=3, continuous=1)
    empty = frame(spark, model, random_rows(model, 1, 1)).filter("false")
    assert score_rows(empty, model, [ModelStatistics(), MeanVariance("x0")]).count() == 0
    ids = spark.range(3)
    got = score_general(ids, model, "d0", id_col="id").collect()
    prior = state_shares(model, {}, "d0")
    assert len(got) == 3 and all(g[f"d0$${s}_probability"] == pytest.approx(p, abs=1e-9) for g in got for s, p in prior.items())
    assert score_rows(ids.withColumn("d0", F.lit("nowhere")), model, [ModelStatistics()]).first().loglikelihood == pytest.approx(0.0, abs=1e-9)


def test_gaussian_posteriors_with_evidence_in_the_group(spark):
    from posterion.operators.posterior import gaussian_posterior, mean_difference, mean_posteriors
    model = random_model(4, discrete=4, continuous=4)
    rows = random_rows(model, 7, 15, gap=.5)
    df = frame(spark, model, rows)
    heads, tail = ["x1", "x3"], ["d1", "d3"]
    met = 0
    for g in gaussian_posterior(df, model, heads, key="id", tail=tail).collect():
        row = {**rows[g.id], "d1": g.d1, "d3": g.d3}
        m, v = moments(model, row, heads)
        assert g.mean == pytest.approx(m, abs=1e-7) and g["cov"] == pytest.approx(v.ravel(), abs=1e-7)
        assert g.distribution == f"P(x1, x3 | d1={g.d1}, d3={g.d3})"
        met += 1
    net = model.network
    assert met == len(rows) * len(net["d1"].states) * len(net["d3"].states)
    # soft evidence weighs the states of a gap
    soft = df.drop("d2").withColumn("d2", F.when(F.col("id") % 2 == 0, F.create_map(F.lit("a"), F.lit(.2), F.lit("b"), F.lit(.7))))
    for g in gaussian_posterior(soft, model, ["x0"], key="id", soft=["d2"]).collect():
        found = [(w, x) for w, x in zip((.2, .7) if g.id % 2 == 0 else (1.0,) * 3, net["d2"].states)]
        parts = [(w * math.exp(loglikelihood(model, {**rows[g.id], "d2": s}, ("x0",))), moments(model, {**rows[g.id], "d2": s}, ["x0"])[0][0]) for w, s in found]
        assert g.mean[0] == pytest.approx(sum(w * m for w, m in parts) / sum(w for w, _ in parts), abs=1e-7)
    base, new = mean_posteriors(df.filter("id = 0"), model, ["x0", "x2"], key="id"), mean_posteriors(df.filter("id = 1"), model, ["x0", "x2"], key="id")
    for g in mean_difference(base, new).collect():
        a, b = (moments(model, rows[i], [g.variable]) for i in (0, 1))
        assert (g.base_mean, g.base_variance, g["mean"], g.variance) == pytest.approx((a[0][0], a[1][0, 0], b[0][0], b[1][0, 0]), abs=1e-7)
        assert g.difference == pytest.approx(b[0][0] - a[0][0], abs=1e-7)


def test_samples_given_evidence_follow_the_posterior(spark):
    from posterion.operators.sampling import sample
    model = random_model(30, discrete=4, continuous=3)
    evidence = {"d2": "a", "x1": 0.7}
    ids = spark.range(40000).withColumnRenamed("id", "case_id")
    s = sample(ids, model, id_col="case_id", seed=3, evidence=evidence)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    got = s.toPandas()
    assert set(got.d2) == {"a"} and set(got.x1) == {0.7} and len(got) == 40000
    found = list(worlds(model, evidence))
    w, _ = weights(found)
    w = w / w.sum()
    share = got.groupby(["d0", "d1", "d3"]).size() / len(got)
    for p, (at, *_) in zip(w, found):
        assert share.get((at["d0"], at["d1"], at["d3"]), 0.0) == pytest.approx(p, abs=.012)
    mean, cov = moments(model, evidence, ["x0", "x2"], gone=())
    assert got[["x0", "x2"]].mean().to_numpy() == pytest.approx(mean, abs=.05)
    assert np.cov(got[["x0", "x2"]].to_numpy().T, bias=True) == pytest.approx(cov, abs=.12)
    again = sample(ids, model, id_col="case_id", seed=3, evidence=evidence)
    assert s.exceptAll(again).count() == 0
    with pytest.raises(ValueError):
        sample(ids, model, id_col="case_id", evidence={"d0": "nowhere"})


def test_samples_given_evidence_in_a_long_chain(spark):
    """Forty hidden columns: tables stay as large as the buckets."""
    from posterion.operators.sampling import sample
    n = 41
    names = [f"s{i:02d}" for i in range(n)]
    net = Network(tuple(Variable(v, states=("0", "1")) for v in names), tuple(zip(names, names[1:])))
    tables = {"s00": {(): {"0": .5, "1": .5}}} | {v: {("0",): {"0": .9, "1": .1}, ("1",): {"0": .2, "1": .8}} for v in names[1:]}
    got = sample(spark.range(4000).withColumnRenamed("id", "case_id"), Model(net, tables, {}), id_col="case_id", evidence={"s40": "1"}).toPandas()
    assert set(got.s40) == {"1"} and (got.s39 == "1").mean() == pytest.approx(.8 * (1 / 3) / (.8 / 3 + .1 * 2 / 3), abs=.03)
