import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from posterion.operators import validate as V
from posterion.operators.fit import cpt_frame, discover, fit, moment_frame, statistics
from posterion.operators.mixture import Run, fit_incomplete, fit_mixture, run_batch, starting_model
from posterion.operators.sampling import sample
from posterion.operators.score import ModelStatistics, score
from posterion.operators.selection import back_first, forward_first, leave_some_out, pick_regressors, subsets
from posterion.operators.structure import (chi_square_p, fisher_z_p, learn_greedy, learn_pc, learn_tan, mutual_information, orient)
from posterion.plans.model import Model, Moments
from posterion.plans.network import Network, Variable
from posterion.plans.templates import independent, mixture, naive_bayes, with_edges, with_latent_node, with_multivariate_nodes
from tests.test_inference import chain, collider, latent


def drawn(spark, model, n=4000, seed=3):
    return sample(spark.range(n).withColumnRenamed("id", "case_id"), model, id_col="case_id", seed=seed)


def test_fit_recovers_a_network(spark):
    df = drawn(spark, collider(), 20000)
    model = fit(df, with_edges(independent(discrete=["A", "B", "C"]), [("A", "C"), ("B", "C")]))
    for n, rows in collider().tables.items():
        for key, row in rows.items():
            assert model.tables[n][key]["1"] == pytest.approx(row["1"], abs=0.03)
    assert model.is_trained()


def test_weights_alpha_and_unseen_combinations(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), ("b", "x", 0.0), (None, "x", 2.0), ("b", None, 5.0)], "p string, c string, w double")
    net = with_edges(independent(discrete=["p", "c"]), [("p", "c")]).with_states({"p": ("a", "b"), "c": ("x", "y")})
    m = fit(df, net, weight="w")
    assert m.tables["c"][("a",)] == {"x": 0.25, "y": 0.75}
    assert ("b",) not in m.tables["c"] and m.probability("c", ("b",), "x") == 0.5
    assert m.missing_families() == [("c", "p=b")]
    smooth = fit(df, net, weight="w", alpha=1.0)
    assert smooth.tables["c"][("a",)]["x"] == pytest.approx(2 / 6)


def test_moments_against_numpy(spark):
    rng = np.random.default_rng(0)
    g = rng.integers(0, 3, 500)
    x = rng.normal(size=500) * 2 + 1e6 + g
    y = 3 * x + rng.normal(size=500)
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(g, x, y)], "g int, x double, y double")
    m = fit(df, with_edges(independent(discrete=["g"], continuous=["x", "y"]), [("g", "x"), ("g", "y"), ("x", "y")]))
    for k in range(3):
        sel = g == k
        a, b, s, w = m.conditional("y", (str(k),))
        slope, icept = np.polyfit(x[sel] - 1e6, y[sel], 1)
        assert b[0, 0] == pytest.approx(slope, rel=1e-4) and w == sel.sum()
        assert m.moments["x"][(str(k),)].cov[0][0] == pytest.approx(np.var(x[sel]), rel=1e-6)


def test_wide_statistics_equal_the_single_aggregate(spark, monkeypatch):
    import posterion.operators.fit as fitting
    model = latent()
    df = drawn(spark, model, 500).withColumn("y", F.col("x") * 2)
    net = with_edges(independent(discrete=["a", "b"], continuous=["x", "y"]), [("a", "x"), ("a", "b"), ("b", "y"), ("x", "y")])
    one = fit(df, net)
    monkeypatch.setattr(fitting, "MOMENT_WORK", 0)
    monkeypatch.setattr(fitting, "MOMENT_SUMS", 4)
    monkeypatch.setattr(fitting, "FOLD_CELLS", 0)
    many = fit(df, net)
    for n in ("a", "b"):
        for key, row in one.tables[n].items():
            assert many.tables[n][key] == pytest.approx(row)
    for n in ("x", "y"):
        for key, mo in one.moments[n].items():
            assert many.moments[n][key].mean == pytest.approx(mo.mean) and np.allclose(many.moments[n][key].cov, mo.cov)


def test_save_and_load_is_exact(spark, tmp_path):
    m = fit(drawn(spark, latent(), 300), naive_bayes("a", discrete=["b"], continuous=["x"]))
    m.save(spark, str(tmp_path / "m"))
    n = Model.load(spark, str(tmp_path / "m"))
    assert n.network == m.network and n.tables == m.tables and n.moments == m.moments


def test_em_never_lowers_the_loglikelihood_and_paths_agree(spark, monkeypatch):
    import posterion.operators.mixture as X
    df = drawn(spark, latent(), 3000)
    net = mixture(discrete=["a", "b"], continuous=["x"], latent_states=2)
    history = [fit_mixture(df, net, iterations=i, tolerance=0.0, start="x").loglikelihood for i in (1, 2, 4, 8)]
    assert all(b >= a - 1e-6 for a, b in zip(history, history[1:]))
    arrow = fit_mixture(df, net, iterations=3, tolerance=0.0, start="x")
    monkeypatch.setattr(X, "SMALL_ROWS", 0)
    native = fit_mixture(df, net, iterations=3, tolerance=0.0, start="x")
    assert native.loglikelihood == pytest.approx(arrow.loglikelihood, rel=1e-9)
    for k in ("Cluster0", "Cluster1"):
        assert native.tables["a"][(k,)] == pytest.approx(arrow.tables["a"][(k,)], abs=1e-9)
    scored = score(df, arrow, [ModelStatistics()]).agg(F.sum("loglikelihood")).head()[0]
    assert arrow.loglikelihood == pytest.approx(scored, rel=1e-9)
    monkeypatch.setattr(X, "is_star", lambda network: False)      # the path of any other network
    general = fit_mixture(df, net, iterations=3, tolerance=0.0, start="x")
    assert general.loglikelihood == pytest.approx(arrow.loglikelihood, rel=1e-9) and general.iterations == 3


def test_em_general_network_with_latent_parent(spark):
    base = with_edges(independent(discrete=["a", "b"], continuous=["x"]), [("a", "b")])
    df = drawn(spark, latent(), 2000)
    lls = [fit_mixture(df, with_latent_node(base, 2), iterations=i, tolerance=0.0, start="x").loglikelihood for i in (2, 4)]
    assert lls[1] >= lls[0]


def test_em_stops_and_handles_ties_and_missing(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else float(i % 2), "s" if i % 3 else None) for i in range(60)], "id int, x double, d string")
    m = fit_mixture(df, mixture(discrete=["d"], continuous=["x"], latent_states=4), iterations=50)
    assert m.converged and m.iterations < 50
    assert sum(m.tables["Cluster"][()].values()) == pytest.approx(1.0)


def test_missing_inner_nodes_recover(spark):
    df = drawn(spark, chain(), 8000).withColumn("B", F.when(F.col("case_id") % 3 > 0, F.col("B")))
    net = with_edges(independent(discrete=["A", "B", "C"]), [("A", "B"), ("B", "C")])
    m = fit_incomplete(df, net, iterations=15)
    for n, rows in chain().tables.items():
        for key, row in rows.items():
            assert m.tables[n][key]["1"] == pytest.approx(row["1"], abs=0.05)


def test_folds(spark):
    df = spark.range(1003).withColumn("c", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    exact = V.exact_folds(df, "id", 4, 1)
    assert sorted(r["count"] for r in exact.groupBy("__fold").count().collect()) == [250, 251, 251, 251]
    strat = V.exact_folds(df, "id", 4, 1, stratify="c").groupBy("c", "__fold").count().collect()
    assert {r["count"] for r in strat if r["c"] == "a"} <= {83, 84} and len(strat) == 8
    rough = V.hash_folds(df, "id", 4, 1)
    for f in range(4):
        train, test = V.split(rough, f)
        assert train.join(test, "id").count() == 0 and train.count() + test.count() == 1003
    with pytest.raises(ValueError):
        V.hash_folds(df, "id", 1)


def test_fold_models_equal_separate_fits(spark):
    df = V.hash_folds(drawn(spark, latent(), 900), "case_id", 3, 2)
    net = naive_bayes("a", discrete=["b"], continuous=["x"])
    whole = V.fit_folds(df, net, 3)
    scored = score(df, whole, [ModelStatistics()]).withColumn("ll", F.col("loglikelihood") + math.log(3))
    for f in range(3):
        train, test = V.split(df, f)
        alone = score(test, fit(train, net), [ModelStatistics()]).agg(F.sum("loglikelihood")).head()[0]
        assert scored.filter(F.col("__fold") == f).agg(F.sum("ll")).head()[0] == pytest.approx(alone, rel=1e-9)


def test_batched_em_equals_single_runs(spark):
    df = V.hash_folds(drawn(spark, latent(), 900), "case_id", 3, 2).persist()
    net = mixture(discrete=["a"], continuous=["x"], latent_states=2)
    net, first, centres = starting_model(df, net, start="x")
    runs = run_batch(df, [Run(first, fold=f) for f in range(3)], centres, iterations=3, tolerance=0.0, fold="__fold")
    for f in range(3):
        alone = run_batch(df.filter(F.col("__fold") != f), [Run(first)], centres, iterations=3, tolerance=0.0)[0]
        assert runs[f].last == pytest.approx(alone.last, rel=1e-9)


def test_structure(spark):
    df = drawn(spark, collider(), 6000)
    assert set(learn_pc(df, discrete=["A", "B", "C"], alpha=0.01)) == {("A", "C"), ("B", "C")}
    df2 = drawn(spark, chain(), 6000)
    assert {frozenset(e) for e in learn_pc(df2, discrete=["A", "B", "C"], alpha=0.01)} == {frozenset("AB"), frozenset("BC")}
    assert {frozenset(e) for e in learn_tan(df2.withColumn("K", F.lit("k")), "K", ["A", "B", "C"]) if "K" not in e} == {
        frozenset("AB"), frozenset("BC")}
    greedy = learn_greedy(V.hash_folds(df2, "case_id", 3, 1), ["A", "B", "C"], fold="__fold", k=3)
    assert {frozenset("AB"), frozenset("BC")} <= {frozenset(e) for e in greedy}
    assert chi_square_p(3.841, 1) == pytest.approx(0.05, abs=0.01) and fisher_z_p(0.0, 100, 0) == pytest.approx(1.0)
    assert set(orient(["a", "b", "c"], {frozenset("ac"), frozenset("bc")}, {frozenset("ab"): ()})) == {("a", "c"), ("b", "c")}


def test_held_out_family_scores_match_enumeration(spark):
    from collections import Counter
    import posterion.operators.structure as S
    folded = V.hash_folds(drawn(spark, chain(), 900), "case_id", 3, 1)
    rows = [(r["A"], r["B"], r["__fold"]) for r in folded.collect()]
    cells, states = S._cells(folded, ["A", "B"], extra=("__fold",))
    got = S._family_scores(cells, [("B", ()), ("B", ("A",))], states, "__fold", 3, 1.0)
    for parents in ((), ("A",)):
        want = 0.0
        for k in range(3):
            train = Counter((a if parents else "", b) for a, b, f in rows if f != k)
            total = Counter(a if parents else "" for a, b, f in rows if f != k)
            want += sum(math.log((train[a if parents else "", b] + 1) / (total[a if parents else ""] + 2)) for a, b, f in rows if f == k)
        assert got["B", parents] == pytest.approx(want, rel=1e-9)


def test_mutual_information_with_missing_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y"), (None, "x"), ("b", None), ("b", "y")], "p string, q string")
    r = mutual_information(df, ["p", "q"]).head()
    n = np.array([[1, 1], [0, 2]]) / 4
    want = sum(v * math.log(v / (n[i].sum() * n[:, j].sum())) for i in range(2) for j, v in enumerate(n[i]) if v)
    assert r["mi"] == pytest.approx(want) and r["g2"] == pytest.approx(8 * want) and r["df"] == 1


def test_selectors_and_regression(spark):
    assert subsets("abc", 2) == [("a", "b"), ("a", "c"), ("b", "c")]
    assert leave_some_out(["a", "b", "c"], 2) == [("c",), ("a",), ("b",)]
    assert forward_first(["a", "b"]) == [("a",), ("a", "b")] and back_first(["a", "b"]) == [("b",), ("a", "b")]
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 2))
    y = 2 * x[:, 0] + rng.normal(size=600) * 0.1
    df = V.hash_folds(spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                                            "id int, a double, b double, y double"), "id", 3, 0)
    got = {r["subset"]: r["score"] for r in pick_regressors(df, "y", [("a",), ("b",)]).groupBy("subset").agg(F.avg("score").alias("score")).collect()}
    assert got["a"] > 0.99 and got["b"] < 0.1


def test_two_missing_columns_match_plain_em(spark):
    """Gaps in different columns are different cells: the weights equal those of EM by hand."""
    rows = [(str(a), str(b)) for a, b, n in ((1, 1, 6), (1, 2, 3), (2, 1, 2), (2, 2, 9)) for _ in range(n)]
    rows += [(None, "1")] * 5 + [("2", None)] * 4 + [(None, "2")] * 3
    df = spark.createDataFrame(rows, "a string, b string")
    model = fit_incomplete(df, with_edges(independent(discrete=["a", "b"]), [("a", "b")]), iterations=60, tolerance=0.0)
    joint = {(a, b): 0.25 for a in "12" for b in "12"}
    for _ in range(400):
        seen = dict.fromkeys(joint, 0.0)
        for a, b in rows:
            fits = {k: p for k, p in joint.items() if a in (None, k[0]) and b in (None, k[1])}
            for k, p in fits.items():
                seen[k] += p / sum(fits.values())
        joint = {k: n / len(rows) for k, n in seen.items()}
    first = joint["1", "1"] + joint["1", "2"]
    assert model.dense("a")[0][0] == pytest.approx(first, abs=1e-4)
    assert model.dense("b")[0][0] == pytest.approx(joint["1", "1"] / first, abs=1e-4)


def test_dense_ids_number_rows_without_a_value(spark):
    from posterion.operators.ranking import dense_ids
    df = spark.createDataFrame([(i if i % 3 else None, i) for i in range(30)], "v int, k int")
    got = sorted((r.ix, r.v) for r in dense_ids(df, "v").collect())
    assert [i for i, _ in got] == list(range(1, 31)) and [v for _, v in got[:20]] == [i for i in range(30) if i % 3] and got[20][1] is None


def test_information_equals_enumeration(spark):
    rng = np.random.default_rng(5)
    rows = [(None if rng.random() < 0.1 else f"x{rng.integers(4)}", f"y{rng.integers(3)}", None if rng.random() < 0.1 else f"z{rng.integers(2)}")
            for _ in range(700)]
    df = spark.createDataFrame(rows, "x string, y string, z string")

    def entropy(cells):
        n = sum(cells.values())
        return -sum(v / n * math.log(v / n) for v in cells.values())

    plain = {(r.a, r.b): r for r in mutual_information(df, ["x", "y", "z"]).collect()}
    full = [r for r in rows if r[0] and r[2]]
    pair = [(x, z) for x, _, z in full]
    want = entropy(Counter(x for x, _ in pair)) + entropy(Counter(z for _, z in pair)) - entropy(Counter(pair))
    assert plain["x", "z"].mi == pytest.approx(want, abs=1e-12) and plain["x", "z"].df == 3
    assert plain["x", "z"].g2 == pytest.approx(2 * len(pair) * want, abs=1e-9)
    given = mutual_information(df, ["x", "y", "z"], given="z").collect()[0]
    want = (entropy(Counter((x, z) for x, _, z in full)) + entropy(Counter((y, z) for _, y, z in full))
            - entropy(Counter(full)) - entropy(Counter(z for *_, z in full)))
    assert given.cmi == pytest.approx(want, abs=1e-12) and given.df == 3 * 2 * 2


def test_cluster_counts_start_from_the_training_part(spark):
    values = {0: [1.0, 2.0, 4.0], 1: [10.0, 11.0, 15.0], 2: [-5.0, -9.0, -4.0]}
    df = spark.createDataFrame([(f, v) for f, vs in values.items() for v in vs], "__fold int, v double")
    got = V.held_out_mixture(df, lambda n: mixture(continuous=["v"], latent_states=n), [1], k=3, iterations=0).collect()[0].mean_ll
    lls = []
    for f, held in values.items():
        train = np.array([v for g, vs in values.items() if g != f for v in vs])
        lls += [-0.5 * math.log(2 * math.pi * train.var()) - (v - train.mean()) ** 2 / (2 * train.var()) for v in held]
    assert got == pytest.approx(np.mean(lls), rel=1e-9)
