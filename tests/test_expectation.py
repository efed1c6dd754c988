"""Expected statistics and EM with gaps against enumeration of every completion."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from posterion.operators.expectation import expectations
from posterion.operators.fit import fit
from posterion.operators.mixture import fit_incomplete, fit_mixture
from posterion.plans.model import Model
from posterion.plans.network import Network, Variable
from posterion.plans.templates import independent, with_edges, with_latent_node
from tests.test_junction import frame, random_model, random_rows, weights, worlds


def brute_cells(model, rows, wt=None):
    """{(node, kind, parents, state): (w, sums, cross)} of the raw values, and the loglikelihood."""
    net, cells, ll = model.network, {}, 0.0
    for row, c in zip(rows, wt or [1.0] * len(rows)):
        found = list(worlds(model, row))
        if not found:
            continue
        w, top = weights(found)
        ll += c * (math.log(w.sum()) + top)
        for share, (at, _, order, mean, cov) in zip(c * w / w.sum(), found):
            for n in net.names("discrete"):
                key = n, "cpt", tuple(at[p] for p in net.parents(n)), at[n]
                cells[key] = (cells.get(key, (0.0,))[0] + share,)
            for g in net.nodes():
                if net[g[0]].kind == "continuous":
                    ix = [order.index(m) for m in net.continuous_parents(g[0]) + list(g)]
                    key = g[0], "gauss", tuple(at[p] for p in net.discrete_parents(g[0])), None
                    old = cells.get(key, (0.0, 0.0, 0.0))
                    cells[key] = (old[0] + share, old[1] + share * mean[ix], old[2] + share * (cov[np.ix_(ix, ix)] + np.outer(mean[ix], mean[ix])))
    return cells, ll


def from_cells(model, cells):
    rows = [{"node": n, "kind": k, "parents": list(p), "state": s, "w": v[0], "sums": None if k == "cpt" else v[1],
             "cross": None if k == "cpt" else v[2].ravel()} for (n, k, p, s), v in cells.items() if v[0] > 0]
    return Model.from_statistics(model.network, rows, {})


@pytest.mark.parametrize("seed,options", [(1, dict(discrete=4, continuous=0)), (2, dict(discrete=3, continuous=3)), (3, dict(discrete=3, continuous=3, block=True)),
                                          (4, dict(discrete=3, continuous=2, latent=True)), (5, dict(discrete=3, continuous=1, zeros=True))])
def test_expected_cells(spark, seed, options):
    model = random_model(seed, **options)
    rows = random_rows(model, seed, 50)
    r = np.random.default_rng(seed)
    wt = [float(x) for x in r.integers(0, 4, len(rows))]
    df = frame(spark, model, rows).join(spark.createDataFrame(list(enumerate(wt)), "id int, wt double"), "id")
    got, ll = expectations(df, model, {}, "wt")
    want, want_ll = brute_cells(model, rows, wt)
    assert ll == pytest.approx(want_ll, abs=1e-7)
    got = {(c["node"], c["kind"], tuple(c["parents"]), c["state"]): c for c in got}
    for key, cell in want.items():
        if cell[0] > 1e-12:
            assert got[key]["w"] == pytest.approx(cell[0], abs=1e-8), key
            if key[1] == "gauss":
                assert got[key]["sums"] == pytest.approx(cell[1], abs=1e-7) and got[key]["cross"] == pytest.approx(cell[2].ravel(), abs=1e-6), key


def same(a: Model, b: Model, tolerance=1e-7):
    for n in a.tables:
        for k in b.tables[n]:
            assert a.tables[n][k] == pytest.approx(b.tables[n][k], abs=tolerance), (n, k)
    for n in a.moments:
        for k, m in b.moments[n].items():
            assert a.moments[n][k].mean == pytest.approx(m.mean, abs=1e-5) and np.allclose(a.moments[n][k].cov, m.cov, atol=1e-4), (n, k)


def test_em_steps_on_a_mixed_network(spark):
    model = random_model(6, discrete=3, continuous=2)
    rows = random_rows(model, 3, 120, gap=.25)
    df = frame(spark, model, rows)
    want, lls = model, []
    for _ in range(4):
        cells, ll = brute_cells(want, rows)
        lls.append(ll)
        want = from_cells(want, cells)
    got = fit_incomplete(df, model.network, iterations=4, tolerance=0.0, initial=model)
    same(got, want)
    assert got.loglikelihood == pytest.approx(brute_cells(want, rows)[1], rel=1e-9) and lls == sorted(lls)


def test_no_gap_is_plain_fitting(spark):
    model = random_model(8, discrete=3, continuous=2)
    df = frame(spark, model, random_rows(model, 4, 200, gap=0.0))
    same(fit_incomplete(df, Network(tuple(Variable(v.name, v.kind) for v in model.network.variables), model.network.edges), iterations=3),
         fit(df, Network(tuple(Variable(v.name, v.kind) for v in model.network.variables), model.network.edges)), 1e-9)


def test_latent_parent_over_a_dag_with_gaps(spark):
    """Cases with a missing second parent take part, and every step raises the loglikelihood of what is returned."""
    truth = random_model(12, discrete=3, continuous=1, latent=True)
    rows = random_rows(truth, 1, 200, gap=.2)
    df = frame(spark, truth, rows)
    base = with_edges(independent(discrete=["d1", "d2"], continuous=["x0"]), [("d1", "d2"), ("d1", "x0")])
    net = with_latent_node(base, 2)
    models = [fit_mixture(df, net, iterations=i, tolerance=0.0, start="x0") for i in (1, 3, 6)]
    lls = [m.loglikelihood for m in models]
    assert lls == sorted(lls)
    for m in models:
        assert m.loglikelihood == pytest.approx(brute_cells(m, rows)[1], rel=1e-9)
    same(fit_mixture(df, net, iterations=2, tolerance=0.0, initial=models[0]), models[1])


def test_many_gaps_in_a_row(spark):
    n = 20
    names = [f"s{i:02d}" for i in range(n)]
    net = with_edges(independent(discrete=names), list(zip(names, names[1:])))
    r = np.random.default_rng(1)
    rows = [{v: None if r.random() < .5 and i else str(r.integers(0, 2)) for v in names} for i in range(40)]
    rows += [dict.fromkeys(names)] + [{v: s for v in names} for s in "01"]
    df = spark.createDataFrame([tuple(x[v] for v in names) for x in rows], ", ".join(f"{v} string" for v in names))
    m = fit_incomplete(df, net, iterations=5, tolerance=0.0)
    assert m.loglikelihood is not None and all(abs(sum(t.values()) - 1) < 1e-9 for f in m.tables.values() for t in f.values())


def test_held_out_loglikelihood_has_no_nulls_under_gaps(spark):
    """A held-out case with a missing parent is answered by summing over it."""
    from posterion.operators.validate import fit_folds, held_out_loglikelihood, split
    truth = random_model(21, discrete=3, continuous=1)
    rows = random_rows(truth, 5, 90, gap=.3)
    df = frame(spark, truth, rows).withColumn("__fold", F.col("id") % 3)
    net = Network(tuple(Variable(v.name, v.kind) for v in truth.network.variables), truth.network.edges)
    got = {r.id: r.loglikelihood for r in held_out_loglikelihood(df, {"t": net}, id_col="id").collect()}
    assert len(got) == 90 and any(row[p] is None for row in rows for p in ("d0", "d1"))
    whole = fit_folds(df, net, 3)
    for f in range(3):
        train, test = split(df, f)
        part = fit(train, whole.network.without(["__fold"]))
        for r in test.collect():
            found = list(worlds(part, rows[r.id])) if all(part.joint_gaussian(["x0"], dict(zip(part.network.discrete_parents("x0"), c))) for c in
                                                          part.combos(part.network.discrete_parents("x0"))) else None
            if found:
                w, top = weights(found)
                assert got[r.id] == pytest.approx(math.log(w.sum()) + top, abs=1e-6)


def test_columns_single_in_a_training_part_say_nothing_there(spark):
    """A column whose other state stands in one fold only does not spoil that fold's predictions."""
    from posterion.operators.validate import cross_validate
    from posterion.plans.templates import naive_bayes
    rows = []
    for i in range(240):
        f, y = i % 3, (i // 3) % 2
        rows.append((i, f, f"y{y}", f"a{y if i % 10 else 1 - y}", "only" if f else "rare"))      # `rare` in fold 0 alone
    df = spark.createDataFrame(rows, "id int, __fold int, y string, a string, c string")
    with_c = {r.fold: r.accuracy for r in cross_validate(df, {"t": naive_bayes("y", discrete=["a", "c"])}, "y").collect()}
    without = {r.fold: r.accuracy for r in cross_validate(df, {"t": naive_bayes("y", discrete=["a"])}, "y").collect()}
    assert with_c[0] == pytest.approx(without[0]) and with_c[0] > .8
