import pytest

from posterion.plans.network import Network, Variable, would_cycle
from posterion.plans.templates import (cluster, from_links, independent, mixture, move_node, naive_bayes, with_edges,
                                       with_fully_connected_nodes, with_latent_node, with_multivariate_nodes,
                                       with_tree_structure, without_edges)


def test_cycles_and_unknown_nodes_are_rejected():
    base = independent(discrete=["a", "b"])
    with pytest.raises(ValueError):
        with_edges(base, [("a", "b"), ("b", "a")])
    with pytest.raises(ValueError):
        with_edges(base, [("a", "nowhere")])
    with pytest.raises(ValueError):
        Network((Variable("x", "continuous"), Variable("d")), (("x", "d"),))


def test_templates():
    nb = naive_bayes("t", discrete=["a", "t"], continuous=["x"])
    assert set(nb.edges) == {("t", "a"), ("t", "x")}
    mx = mixture(discrete=["a"], continuous=["x", "y"], latent_states=3, block=True)
    assert mx["Cluster"].states == ("Cluster0", "Cluster1", "Cluster2") and mx.blocks == (("x", "y"),)
    lat = with_latent_node(with_edges(independent(discrete=["a", "b"]), [("a", "b")]), 2, targets=["a"])
    assert ("a", "b") not in lat.edges and ("Cluster", "a") in lat.edges
    tree = with_tree_structure(independent(discrete=["r", "a", "b"]), "r")
    assert set(tree.edges) == {("r", "a"), ("r", "b")}
    full = with_fully_connected_nodes(independent(discrete=["a", "b", "c"]), ["a", "b", "c"])
    assert set(full.edges) == {("a", "b"), ("a", "c"), ("b", "c")}
    moved = move_node(tree, "a", parents=["b"])
    assert set(moved.edges) == {("r", "b"), ("b", "a")}
    assert without_edges(tree, [("r", "a")]).edges == (("r", "b"),)
    assert with_multivariate_nodes(independent(continuous=["x", "y"]), [["x", "y"]]).nodes() == [("x", "y")]
    assert cluster("C", 2).latent
    with pytest.warns(UserWarning):
        kept = from_links(independent(discrete=["a", "b"]), [("a", "b"), ("b", "a")])
    assert kept.edges == (("a", "b"),)


def test_order_and_parameters():
    net = with_edges(independent(discrete=["a", "b", "c"]), [("a", "b"), ("b", "c")]).with_states(
        {"a": ("0", "1"), "b": ("0", "1", "2"), "c": ("0", "1")})
    assert net.order() == ["a", "b", "c"] and net.parents("c") == ["b"]
    assert net.free_parameters() == 1 + 2 * 2 + 3
    assert net.ancestors(["c"]) == {"a", "b", "c"}
    assert would_cycle([("a", "b")], "b", "a") and not would_cycle([("a", "b")], "a", "b")
