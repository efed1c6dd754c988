"""Network templates: each returns a `Network`; states are discovered when it is fitted."""

from __future__ import annotations

import warnings
from dataclasses import replace

from posterion.plans.network import Network, Variable, would_cycle


def _variables(discrete, continuous) -> tuple[Variable, ...]:
    return tuple(Variable(n) for n in discrete) + tuple(Variable(n, "continuous") for n in continuous)


def cluster(name: str = "Cluster", count: int = 10) -> Variable:
    """A latent discrete variable with states Cluster0 .. Cluster{count-1}."""
    return Variable(name, "discrete", tuple(f"Cluster{i}" for i in range(count)), latent=True)


def independent(*, discrete=(), continuous=()) -> Network:
    """No links."""
    return Network(_variables(discrete, continuous))


def naive_bayes(target: str, *, discrete=(), continuous=()) -> Network:
    """P10: the target is the parent of every feature."""
    features = [n for n in (*discrete, *continuous) if n != target]
    found = _variables([d for d in discrete if d != target], continuous)
    return Network((Variable(target),) + found, tuple((target, f) for f in features))


def mixture(*, discrete=(), continuous=(), latent_states: int = 10, name: str = "Cluster",
            block: bool = False) -> Network:
    """A latent cluster is the parent of every column (`block`: one joint Gaussian node)."""
    base = Network((cluster(name, latent_states),) + _variables(discrete, continuous),
                   tuple((name, f) for f in (*discrete, *continuous)))
    return with_multivariate_nodes(base, [continuous]) if block else base


def with_edges(base: Network, edges) -> Network:
    """More links; a link that is present already is kept once."""
    return replace(base, edges=tuple(dict.fromkeys(base.edges + tuple(map(tuple, edges)))))


def without_edges(base: Network, edges) -> Network:
    """Remove the named links."""
    gone = set(map(tuple, edges))
    return replace(base, edges=tuple(e for e in base.edges if e not in gone))


def move_node(base: Network, name: str, *, parents=(), children=()) -> Network:
    """Give a node new parents and children in place of its present links."""
    kept = tuple(e for e in base.edges if name not in e)
    return replace(base, edges=kept + tuple((p, name) for p in parents) + tuple((name, c) for c in children))


def with_tree_structure(base: Network, root: str) -> Network:
    """The root becomes a parent of every other node."""
    return with_edges(base, [(root, n) for n in base.names() if n != root and (n, root) not in base.edges])


def with_latent_node(base: Network, latent_states: int = 10, targets=(), name: str = "Cluster") -> Network:
    """A latent parent of every node; the targets lose their outgoing links."""
    if set(targets) - set(base.names()):
        raise ValueError(f"unknown target nodes: {sorted(set(targets) - set(base.names()))}")
    kept = tuple(e for e in base.edges if e[0] not in targets)
    return Network((cluster(name, latent_states),) + base.variables,
                   tuple((name, n) for n in base.names()) + kept, base.blocks)


def with_fully_connected_nodes(base: Network, nodes, cluster_name: str = "Cluster") -> Network:
    """Every chosen node gets links to all others; latent nodes and cycles are left out."""
    edges = list(base.edges)
    for parent in nodes:
        for v in base.variables:
            impossible = base[parent].kind == "continuous" and v.kind == "discrete"
            if v.name in (parent, cluster_name) or v.latent or (parent, v.name) in edges or impossible:
                continue
            if not would_cycle(edges, parent, v.name):
                edges.append((parent, v.name))
    return replace(base, edges=tuple(edges))


def with_multivariate_nodes(base: Network, blocks) -> Network:
    """Columns of each block form one joint Gaussian node."""
    return replace(base, blocks=tuple(tuple(b) for b in blocks if len(b) > 0))


def with_zero_indicators(base: Network, columns) -> Network:
    """An indicator `<c>_0Node` (state 0 below 0.5, else 1) becomes a parent of each column."""
    extra = tuple(Variable(f"{c}_0Node", "discrete", ("0", "1")) for c in columns)
    return Network(extra + base.variables, base.edges + tuple((f"{c}_0Node", c) for c in columns), base.blocks)


def from_links(base: Network, links) -> Network:
    """P18 from a learned `links(parent, child)` list; links that would close a cycle are dropped."""
    edges = list(base.edges)
    for parent, child in links:
        if would_cycle(edges, parent, child):
            warnings.warn(f"link {parent} -> {child} would close a cycle and is dropped")
        elif (parent, child) not in edges:
            edges.append((parent, child))
    return replace(base, edges=tuple(edges))
