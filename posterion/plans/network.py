"""Network specification: variables, links and multivariate blocks."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from math import prod


@dataclass(frozen=True)
class Variable:
    name: str
    kind: str = "discrete"              # "discrete" or "continuous"
    states: tuple[str, ...] = ()
    latent: bool = False
    selector: bool = False              # a fold or model id above everything: picks parameters, is no quantity


@dataclass(frozen=True)
class Network:
    """A DAG over variables. `blocks` are multivariate Gaussian nodes (name -> members)."""

    variables: tuple[Variable, ...]
    edges: tuple[tuple[str, str], ...] = ()
    blocks: tuple[tuple[str, ...], ...] = field(default=())

    def __post_init__(self):
        names = [v.name for v in self.variables]
        if len(set(names)) != len(names):
            raise ValueError("duplicate variable names")
        known = set(names)
        for parent, child in self.edges:
            missing = {parent, child} - known
            if missing:
                raise ValueError(f"unknown node(s) in link: {sorted(missing)}")
            if self[parent].kind == "continuous" and self[child].kind == "discrete":
                raise ValueError(f"discrete node {child} cannot have the continuous parent {parent}")
        for block in self.blocks:
            if any(self[m].kind != "continuous" for m in block):
                raise ValueError("a multivariate node holds continuous variables only")
        self.order()

    def __getitem__(self, name: str) -> Variable:
        for v in self.variables:
            if v.name == name:
                return v
        raise ValueError(f"unknown variable: {name}")

    def names(self, kind: str | None = None) -> list[str]:
        return [v.name for v in self.variables if kind is None or v.kind == kind]

    def observed(self, kind: str | None = None) -> list[str]:
        return [n for n in self.names(kind) if not self[n].latent]

    def members(self, name: str) -> tuple[str, ...]:
        """The variables that share a node with this one."""
        return next((b for b in self.blocks if name in b), (name,))

    def nodes(self) -> list[tuple[str, ...]]:
        seen: list[tuple[str, ...]] = []
        for v in self.variables:
            m = self.members(v.name)
            if m not in seen:
                seen.append(m)
        return seen

    def parents(self, name: str) -> list[str]:
        """Parents sorted by name (the order used in parent keys)."""
        group = self.members(name)
        return sorted({p for p, c in self.edges if c in group and p not in group})

    def children(self, name: str) -> list[str]:
        return sorted({c for p, c in self.edges if p == name})

    def discrete_parents(self, name: str) -> list[str]:
        return [p for p in self.parents(name) if self[p].kind == "discrete"]

    def continuous_parents(self, name: str) -> list[str]:
        return [p for p in self.parents(name) if self[p].kind == "continuous"]

    def ancestors(self, names) -> set[str]:
        found, todo = set(), list(names)
        while todo:
            n = todo.pop()
            if n not in found:
                found.add(n)
                todo.extend(self.parents(n))
        return found

    def order(self) -> list[str]:
        """Topological order; a cycle is an error."""
        pending, done, result = self.names(), set(), []
        while pending:
            ready = [n for n in pending if set(self.parents(n)) <= done]
            if not ready:
                raise ValueError(f"links form a cycle among {pending}")
            result += ready
            done |= set(ready)
            pending = [n for n in pending if n not in done]
        return result

    def grid_size(self, names) -> int:
        return prod(len(self[n].states) for n in names)

    def free_parameters(self) -> int:
        total = 0
        for group in self.nodes():
            combos = self.grid_size(self.discrete_parents(group[0]))
            if self[group[0]].kind == "discrete":
                total += (len(self[group[0]].states) - 1) * combos
            elif len(group) == 1:
                total += (2 + len(self.continuous_parents(group[0]))) * combos
            else:
                d = len(group)
                total += (d + d * (d + 1) // 2 + d * len(self.continuous_parents(group[0]))) * combos
        return total

    def with_states(self, states: dict[str, tuple[str, ...]]) -> "Network":
        return replace(self, variables=tuple(
            replace(v, states=tuple(states[v.name])) if v.name in states else v for v in self.variables))

    def with_common_parent(self, variable: Variable) -> "Network":
        """The same network with one more discrete variable as a parent of every node.

        Fold, model and subset ids are handled this way: one fit holds all models.
        """
        return Network((replace(variable, selector=True),) + self.variables,
                       tuple((variable.name, n) for n in self.names()) + self.edges, self.blocks)

    def without(self, names) -> "Network":
        gone = set(names)
        return Network(tuple(v for v in self.variables if v.name not in gone),
                       tuple(e for e in self.edges if not gone & set(e)),
                       tuple(b for b in (tuple(m for m in b if m not in gone) for b in self.blocks) if b))


def would_cycle(edges, parent: str, child: str) -> bool:
    todo, seen = [child], set()
    while todo:
        n = todo.pop()
        if n == parent:
            return True
        if n not in seen:
            seen.add(n)
            todo.extend(c for p, c in edges if p == n)
    return False
