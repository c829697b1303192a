"""Supersteps over tables: a state graph whose nodes are DataFrame functions, run until nothing is left to do.

The state is a dict of tables. In a superstep every active node reads the state as it was, and its writes are merged by the
channel's reducer afterwards. Edges and conditional edges name the nodes of the next superstep.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

State = dict[str, Any]
START, END = "__start__", "__end__"


class RecursionLimitError(RuntimeError):
    pass


@dataclass
class StateGraph:
    reducers: dict[str, Callable[[Any, Any], Any]] = field(default_factory=dict)
    nodes: dict[str, Callable[[State], State]] = field(default_factory=dict)
    edges: dict[str, list[str]] = field(default_factory=dict)
    branches: dict[str, Callable[[State], str | list[str]]] = field(default_factory=dict)
    joins: list[tuple[frozenset[str], str]] = field(default_factory=list)

    def node(self, name: str, f: Callable[[State], State]) -> StateGraph:
        if name in self.nodes or name in (START, END):
            raise ValueError(f"node {name} exists")
        self.nodes[name] = f
        return self

    def edge(self, a: str | list[str], b: str) -> StateGraph:
        """An edge; from a list of nodes: once all of them have run."""
        if isinstance(a, list):
            self.joins.append((frozenset(a), b))
        else:
            self.edges.setdefault(a, []).append(b)
        return self

    def branch(self, a: str, choose: Callable[[State], str | list[str]]) -> StateGraph:
        self.branches[a] = choose
        return self

    def check(self) -> None:
        known = {*self.nodes, START, END}
        for a, bs in self.edges.items():
            for b in [a, *bs]:
                if b not in known:
                    raise ValueError(f"unknown node {b}")
        if START not in self.edges and START not in self.branches:
            raise ValueError("nothing follows the start")

    def run(self, state: State, *, limit: int = 25, interrupt_before: tuple[str, ...] = (), save: Callable[[int, State], State] | None = None) -> State:
        """Supersteps to quiescence; ``save`` may write tables and return the state to go on from (durability)."""
        self.check()
        state, active, step, waiting = dict(state), self._after(START, state), 0, {}
        while active:
            if step >= limit:
                raise RecursionLimitError(f"{limit} supersteps without an end")
            if set(active) & set(interrupt_before):
                state["__interrupted__"] = sorted(set(active) & set(interrupt_before))
                return state
            writes = [(n, self.nodes[n](dict(state))) for n in sorted(active)]
            state = self._applied(state, writes)
            state = save(step, state) if save else state
            following: set[str] = set()
            for n, _ in writes:
                following |= set(self._after(n, state))
                for k, (names, target) in enumerate(self.joins):
                    if n in names:
                        waiting.setdefault(k, set()).add(n)
                        if waiting[k] == names:
                            following.add(target)
                            waiting[k] = set()
            active, step = sorted(following - {END}), step + 1
        return state

    def _after(self, n: str, state: State) -> list[str]:
        out = list(self.edges.get(n, []))
        if n in self.branches:
            chosen = self.branches[n](state)
            out += [chosen] if isinstance(chosen, str) else list(chosen)
        return [x for x in out if x != END]

    def _applied(self, state: State, writes: list[tuple[str, State]]) -> State:
        out, written = dict(state), {}
        for n, w in writes:
            for channel, value in w.items():
                if channel in self.reducers:
                    out[channel] = self.reducers[channel](out.get(channel), value)
                elif channel in written:
                    raise ValueError(f"{channel} got two values in a superstep, from {written[channel]} and {n}")
                else:
                    out[channel], written[channel] = value, n
        return out


def append_rows(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b, allowMissingColumns=True)


def iterate(state: DataFrame, step: Callable[[DataFrame], DataFrame], done: Callable[[DataFrame], bool], limit: int = 50) -> DataFrame:
    """A loop with a termination condition; lineage is cut each round."""
    from ..operators.graph import cut

    for _ in range(limit):
        if done(state):
            return state
        state = cut(step(state), "loop")
    raise RecursionLimitError(f"{limit} rounds without an end")
