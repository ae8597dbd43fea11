"""Models as a graph: built in order, checked after each, what depends on a failure left out."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidewatch.quality import ERROR, Check, failing


@dataclass(frozen=True)
class Model:
    """``fn`` gets the models it names in ``deps``; ``checks`` gets the result and then those.

    A model whose ``fn`` gives None has nothing to write this time and keeps what it had. ``saves_itself``: it has been saved when ``fn`` returns.
    ``after_failure``: it is built from those of its ``deps`` that were built, unless none was.
    """

    name: str
    fn: Callable[..., DataFrame]
    deps: tuple[str, ...] = ()
    checks: Callable[..., list[Check]] | None = None
    retries: int = 0
    saves_itself: bool = False
    after_failure: bool = False


@dataclass
class Outcome:
    status: str
    seconds: float = 0.0
    checks: dict[str, int] = field(default_factory=dict)
    error: str = ""


class Graph:
    def __init__(self, models: Iterable[Model]):
        self.models = {m.name: m for m in models}
        for m in self.models.values():
            if missing := set(m.deps) - self.models.keys():
                raise KeyError(f"{m.name} needs {sorted(missing)}")

    def order(self) -> list[str]:
        done: dict[str, bool] = {}
        out: list[str] = []

        def visit(name: str) -> None:
            if done.get(name) is False:
                raise ValueError(f"{name} depends on itself")
            if name not in done:
                done[name] = False
                for d in self.models[name].deps:
                    visit(d)
                done[name] = True
                out.append(name)

        for name in self.models:
            visit(name)
        return out

    def select(self, pattern: str | None = None) -> set[str]:
        """A layer (``silver``), a model (``gold.tags``), with ``+`` after it all that depends on it, with ``+`` before it all it needs."""
        if not pattern:
            return set(self.models)
        core = pattern.strip("+")
        chosen = {n for n in self.models if n == core or n.startswith(core + ".")}
        if not chosen:
            raise KeyError(core)
        grow = set(chosen)
        for _ in self.models:
            if pattern.endswith("+"):
                grow |= {n for n, m in self.models.items() if grow & set(m.deps)}
            if pattern.startswith("+"):
                grow |= {d for n in grow for d in self.models[n].deps}
        return grow

    def run(self, patterns: str | Iterable[str] | None = None, save: Callable[[str, DataFrame], DataFrame] | None = None, load: Callable[[str], DataFrame | None] | None = None, pause: float = 30.0) -> dict[str, Outcome]:
        """Build the selected models; ``save`` materialises one, ``load`` gives one that isn't built now.

        A failed check of severity error, or an exception, skips all that depends on the model.
        """
        wanted = self.select() if patterns is None else set().union(*map(self.select, [patterns] if isinstance(patterns, str) else patterns))
        built, report = {}, {}
        for name in self.order():
            if name not in wanted:
                continue
            m, began = self.models[name], time.time()
            lost = [d for d in m.deps if d in report and report[d].status in ("failed", "skipped")]
            if lost and not (m.after_failure and len(lost) < len(m.deps)):
                report[name] = Outcome("skipped")
                continue
            for attempt in range(m.retries + 1):
                try:
                    inputs = [self._input(d, built, load) for d in m.deps if d not in lost]
                    df = m.fn(*inputs)
                    if df is None:
                        report[name] = Outcome("unchanged", time.time() - began)
                        break
                    built[name] = save(name, df) if save and not m.saves_itself else df
                    checks = m.checks(built[name], *inputs) if m.checks else []
                    found = failing(checks)
                    bad = any(found[c.name] and c.severity == ERROR for c in checks)
                    report[name] = Outcome("failed" if bad else "built", time.time() - began, found)
                    break
                except Exception as error:  # noqa: BLE001 - reported, and what depends on it is skipped
                    report[name] = Outcome("failed", time.time() - began, error=str(error)[:2000])
                    if attempt < m.retries:
                        time.sleep(pause * 2**attempt)
        return report

    def _input(self, name: str, built: dict[str, DataFrame], load) -> DataFrame:
        if name in built:
            return built[name]
        df = load(name) if load else self.models[name].fn()
        if df is None:
            raise LookupError(f"{name} was never built")
        return df

    def check(self, name: str, load: Callable[[str], DataFrame | None]) -> dict[str, int]:
        """The failing rows of each check of a model as it stands."""
        m = self.models[name]
        return failing(m.checks(*(self._input(n, {}, load) for n in (name, *m.deps)))) if m.checks else {}

    def lineage(self) -> list[tuple[str, str]]:
        return [(d, n) for n, m in self.models.items() for d in m.deps]
