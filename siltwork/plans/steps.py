"""Steps that name what they read and make; their order follows from that, and so do the checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass


@dataclass(frozen=True)
class Step:
    """``do`` gets the values in ``reads`` and returns those in ``makes``, a tuple if there are several.

    ``only`` names the decision that the step belongs to; ``given`` a value without which (or if it is 0) it is left out.
    """

    name: str
    do: Callable
    reads: tuple[str, ...] = ()
    makes: tuple[str, ...] = ()
    only: str | None = None
    given: str | None = None


def waits(steps: Iterable[Step]) -> dict[str, set[str]]:
    """Each step's name and the names of those that make what it reads."""
    steps = list(steps)
    makers: dict[str, set[str]] = {}
    for s in steps:
        for value in s.makes:
            makers.setdefault(value, set()).add(s.name)
    return {s.name: set().union(*(makers.get(v, set()) for v in (*s.reads, s.given))) - {s.name} for s in steps}


def in_order(steps: Iterable[Step]) -> list[Step]:
    """Steps so that each comes after those whose values it reads, otherwise as given; steps that read in a circle raise."""
    left, done, out = list(steps), set(), []
    before = waits(left)
    while left:
        ready = next((s for s in left if before[s.name] <= done), None)
        if ready is None:
            raise ValueError(f"these steps read each other's values: {', '.join(s.name for s in left)}")
        left.remove(ready)
        done.add(ready.name)
        out.append(ready)
    return out


def problems(steps: Iterable[Step], given: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """What is wrong with steps that start from the values ``given`` and are to make ``wanted``; empty if nothing is."""
    steps, known = list(steps), set(given)
    made = {v for s in steps for v in s.makes}
    found = [f"{s.name} reads {v}, which nothing makes" for s in steps for v in s.reads if v not in known | made]
    found += [f"nothing makes {v}" for v in wanted if v not in known | made]
    found += [f"{v} is made by {' and '.join(s.name for s in those)}, which can both run" for v in sorted(made)
              if len(those := [s for s in steps if v in s.makes]) > 1 and len({s.only for s in those}) < len(those)]
    found += [f"two steps are called {n}" for n in sorted({s.name for s in steps}) if sum(s.name == n for s in steps) > 1]
    read = {v for s in steps for v in s.reads} | set(wanted)
    found += [f"{s.name} makes only what nobody reads" for s in steps if s.makes and not set(s.makes) & read]
    try:
        in_order(steps)
    except ValueError as e:
        found.append(str(e))
    return found


def run(steps: Iterable[Step], values: dict, decision: str = "decision") -> dict:
    """Runs the steps in order on the values; steps of another decision than the one made, or without what they are given, are left out. A step that fails raises ``StepFailed``."""
    for step in in_order(steps):
        if (step.only is not None and step.only != values.get(decision)) or (step.given is not None and not values.get(step.given)):
            continue
        try:
            out = step.do(*(values.get(v) for v in step.reads))
        except Exception as e:
            raise StepFailed(step.name, e) from e
        values.update(zip(step.makes, out if len(step.makes) > 1 else (out,), strict=True) if step.makes else ())
    return values


class StepFailed(RuntimeError):
    def __init__(self, step: str, error: Exception):
        super().__init__(f"{step}: {error}")
        self.step, self.error = step, error
