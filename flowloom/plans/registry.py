"""Named tables: what they need, how often, and how they are computed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from datetime import timedelta
from typing import Any

from flowloom.plans.slots import HALF_HOUR, Timescale

# What a feature does about a slot whose input has missing files, or no table at all. A slot none of
# whose inputs has a table never has a result.
ERROR = "error"      # missing files: the slot cannot be computed; no table: it has no result
PARTIAL = "partial"  # missing files: the slot cannot be computed; no table: the input is empty
SKIP = "skip"        # what is there is used; no table: the slot has no result
EMPTY = "empty"      # what is there is used; no table: the input is empty


class MissingInput(Exception):
    """Raw files or stored slots that a feature needs and that do not exist."""

    def __init__(self, name: str, paths: Iterable[str]):
        self.name = name
        self.paths = frozenset(paths)
        shown = ", ".join(sorted(self.paths)[:10])
        super().__init__(f"cannot compute {name}: {len(self.paths)} inputs missing, such as {shown}")


@dataclass(frozen=True)
class Input:
    """A feature another one reads: which columns, how far shifted in time, and what if it is missing."""

    feature: str
    columns: tuple[str, ...] | None = None
    offset: timedelta = timedelta(0)
    on_missing: str = ERROR


@dataclass(frozen=True)
class Feature:
    """A table per slot.

    ``compute(context, *inputs)`` gets one DataFrame per input holding the rows of all slots asked for,
    with the slot they are wanted for in ``slot_start``, and keeps that column: one plan covers many slots.
    ``carry`` marks a feature that reads its own slot before: it gets the state before the first of the slots (None if there
    is none) in that input's place, and gives the rows of all slots.
    """

    name: str
    timescale: Timescale = HALF_HOUR
    inputs: tuple[Input, ...] = ()
    compute: Callable[..., Any] | None = None
    loader: Any = None
    memoize: bool = False
    carry: bool = False
    description: str = ""

    def also(self, **changes) -> "Feature":
        """A copy with some settings changed."""
        return replace(self, **changes)


@dataclass
class Registry:
    entries: dict[str, Feature] = field(default_factory=dict)

    def add(self, feature: Feature) -> Feature:
        if feature.name in self.entries:
            raise ValueError(f"feature {feature.name} is defined twice")
        self.entries[feature.name] = feature
        return feature

    def feature(self, *inputs: Input, name: str | None = None, **settings):
        """Decorator that registers a recipe under its function's name."""

        def register(fn):
            self.add(Feature(name=name or fn.__name__, inputs=inputs, compute=fn, **settings))
            return fn

        return register

    def __getitem__(self, name: str) -> Feature:
        if name not in self.entries:
            raise KeyError(f"feature {name} is not registered; there are {sorted(self.entries)}")
        return self.entries[name]

    def __contains__(self, name: str) -> bool:
        return name in self.entries

    def __iter__(self):
        return iter(self.entries)

    def closure(self, names: Sequence[str]) -> list[str]:
        """The named tables and everything they need, inputs first; a feature may need itself."""
        order: list[str] = []
        open_names: set[str] = set()

        def visit(name: str):
            if name in order or name in open_names:
                return
            open_names.add(name)
            for needed in self[name].inputs:
                visit(needed.feature)
            order.append(name)

        for name in names:
            visit(name)
        return order
