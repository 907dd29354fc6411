"""Named operators with default options, and ordered chains built from a configuration."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from scoreloom.model import SeqSet

KINDS = ("processor", "attribute", "augmenter", "decoder", "encoder", "representation")


@dataclass(frozen=True)
class Operator:
    kind: str
    name: str
    fn: Callable[..., Any]
    defaults: Mapping[str, Any] = field(default_factory=dict)

    def options(self, given: Mapping[str, Any] | None = None) -> dict[str, Any]:
        """Defaults overlaid with the given options; unknown names are an error."""
        given = dict(given or {})
        unknown = sorted(set(given) - set(self.defaults))
        if unknown:
            raise ValueError(f"{self.kind} {self.name!r} has no option {', '.join(unknown)}")
        return {**self.defaults, **given}


_OPERATORS: dict[tuple[str, str], Operator] = {}


def operator(kind: str, name: str, **defaults: Any) -> Callable[[Callable], Callable]:
    """Register a function under a kind and a name. The function itself is returned unchanged."""
    if kind not in KINDS:
        raise ValueError(f"unknown operator kind {kind!r}")

    def register(fn: Callable) -> Callable:
        _OPERATORS[(kind, name)] = Operator(kind, name, fn, defaults)
        return fn

    return register


def lookup(kind: str, name: str) -> Operator:
    try:
        return _OPERATORS[(kind, name)]
    except KeyError:
        raise ValueError(f"no {kind} named {name!r}; known: {', '.join(names(kind))}") from None


def names(kind: str) -> list[str]:
    return [n for k, n in _OPERATORS if k == kind]


Steps = Mapping[str, Mapping[str, Any]] | Iterable[tuple[str, Mapping[str, Any]]]


def ordered_steps(config: Steps) -> list[tuple[str, dict[str, Any]]]:
    """Steps sorted by their ``order`` option, which is taken off. A negative order switches a step off.

    A mapping allows each operator once; a list of (name, options) pairs may repeat one. A step without an
    order keeps its position in the configuration.
    """
    items = config.items() if isinstance(config, Mapping) else config
    placed = []
    for position, (name, options) in enumerate(items):
        options = dict(options or {})
        order = options.pop("order", position)
        if order >= 0:
            placed.append((order, name, options))
    return [(name, options) for _, name, options in sorted(placed, key=lambda step: step[0])]


def apply_chain(
    seqs: SeqSet,
    kind: str,
    config: Steps,
    after: Callable[[str, dict, SeqSet, SeqSet], None] | None = None,
    once: bool = False,
) -> SeqSet:
    """Apply the configured operators of one kind in order. ``after`` is shown each step's input and output.

    The chain is one lazy plan where sequences are known to be small. Where they are not, operators read their
    input more than once, so each step is settled in the shared folder before the next. With ``once`` this is always done: a
    job that goes on to use all three tables then runs each step a single time, where a lazy plan would be run again
    for each table, and for each use of a table by a later step.
    """

    def step(current: SeqSet, item: tuple[str, dict[str, Any]]) -> SeqSet:
        op = lookup(kind, item[0])
        result = op.fn(current, **op.options(item[1]))
        result = result.settled() if once or not result.bounded else result
        if after:
            after(item[0], op.options(item[1]), current, result)
        return result

    return reduce(step, ordered_steps(config), seqs)
