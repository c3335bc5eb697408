"""Declarative specs for settlement formulas.

A *formula* sets numeric (or text) columns of one data set, item by item, for
the rows that pass its equality filter. Each *item* is an expression over
named *inputs*; an input takes a field of another data set (or of the target
itself) matched on shared columns, optionally filtered, in one of four kinds:

* ``value`` – the single matching row's field (one-to-one lookup),
* ``sum`` / ``avg`` – aggregate of the matching rows,
* ``list`` – the matching rows as a list, reduced by a list function.

Specs are validated plain dataclasses; they compile to DataFrame plans in
:mod:`apportion.operators.formula`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any, Union

from pyspark.sql import Column

KINDS = ("value", "sum", "avg", "list")

# List reductions that Spark computes as ordinary (partially aggregated)
# aggregates, so a hot key never has to be materialised as one list.
DECOMPOSABLE_LIST_FNS = ("count", "sum", "avg", "min", "max", "first", "last")
# List reductions that need the list itself (sorted by ``order_by``).
COLLECTED_LIST_FNS = ("array", "text", "objects", "json")

Expr = Union[str, Callable[[Mapping[str, Column]], Column]]


def _pairs(on: Any) -> tuple[tuple[str, str], ...]:
    """Normalise match columns to ``((target_col, source_col), ...)``.

    Accepts one name, a list of names shared by both sides, a mapping
    ``{target_col: source_col}`` or a list of pairs.
    """
    if on is None:
        return ()
    if isinstance(on, str):
        return ((on, on),)
    if isinstance(on, Mapping):
        return tuple((str(k), str(v)) for k, v in on.items())
    out = []
    for x in on:
        if isinstance(x, str):
            out.append((x, x))
        else:
            left, right = x
            out.append((str(left), str(right)))
    return tuple(out)


def _filter(flt: Any) -> tuple[tuple[str, Any], ...]:
    if not flt:
        return ()
    if isinstance(flt, Mapping):
        return tuple(flt.items())
    return tuple((str(k), v) for k, v in flt)


@dataclass(frozen=True)
class Input:
    """One named input of a formula item (see module docstring)."""

    name: str
    dataset: str
    field: str
    kind: str = "value"
    on: tuple[tuple[str, str], ...] = ()
    filter: tuple[tuple[str, Any], ...] = ()
    default: float | None = None
    fn: str | Callable[[Column], Column] | None = None
    order_by: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()
    on_duplicate: str = "error"
    hot_keys: bool = False  # the target has very frequent match keys: let AQE split the join at one more shuffle

    def __post_init__(self) -> None:
        if not self.name.isidentifier():
            raise ValueError(f"input name must be an identifier: {self.name!r}")
        if self.kind not in KINDS:
            raise ValueError(f"unknown input kind {self.kind!r}; expected one of {KINDS}")
        if self.on_duplicate not in ("error", "any"):
            raise ValueError("on_duplicate must be 'error' or 'any'")
        if self.kind == "list":
            fn = self.fn or "array"
            if isinstance(fn, str) and fn not in DECOMPOSABLE_LIST_FNS + COLLECTED_LIST_FNS:
                from apportion.functions.lists import get_list_fn, registered

                if get_list_fn(fn) is None:
                    raise ValueError(f"unknown list function {fn!r}; registered: {registered()}")
            if fn in ("first", "last") and not self.order_by:
                raise ValueError(f"list function {fn!r} needs order_by")
            if not self.on and not _decomposable(fn):
                # a keyless list would gather the whole source into one value
                raise ValueError("a list input without match columns needs a decomposable list function")

    @property
    def group_key(self) -> tuple:
        """Inputs with equal (data set, match) share one aggregate and one join."""
        return (self.dataset, self.on)

    @property
    def filter_key(self) -> tuple:
        return tuple((k, repr(v)) for k, v in self.filter)

    @property
    def list_fn(self) -> str | Callable[[Column], Column]:
        return self.fn or "array"


def _decomposable(fn: Any) -> bool:
    if not isinstance(fn, str):
        return False
    if fn in DECOMPOSABLE_LIST_FNS:
        return True
    from apportion.functions.lists import get_list_fn

    reg = get_list_fn(fn)
    return reg is not None and reg.agg is not None


def _mk(kind: str, name: str, dataset: str, field: str, on: Any = None, filter: Any = None, **kw: Any) -> Input:
    return Input(name=name, dataset=dataset, field=field, kind=kind, on=_pairs(on), filter=_filter(filter), **kw)


def lookup(name: str, dataset: str, field: str, on: Any = None, filter: Any = None,
           default: float | None = None, on_duplicate: str = "error", hot_keys: bool = False) -> Input:
    """One-to-one lookup; several matching rows raise unless ``on_duplicate='any'``."""
    return _mk("value", name, dataset, field, on, filter, default=default, on_duplicate=on_duplicate,
               hot_keys=hot_keys)


def sum_of(name: str, dataset: str, field: str, on: Any = None, filter: Any = None,
           default: float | None = None, hot_keys: bool = False) -> Input:
    return _mk("sum", name, dataset, field, on, filter, default=default, hot_keys=hot_keys)


def avg_of(name: str, dataset: str, field: str, on: Any = None, filter: Any = None,
           default: float | None = None, hot_keys: bool = False) -> Input:
    return _mk("avg", name, dataset, field, on, filter, default=default, hot_keys=hot_keys)


def list_of(name: str, dataset: str, field: str, on: Any = None, filter: Any = None,
            fn: str | Callable[[Column], Column] = "array", order_by: Sequence[str] = (),
            fields: Sequence[str] = (), default: float | None = None, hot_keys: bool = False) -> Input:
    """Matching rows as a list, reduced by ``fn``.

    ``fn`` is a decomposable name (count/sum/avg/min/max/first/last), a
    collected form (array/text/objects/json, sorted by ``order_by``), or a
    callable receiving the sorted array Column (higher-order functions).
    ``objects``/``json`` elements map ``fields`` (all source columns when
    none are given) to their values as text.
    """
    return _mk("list", name, dataset, field, on, filter, fn=fn, order_by=tuple(order_by),
               fields=tuple(fields), default=default, hot_keys=hot_keys)


@dataclass(frozen=True)
class Item:
    """Set ``field`` to ``expr`` for the formula's rows.

    ``expr`` is a Spark SQL expression in which ``$name`` refers to an input
    and bare names to the target row's columns, or a callable receiving the
    inputs as Columns. A null result keeps the old value. ``$name`` is bound
    wherever it appears in the text (also inside string literals), so a
    literal dollar sign followed by a letter needs a Column callable.
    """

    field: str
    expr: Expr
    inputs: tuple[Input, ...] = ()

    def __post_init__(self) -> None:
        names = [i.name for i in self.inputs]
        if len(names) != len(set(names)):
            raise ValueError(f"duplicate input names in item {self.field!r}: {names}")


@dataclass(frozen=True)
class Formula:
    """Ordered items applied to ``dataset`` where every ``filter`` column equals its value."""

    name: str
    dataset: str
    items: tuple[Item, ...] = ()
    filter: tuple[tuple[str, Any], ...] = field(default=())

    @staticmethod
    def of(name: str, dataset: str, items: Sequence[Item], filter: Any = None) -> "Formula":
        return Formula(name=name, dataset=dataset, items=tuple(items), filter=_filter(filter))
