"""Named list functions for ``list_of(..., fn=<name>)``.

Built-in names (count/sum/avg/min/max/first/last, array/text/objects/json)
are handled by the planner; anything else is looked up here. A registered
function has one or both forms:

* ``agg`` — the same result as an ordinary aggregate of the value column
  (e.g. ``sum(x * x)``). The planner prefers it: Spark combines it map-side,
  so a hot key is never gathered into one list.
* ``fn`` — a callable from the sorted value array (a Column) to a Column,
  written with Spark's higher-order functions (order-dependent folds).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

ListFn = Callable[[Column], Column]


@dataclass(frozen=True)
class ListFunction:
    fn: ListFn | None = None   # sorted value array -> Column
    agg: ListFn | None = None  # value column -> aggregate Column


_REGISTRY: dict[str, ListFunction] = {}


def register_list_fn(name: str, fn: ListFn | None = None, agg: ListFn | None = None) -> None:
    if not name.isidentifier():
        raise ValueError(f"list function name must be an identifier: {name!r}")
    if fn is None and agg is None:
        raise ValueError("give an array function, an aggregate form, or both")
    _REGISTRY[name] = ListFunction(fn, agg)


def get_list_fn(name: str) -> ListFunction | None:
    return _REGISTRY.get(name)


def registered() -> list[str]:
    return sorted(_REGISTRY)


register_list_fn("sum_squares", agg=lambda x: F.sum(x * x))
register_list_fn("spread", agg=lambda x: F.max(x) - F.min(x))
register_list_fn("distinct_count", agg=lambda x: F.count_distinct(x))
