"""Plan formula inputs as aggregate-then-join.

All inputs of one formula that share a source data set and match columns are
served by ONE ``groupBy(match).agg(...)`` and ONE left join onto the target —
one join per distinct match, however many inputs use it. Inputs with
different filters on the same match share it too: the source is filtered by
the OR of their filters (pushed to the scan) and each aggregate only sees
its own rows (``sum(CASE WHEN filter THEN x END)``). Aggregation runs before
the join, so Spark's partial (map-side) aggregation collapses hot keys
before anything is shuffled, and the joined right side has one row per key.
Lookups carry a row count so a key that matches several rows raises at
evaluation (no extra job).
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.functions.filters import equality
from apportion.functions.lists import get_list_fn
from apportion.operators.keys import join_matches
from apportion.specs import DECOMPOSABLE_LIST_FNS, Input

_seq = itertools.count()


def fresh(prefix: str) -> str:
    """A temp column name that cannot clash with data set columns."""
    return f"__{prefix}{next(_seq)}"


@dataclass
class Joined:
    """Result of joining one input group: the new frame, the binding of each
    input (a Column over temp columns) and the temp columns to drop later."""

    df: DataFrame
    bindings: dict[tuple, Column]
    temps: list[str]


def input_signature(inp: Input) -> tuple:
    """Inputs with equal signatures in a group compute the same value."""
    fn = inp.list_fn if inp.kind == "list" else None
    return (inp.kind, inp.field, fn if isinstance(fn, str) or fn is None else id(fn),
            inp.order_by, inp.fields, inp.on_duplicate, inp.filter_key)


class _Rows:
    """Column access restricted to the rows of one filter (None = all rows)."""

    def __init__(self, cond: Column | None, keyed: bool = True):
        self.cond = cond
        self.keyed = keyed

    def col(self, name: str) -> Column:
        return F.col(name) if self.cond is None else F.when(self.cond, F.col(name))

    def one(self) -> Column:
        return F.lit(1) if self.cond is None else F.when(self.cond, F.lit(1))

    def order(self, names: Sequence[str]) -> Column:
        o = F.struct(*[F.col(c) for c in names])
        return o if self.cond is None else F.when(self.cond, o)

    def guard(self, agg: Column) -> Column:
        """Null when no row of this filter has the key — as if the input had
        its own join and the key did not match (a count would say 0, a list [])."""
        if self.cond is None or not self.keyed:
            # keyless: one global aggregate either way (count 0, sum null on no rows)
            return agg
        return F.when(F.count(self.one()) > 0, agg)


def _object_fields(inp: Input, source_columns: Sequence[str]) -> tuple[str, ...]:
    """Fields of a list element: the given ones, else every source column."""
    return tuple(inp.fields) if inp.fields else tuple(source_columns)


def _sorted_rows(inp: Input, tmp: str, rows: _Rows, source_columns: Sequence[str]) -> tuple[Column, Column]:
    """(aggregate, post-join array of values) for list forms that need the list itself."""
    objects = inp.list_fn in ("objects", "json")
    value_fields = _object_fields(inp, source_columns) if objects else (inp.field,)
    parts = [F.col(c).alias(f"o{i}") for i, c in enumerate(inp.order_by)]
    parts += [F.col(c).alias(f"v{i}") for i, c in enumerate(value_fields)]
    row = F.struct(*parts)
    if rows.cond is not None:
        row = F.when(rows.cond, row)  # collect_list skips the nulls of other filters
    # structs compare field by field, so sorting them orders by order_by, then values;
    # only the values leave the aggregate
    arr = F.array_sort(F.collect_list(row))
    if objects:
        values = F.transform(arr, lambda x: F.struct(*[x[f"v{i}"].alias(f"v{i}") for i in range(len(value_fields))]))
    else:
        values = F.transform(arr, lambda x: x["v0"])
    return rows.guard(values).alias(tmp), F.col(tmp)


def _aggregates(inp: Input, tmp: str, count_col: str | None, rows: _Rows,
                source_columns: Sequence[str] = ()) -> tuple[list[Column], Column]:
    """Aggregate expressions for one input and its binding over the joined row."""
    f = inp.field
    if inp.kind == "value":
        if inp.on_duplicate == "any":
            return [F.min(rows.col(f)).alias(tmp)], F.col(tmp)
        guarded = F.when(
            F.col(count_col) > 1,
            F.raise_error(F.concat(F.lit(f"lookup {inp.dataset}.{f}: key matches "),
                                   F.col(count_col).cast("string"), F.lit(" rows"))),
        ).otherwise(F.col(tmp))
        return [F.any_value(rows.col(f), True).alias(tmp)], guarded
    if inp.kind == "sum":
        return [rows.guard(F.sum(rows.col(f))).alias(tmp)], F.col(tmp)
    if inp.kind == "avg":
        return [rows.guard(F.avg(rows.col(f))).alias(tmp)], F.col(tmp)
    fn = inp.list_fn
    if isinstance(fn, str) and fn in DECOMPOSABLE_LIST_FNS:
        agg = {
            "count": lambda: F.count(rows.one()),
            "sum": lambda: F.sum(rows.col(f)),
            "avg": lambda: F.avg(rows.col(f)),
            "min": lambda: F.min(rows.col(f)),
            "max": lambda: F.max(rows.col(f)),
            "first": lambda: F.min_by(F.col(f), rows.order(inp.order_by)),
            "last": lambda: F.max_by(F.col(f), rows.order(inp.order_by)),
        }[fn]()
        return [rows.guard(agg).alias(tmp)], F.col(tmp)
    registered = get_list_fn(fn) if isinstance(fn, str) else None
    if registered is not None and registered.agg is not None:
        # a registered function with an aggregate form: combined map-side, no list
        return [rows.guard(registered.agg(rows.col(f))).alias(tmp)], F.col(tmp)
    agg, arr = _sorted_rows(inp, tmp, rows, source_columns)
    if fn == "array":
        return [agg], arr
    if fn == "text":
        return [agg], F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")
    if fn in ("objects", "json"):
        names = list(_object_fields(inp, source_columns))

        def to_map(x: Column) -> Column:
            return F.map_from_arrays(
                F.array(*[F.lit(n) for n in names]),
                F.array(*[x[f"v{i}"].cast("string") for i in range(len(names))]),
            )

        objs = F.transform(arr, to_map)
        return [agg], (objs if fn == "objects" else F.to_json(objs))
    # a registered or given list function over the sorted value array (higher-order functions)
    if registered is not None:
        fn = registered.fn
    return [agg], fn(arr)


def _filtered_source(source: DataFrame, inputs: Sequence[Input]) -> tuple[DataFrame, dict[tuple, _Rows]]:
    """The source restricted to the union of the inputs' filters, and the row
    selector of each filter (no per-aggregate condition when there is one filter)."""
    by_filter: dict[tuple, Column | None] = {}
    for inp in inputs:
        if inp.filter_key not in by_filter:
            by_filter[inp.filter_key] = equality(source, inp.filter)
    conds = list(by_filter.values())
    if len(conds) == 1:
        only = conds[0]
        src = source if only is None else source.where(only)
        return src, {k: _Rows(None) for k in by_filter}
    if any(c is None for c in conds):
        src = source  # one input takes all rows
    else:
        union = conds[0]
        for c in conds[1:]:
            union = union | c
        src = source.where(union)
    return src, {k: _Rows(c) for k, c in by_filter.items()}


def join_group(df: DataFrame, source: DataFrame, inputs: Sequence[Input], spread_by: Sequence[str] = ()) -> Joined:
    """Aggregate ``source`` once for all ``inputs`` (same data set and match) and left-join onto ``df``
    (null match keys are spread by ``spread_by``, see :func:`apportion.operators.keys.join_matches`)."""
    first = inputs[0]
    src, selectors = _filtered_source(source, inputs)
    by_sig: dict[tuple, list[Input]] = {}
    for inp in inputs:
        by_sig.setdefault(input_signature(inp), []).append(inp)

    if not first.on:
        return _scalar_group(df, src, by_sig, selectors)

    count_cols: dict[tuple, str] = {}
    aggs: list[Column] = []
    bindings: dict[tuple, Column] = {}
    temps: list[str] = []
    for sig, group in by_sig.items():
        inp = group[0]
        rows = selectors[inp.filter_key]
        count_col = None
        if inp.kind == "value" and inp.on_duplicate == "error":
            if inp.filter_key not in count_cols:
                count_cols[inp.filter_key] = fresh("n")
                aggs.append(F.count(rows.one()).alias(count_cols[inp.filter_key]))
                temps.append(count_cols[inp.filter_key])
            count_col = count_cols[inp.filter_key]
        tmp = fresh("in")
        exprs, binding = _aggregates(inp, tmp, count_col, rows, source.columns)
        aggs += exprs
        temps.append(tmp)
        bindings[sig] = binding
    keys = [fresh("k") for _ in first.on]
    named = [F.col(r).alias(k) for (_, r), k in zip(first.on, keys)]
    if any(i.hot_keys for i in inputs):
        # Grouped by a struct of the keys, the aggregate is hash-partitioned by
        # that struct, not by the join keys, so the join gets its own shuffle of
        # the (one row per key) right side. With both join inputs plain shuffles,
        # AQE's skew-join handling can split a hot key of the target side over
        # several tasks; reusing the aggregate's partitioning would rule that out.
        packed = fresh("kk")
        right = (src.groupBy(F.struct(*named).alias(packed)).agg(*aggs)
                 .select(*[F.col(packed)[k].alias(k) for k in keys], *[F.col(t) for t in temps]))
    else:
        right = src.groupBy(*named).agg(*aggs)  # the join reuses the aggregate's partitioning
    pairs = [(left, k) for (left, _), k in zip(first.on, keys)]
    out = join_matches(df, right, pairs, spread_by).drop(*keys)
    return Joined(out, bindings, temps)


def _scalar_group(df: DataFrame, src: DataFrame, by_sig: dict[tuple, list[Input]],
                  selectors: dict[tuple, _Rows]) -> Joined:
    """Inputs without match columns: one scalar subquery, no join.

    Sum/avg/decomposable lists aggregate the whole filtered source; a lookup
    must find at most one row (Spark raises on more).
    """
    bindings: dict[tuple, Column] = {}
    aggs: list[Column] = []
    agg_sigs: list[tuple[tuple, str]] = []
    for sig, group in by_sig.items():
        inp = group[0]
        rows = _Rows(selectors[inp.filter_key].cond, keyed=False)
        if inp.kind == "value":
            one = src if rows.cond is None else src.where(rows.cond)
            bindings[sig] = one.select(F.col(inp.field)).scalar()
            continue
        tmp = fresh("in")
        exprs, _ = _aggregates(inp, tmp, None, rows)
        aggs += exprs
        agg_sigs.append((sig, tmp))
    if aggs:
        packed = src.agg(F.struct(*aggs).alias("s")).scalar()
        for sig, tmp in agg_sigs:
            bindings[sig] = packed.getField(tmp)
    return Joined(df, bindings, [])
