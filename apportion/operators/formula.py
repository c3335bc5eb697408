"""Formula evaluation: conditional column updates over one DataFrame plan.

``apply_formula`` threads one frame through the formula's items. Each item

1. binds its inputs — same-row columns for self lookups, otherwise a column
   of an aggregate-then-left-join (see :mod:`apportion.operators.inputs`),
   shared by every input with the same (data set, match, filter);
2. evaluates its expression (Spark SQL or a Column callable);
3. sets ``field = CASE WHEN <formula filter> THEN coalesce(result, field) ELSE field END``.

There are no row-id joins: values are added as columns of the same frame,
so the whole settlement is one lazy plan and Catalyst prunes, pushes
filters and fuses the projections into whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Container, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apportion.functions.filters import equality
from apportion.operators.inputs import fresh, input_signature, join_group
from apportion.specs import Formula, Input, Item

_REF = re.compile(r"\$([A-Za-z_][A-Za-z0-9_]*)")


def _is_self_value(inp: Input, target: str) -> bool:
    return inp.dataset == target and inp.kind == "value"


def _bind_sql(expr: str, names: Mapping[str, str]) -> str:
    def sub(m: re.Match) -> str:
        name = m.group(1)
        if name not in names:
            raise KeyError(f"expression refers to unknown input ${name}; inputs: {sorted(names)}")
        return names[name]

    return _REF.sub(sub, expr)


def _item_column(item: Item, bound: Mapping[str, Column]) -> Column:
    if callable(item.expr):
        return item.expr(bound)
    # bind each $name to a projected temp column; evaluate as Spark SQL
    return F.expr(_bind_sql(item.expr, {n: f"`__b_{n}`" for n in bound}))


def _default_literal(value: float, dtype: T.DataType) -> Column:
    """The default of an unmatched input, typed like the source field so a
    decimal stays exact (0.0 next to a decimal sum would make it a double)."""
    if isinstance(dtype, T.DecimalType):
        return F.lit(Decimal(str(value)))
    if isinstance(dtype, T.IntegralType) and float(value).is_integer():
        return F.lit(int(value))
    return F.lit(float(value))


def apply_item(df: DataFrame, item: Item, bound: Mapping[str, Column], cond: Column | None) -> DataFrame:
    """Set ``item.field`` from the bound inputs for rows where ``cond`` holds.

    A null result keeps the old value; rows outside ``cond`` are untouched.
    """
    if item.field not in df.columns:
        raise KeyError(f"result column {item.field!r} is not in the data set (add it with add_result_columns)")
    dtype = df.schema[item.field].dataType
    if not callable(item.expr) and bound:
        df = df.select("*", *[c.alias(f"__b_{n}") for n, c in bound.items()])
    value = F.coalesce(_item_column(item, bound).cast(dtype), F.col(item.field))
    if cond is not None:
        value = F.when(cond, value).otherwise(F.col(item.field))
    df = df.withColumn(item.field, value)
    if not callable(item.expr) and bound:
        df = df.drop(*[f"__b_{n}" for n in bound])
    return df


@dataclass
class _Carried:
    """A target frame between formulas: with the joined columns that later formulas use again.

    ``live`` maps (data set, match) to the bindings (by signature) that still hold;
    ``temps`` are the columns behind them, which no one else sees.
    """

    df: DataFrame
    live: dict[tuple, dict[tuple, Column]] = field(default_factory=dict)
    temps: list[str] = field(default_factory=list)


def _stale(inp: Input, written: set[str]) -> bool:
    """Whether the input's value changes when these columns of its data set do."""
    if inp.kind == "list" and inp.list_fn in ("objects", "json") and not inp.fields:
        return bool(written)  # reads every column
    reads = {inp.field, *inp.order_by, *inp.fields, *(c for c, _ in inp.filter), *(right for _, right in inp.on)}
    return bool(reads & written)


def _wanted(key: tuple, formula: Formula, idx: int, later: Sequence[Formula], have: Container[tuple]) -> list[Input]:
    """The inputs that one join for ``key`` (data set, match) serves from item ``idx`` of ``formula`` on: those of
    the later items and formulas of the same target, as long as nothing they read has been written by then.

    A formula of which one input must be joined anew takes them all from that join: serving the others here would
    keep two states of the source in the plan for nothing.
    """
    dataset, on = key
    left = {a for a, _ in on}
    found: list[Input] = []
    written: set[str] = set()  # columns of the source
    for f, items in [(formula, formula.items[idx:])] + [(f, f.items) for f in later]:
        if f.dataset == dataset != formula.dataset:
            written |= {item.field for item in items}
        if f.dataset != formula.dataset:
            continue
        if any(i.group_key == key and _stale(i, written) for item in items for i in item.inputs):
            return found
        for item in items:
            found += [i for i in item.inputs if not _is_self_value(i, formula.dataset) and i.group_key == key and input_signature(i) not in have]
            if dataset == formula.dataset or item.field in left:
                return found
    return found


def _spread(df: DataFrame, formulas: Sequence[Formula], written: Container[str] = ()) -> list[str]:
    """What tells rows of a target with a null match key apart: its first column and those that its formulas use anyway.

    Without the ``written`` ones these are the same values for every formula of a chain, so a later join by
    the same match finds the rows dealt as it needs them.
    """
    target = formulas[0].dataset
    names = [df.columns[0], *(c for f in formulas for c, _ in f.filter)]
    for item in (item for f in formulas for item in f.items):
        names += [item.field, *(left for i in item.inputs for left, _ in i.on), *(i.field for i in item.inputs if _is_self_value(i, target))]
    return [c for c in dict.fromkeys(names) if c not in written] or names[:1]


def _apply(frames: Mapping[str, DataFrame], formula: Formula, later: Sequence[Formula], carried: dict[str, _Carried],
           spread: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Apply one formula; ``later`` are formulas whose inputs may share its joins, ``carried`` is brought up to date."""
    target = formula.dataset
    if target not in frames:
        raise KeyError(f"formula {formula.name!r}: unknown data set {target!r}")
    state = carried.pop(target, None) or _Carried(frames[target])
    df, live, joins = state.df, state.live, state.temps
    temps: list[str] = []
    read = spread[target] if target in spread else _spread(df, [formula])

    cond = equality(df, formula.filter)
    written = {it.field for it in formula.items}
    if cond is not None and written & {c for c, _ in formula.filter}:
        # the filtered set is fixed when the formula starts
        cname = fresh("cond")
        df = df.withColumn(cname, cond)
        cond = F.col(cname)
        temps.append(cname)

    # (data set, match) -> (signature -> binding); groups become stale when an item
    # rewrites one of their target-side match columns, or (self aggregates)
    # any column of the target.
    for idx, item in enumerate(formula.items):
        bound: dict[str, Column] = {}
        for inp in item.inputs:
            if _is_self_value(inp, target):
                # self lookup: the current row's value (an earlier item's result included)
                c = F.col(inp.field)
            else:
                key, signature = inp.group_key, input_signature(inp)
                if signature not in live.get(key, {}):
                    if inp.dataset == target:
                        source = df.drop(*temps, *joins)
                    else:
                        if inp.dataset not in frames:
                            raise KeyError(f"formula {formula.name!r}: unknown data set {inp.dataset!r}")
                        source = frames[inp.dataset]
                    joined = join_group(df, source, _wanted(key, formula, idx, later, live.get(key, {})), read)
                    df = joined.df
                    joins += joined.temps
                    live.setdefault(key, {}).update(joined.bindings)
                c = live[key][signature]
            if inp.default is not None:
                source = df if inp.dataset == target else frames[inp.dataset]
                c = F.coalesce(c, _default_literal(inp.default, source.schema[inp.field].dataType))
            # an input is evaluated (and a lookup's guard raises) only for the formula's rows
            bound[inp.name] = c if cond is None else F.when(cond, c)
        df = apply_item(df, item, bound, cond)
        for key in list(live):
            ds, on = key
            if ds == target or item.field in {left for left, _ in on}:
                del live[key]

    if temps:
        df = df.drop(*temps)
    # what other targets keep of this data set ends where the formula wrote
    for other in carried.values():
        for key, bindings in other.live.items():
            if key[0] == target:
                held = {s for f in later if f.dataset != target for i in _inputs(f) if i.group_key == key and not _stale(i, written) for s in [input_signature(i)]}
                other.live[key] = {s: b for s, b in bindings.items() if s in held}
    if any(live.values()) and any(f.dataset == target for f in later):
        carried[target] = _Carried(df, live, joins)
    return {**frames, target: df.drop(*joins) if joins else df}


def _inputs(formula: Formula) -> list[Input]:
    return [i for item in formula.items for i in item.inputs]


def apply_formula(frames: Mapping[str, DataFrame], formula: Formula) -> dict[str, DataFrame]:
    """Apply one formula; returns a new registry with the target frame replaced."""
    return _apply(frames, formula, (), {}, {})


def settle(frames: Mapping[str, DataFrame], formulas: Iterable[Formula],
           checkpoint_every: int | None = None, share: bool = True) -> dict[str, DataFrame]:
    """Apply formulas in order, each seeing the results of the earlier ones.

    With ``share`` formulas of one target that take inputs from the same data
    set by the same match also share one aggregate and one join, until a
    formula between them writes a column that an input reads (or the match
    columns of the target): from there on that input is joined anew.

    ``checkpoint_every=n`` cuts the lineage of a changed frame every n
    formulas with a reliable checkpoint (into ``spark.checkpoint.dir``) so a
    long chain neither grows the plan without bound nor is lost with an
    executor; nothing is shared across a checkpoint.
    """
    out, formulas = dict(frames), list(formulas)
    carried: dict[str, _Carried] = {}
    spread: dict[str, list[str]] = {}
    for target in {f.dataset for f in formulas if share and f.dataset in out}:
        own = [f for f in formulas if f.dataset == target]
        spread[target] = _spread(out[target], own, {item.field for f in own for item in f.items})
    for n, formula in enumerate(formulas, start=1):
        end = len(formulas) if not checkpoint_every else -(-n // checkpoint_every) * checkpoint_every
        out = _apply(out, formula, formulas[n:end] if share else (), carried, spread)
        if checkpoint_every and n % checkpoint_every == 0:
            out[formula.dataset] = out[formula.dataset].checkpoint(eager=True)
            carried.clear()
    return out


def data_set_reads(formulas: Sequence[Formula]) -> dict[str, set[str]]:
    """For each changed data set the others its rows come from, directly or through others."""
    reads: dict[str, set[str]] = {}
    for f in formulas:
        now = reads.setdefault(f.dataset, set())
        for i in _inputs(f):
            now |= {i.dataset, *reads.get(i.dataset, ())}
        now.discard(f.dataset)
    return reads


def changed_datasets(formulas: Sequence[Formula]) -> list[str]:
    """Names of the changed data sets, each once, in order of its last change."""
    order: list[str] = []
    for f in formulas:
        if f.dataset in order:
            order.remove(f.dataset)
        order.append(f.dataset)
    return order


def add_result_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add empty result columns: numbers start at 0 (the load rule for empty
    NUMBER fields), other types at null."""
    numeric = ("double", "float", "decimal", "bigint", "int", "long", "smallint", "tinyint")
    adds = []
    for name, dtype in columns.items():
        start = F.lit(0) if dtype.split("(")[0] in numeric else F.lit(None)
        adds.append(start.cast(dtype).alias(name))
    return df.select("*", *adds)
