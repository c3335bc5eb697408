"""Running rules of a key's ordered rows that split hot keys.

A running rule gives each row the state after its step, in the order of the
key's rows. Steps must come from a family that is closed under
composition (:class:`Steps`): then the steps of a range of rows are one step of
the same family, and a key's rows can lie in many ranges:

1. rows are range-partitioned on (key, order), sorted and *stored* with the
   number of their range, so a row's range and place are data, whatever
   plan or recomputation reads them;
2. each range sends the composed steps of its first and last key, the only
   ones that can cross a border (at most two rows a range reach the driver,
   however many rows a key has);
3. each range runs its rows from the states that its first key brings in. Inside a
   task steps are composed by doubling (1, 2, 4, .. rows at a time) on whole Arrow
   batches, not row by row.

The family given here are clamped linear maps, ``x -> min(max(factor * x + add,
floor), cap)`` with ``factor >= 0``: running sums, carry-over balances with a
floor and a cap, decaying averages, running maxima (``floor`` alone) and resets
(``floor = cap``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.session import ship_package
from apportion.sources.readers import stored

Step = tuple[np.ndarray, ...]

#: Stands for no floor or cap beside whole numbers; states and sums must stay within half of it.
UNBOUNDED = 1 << 62


@dataclass(frozen=True)
class Steps:
    """A family of steps, each a row of ``width`` numbers of one Arrow type.

    ``compose(first, then)`` and ``apply(step, state)`` work on arrays;
    ``compose`` must be associative and agree with ``apply``.
    """

    width: int
    kind: str  # long or double
    compose: Callable[[Step, Step], Step]
    apply: Callable[[Step, np.ndarray], np.ndarray]

    @property
    def dtype(self) -> type:
        return np.int64 if self.kind == "long" else np.float64


def _compose_clamped(first: Step, then: Step) -> Step:
    (f1, a1, low1, high1), (f2, a2, low2, high2) = first, then
    clamp = lambda x: np.minimum(np.maximum(x, low2), high2)
    return f1 * f2, f2 * a1 + a2, clamp(_bounded(f2, low1, a2)), clamp(_bounded(f2, high1, a2))


def _bounded(factor: np.ndarray, bound: np.ndarray, add: np.ndarray) -> np.ndarray:
    if bound.dtype == np.int64:
        return factor * bound + add
    with np.errstate(invalid="ignore"):
        out = factor * bound + add
    return np.where((factor == 0) & np.isinf(bound), add, out)


def _apply_clamped(step: Step, state: np.ndarray) -> np.ndarray:
    factor, add, low, high = step
    return np.minimum(np.maximum(factor * state + add, low), high)


#: ``x -> min(max(factor * x + add, floor), cap)`` on whole numbers (exact; factors 0 and 1) and on doubles.
CLAMPED_LONG = Steps(4, "long", _compose_clamped, _apply_clamped)
CLAMPED_DOUBLE = Steps(4, "double", _compose_clamped, _apply_clamped)


def composed(steps: Step, starts: np.ndarray, family: Steps) -> Step:
    """For each row the composition of its segment's steps up to it; ``starts`` has each row's segment start."""
    n = len(starts)
    here = np.arange(n)
    done, shift = [s.copy() for s in steps], 1
    while shift < n:
        reach = here - shift >= starts
        if not reach.any():
            break
        before = tuple(s[:-shift][reach[shift:]] for s in done)
        own = tuple(s[shift:][reach[shift:]] for s in done)
        place = np.flatnonzero(reach)
        for target, value in zip(done, family.compose(before, own)):
            target[place] = value
        shift *= 2
    return tuple(done)


def _segments(ids: np.ndarray) -> np.ndarray:
    """Each row's first row with the same (range, key), for rows in order."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]).any(1)
    return np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))


_IDS = ["__range", "__k1", "__k2"]


def _arrays(batch: pa.RecordBatch, family: Steps) -> tuple[np.ndarray, Step]:
    ids = np.column_stack([batch.column(c).to_numpy() for c in _IDS])
    return ids, tuple(batch.column(f"__s{i}").to_numpy() for i in range(family.width))


def keyed_fold(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], steps: Sequence[Column],
               family: Steps, start: float = 0, out: str = "state", partitions: int | None = None) -> DataFrame:
    """``df`` with ``out``: the state of the row's key after the row's step, from ``start`` on.

    ``steps`` gives each row's step as ``family.width`` Columns without nulls.
    Rows that ``order`` leaves tied keep one fixed, arbitrary order; null
    keys form a key of their own. ``partitions`` is the number of ranges
    (default: the session's shuffle partitions). Stores its rows in the shared folder when
    it is called.
    """
    ship_package(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [F.col(o) if isinstance(o, str) else o for o in order]
    by = [*[F.col(k).asc_nulls_first() for k in keys], *own]
    named = [F.struct(F.lit(i), F.col(k)) for i, k in enumerate(keys)]  # null and absent keys hash apart
    made = df.select("*", F.xxhash64(*named).alias("__k1"), F.xxhash64(F.lit(1), *named).alias("__k2"),
                     *[s.cast(family.kind).alias(f"__s{i}") for i, s in enumerate(steps)])
    ranged = made.repartitionByRange(n, *by).sortWithinPartitions(*by)
    rows = stored(ranged.withColumn("__range", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "running")

    def in_order(frame: DataFrame) -> DataFrame:
        return frame.repartition("__range").sortWithinPartitions("__range", "__row")

    def ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(range, place, key, step) of the first (0) and last (1) key of each range; one row if they are the same key."""
        found: list[tuple] = []  # [range, k1, k2, step] of the first and the current key

        def flush() -> list[tuple]:
            return [(f[0][0], place, *f[0][1:], *f[1]) for place, f in enumerate(found)]

        for batch in batches:
            ids, step = _arrays(batch, family)
            first = _segments(ids)
            total = composed(step, first, family)
            last = np.append(np.flatnonzero(np.diff(first)), len(ids) - 1)
            emit: list[tuple] = []
            for k in last:
                key, value = tuple(ids[k].tolist()), tuple(t[k : k + 1] for t in total)
                if found and found[-1][0] == key:
                    found[-1] = (key, tuple(v.item() for v in family.compose(tuple(np.array([x], family.dtype) for x in found[-1][1]), value)))
                    continue
                if found and found[0][0][0] != key[0]:
                    emit += flush()
                    found = []
                value = tuple(v.item() for v in value)
                found = [*found[:1], (key, value)]
            if emit:
                yield _ends_batch(emit, family)
        if found:
            yield _ends_batch(flush(), family)

    narrow = in_order(rows.select(*_IDS, "__row", *[f"__s{i}" for i in range(family.width)]))
    schema = "range int, place int, k1 long, k2 long, " + ", ".join(f"s{i} {family.kind}" for i in range(family.width))
    brought = _carried(narrow.mapInArrow(ends, schema).orderBy("range", "place").collect(), family, start)

    columns = df.columns
    names = [*columns, out]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            ids, step = _arrays(batch, family)
            first = _segments(ids)
            states = np.full(len(ids), start, family.dtype)
            opening = tuple(ids[0].tolist()) if len(ids) else None
            leading = first == 0
            if key is not None and opening == key:
                states[leading] = state
            for k in np.flatnonzero(np.append([True], ids[1:, 0] != ids[:-1, 0])) if len(ids) else ():  # a range begins
                if (opened := tuple(ids[k].tolist())) != key and opened in brought:
                    states[first == k] = brought[opened]
            after = family.apply(composed(step, first, family), states)
            if len(ids):
                key, state = tuple(ids[-1].tolist()), after[-1]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(after)], names=names)

    result = df.select("*", F.lit(None).cast(family.kind).alias(out)).schema
    return in_order(rows.select(*df.columns, *_IDS, "__row", *[f"__s{i}" for i in range(family.width)])).mapInArrow(run, result)


def _ends_batch(rows: list[tuple], family: Steps) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.int64() if family.kind == "long" else pa.float64()] * family.width]
    names = ["range", "place", "k1", "k2", *[f"s{i}" for i in range(family.width)]]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _carried(rows: list, family: Steps, start: float) -> dict[tuple, float]:
    """The state with which each range's first key comes in, for keys that earlier ranges hold."""
    brought: dict[tuple, float] = {}
    key, state = None, None
    for r in rows:  # by range, first key before last
        own = (r.k1, r.k2)
        if own == key:
            brought[(r.range, *own)] = state
        before = state if own == key else start
        step = tuple(np.array([r[f"s{i}"]], family.dtype) for i in range(family.width))
        key, state = own, family.apply(step, np.array([before], family.dtype))[0].item()
    return brought


def running_balance(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column | str], add: Column | str,
                    floor: Column | float | None = None, cap: Column | float | None = None, factor: Column | float | None = None,
                    start: float = 0, out: str = "balance", partitions: int | None = None) -> DataFrame:
    """``df`` with the running ``min(max(factor * balance + add, floor), cap)`` of each key.

    Whole-number and decimal ``add`` without ``factor`` are exact: decimals are counted in
    units of their last digit and returned as decimals (within 2 to the power of 61). With a factor, or doubles,
    the balance is a double, and its last digits depend on where ranges begin. A null ``add`` counts as 0; a
    cap below the floor wins.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    amount = F.col(add) if isinstance(add, str) else add
    given = df.select(amount.alias("a")).schema["a"].dataType
    exact = factor is None and given.typeName() not in ("double", "float")
    column = lambda v: v if isinstance(v, Column) else F.lit(v)
    if not exact:
        low, high = F.lit(float("-inf")) if floor is None else column(floor), F.lit(float("inf")) if cap is None else column(cap)
        steps = [column(1.0 if factor is None else factor), F.coalesce(amount.cast("double"), F.lit(0.0)), F.least(low, high), high]
        return keyed_fold(df, keys, order, steps, CLAMPED_DOUBLE, float(start), out, partitions)
    scale = given.scale if given.typeName() == "decimal" else 0
    units = lambda c: (c.cast(f"decimal(38,{scale})") * F.lit(10**scale)).cast("decimal(38,0)").cast("long")
    low = F.lit(-UNBOUNDED) if floor is None else units(column(floor))
    high = F.lit(UNBOUNDED) if cap is None else units(column(cap))
    steps = [F.lit(1), F.coalesce(units(amount), F.lit(0)), F.least(low, high), high]
    got = keyed_fold(df, keys, order, steps, CLAMPED_LONG, int(start * 10**scale), out, partitions)
    if not scale:
        return got
    return got.withColumn(out, (F.col(out).cast("decimal(20,0)") / F.lit(10**scale)).cast(f"decimal(20,{scale})"))
