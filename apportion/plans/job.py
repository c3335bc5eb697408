"""The whole settlement job: load data sets, apply formulas in order, save changes.

This is the user-level flow of the reference's session (configure with
parameters and formula ids, then submit), written as a composition of the
library's lazy operators:

1. each data set runs its SQL with bound parameters over the given tables;
2. when it has a stored target and key fields, the stored row's primary key
   is attached as ``OLD_ID`` (null = new row; a key that matches several
   stored rows raises when it is evaluated);
3. fields are renamed and typed (numbers double with null -> 0.0, dates as
   ``yyyyMMddHHmmss`` text) in one projection;
4. formulas are applied in order (:func:`apportion.operators.formula.settle`);
5. each changed data set with a target is split into inserts and updates over
   its mapped fields and handed to the writer once, in order of last change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from apportion.operators.formula import changed_datasets, data_set_reads, settle
from apportion.sinks.upsert import split_changes
from apportion.sinks.writers import save_changed
from apportion.sources.load import DATE, Field, attach_old_id, normalise, run_script
from apportion.specs import Formula

OLD_ID = "OLD_ID"


@dataclass(frozen=True)
class Target:
    """Stored table of a data set: name, primary key and field -> column mapping."""

    table: str
    pk: str
    columns: Mapping[str, str] = field(default_factory=dict)  # engine field name -> stored column


@dataclass(frozen=True)
class DataSet:
    """A named data set: SQL text (``{table}`` frames, ``:param`` values), fields, optional target."""

    name: str
    sql: str
    fields: tuple[Field, ...]
    target: Target | None = None

    def __post_init__(self) -> None:
        names = [f.out for f in self.fields]
        if len(names) != len(set(names)):
            raise ValueError(f"data set {self.name!r}: duplicate field names {names}")
        if self.target is not None:
            keys = [f for f in self.fields if f.is_key]
            if not keys:
                raise ValueError(f"data set {self.name!r}: a stored target needs key fields")
            unknown = set(self.target.columns) - set(names)
            if unknown:
                raise ValueError(f"data set {self.name!r}: target mapping names unknown fields {sorted(unknown)}")
            missing = [f.out for f in keys if f.out not in self.target.columns]
            if missing:
                raise ValueError(f"data set {self.name!r}: key fields {missing} have no stored column")


def load(spark: SparkSession, ds: DataSet, params: Mapping[str, Any], tables: Mapping[str, DataFrame],
         stored: DataFrame | None = None, raw: Mapping[str, str] | None = None,
         allowed_raw: Iterable[str] = ()) -> DataFrame:
    """One data set as a typed DataFrame (steps 1-3)."""
    src = run_script(spark, ds.sql, params, raw, allowed_raw, **tables)
    extra: list[str] = []
    if ds.target is not None and stored is not None:
        keys = {f.source: ds.target.columns[f.out] for f in ds.fields if f.is_key}
        src = attach_old_id(src, stored, keys, ds.target.pk, out=OLD_ID)
        extra = [OLD_ID]
    return normalise(src, ds.fields, row_id="row_id", extra=extra)


@dataclass
class SettlementResult:
    frames: dict[str, DataFrame]
    changed: list[str]
    reads: dict[str, set[str]] | None = None  # data sets that each changed one's rows come from


def run(spark: SparkSession, datasets: Sequence[DataSet], formulas: Sequence[Formula],
        params: Mapping[str, Any], tables: Mapping[str, DataFrame],
        read_stored: Callable[[str], DataFrame] | None = None,
        checkpoint_every: int | None = None, raw: Mapping[str, str] | None = None,
        allowed_raw: Iterable[str] = ()) -> SettlementResult:
    """Load every data set and apply the formulas in order (lazy until saved)."""
    frames = {}
    for ds in datasets:
        stored = read_stored(ds.target.table) if (ds.target is not None and read_stored) else None
        frames[ds.name] = load(spark, ds, params, tables, stored, raw, allowed_raw)
    out = settle(frames, formulas, checkpoint_every=checkpoint_every)
    return SettlementResult(out, changed_datasets(list(formulas)), data_set_reads(formulas))


def save(result: SettlementResult, datasets: Sequence[DataSet],
         write: Callable[[Target, DataFrame, DataFrame], None]) -> list[str]:
    """Split each changed data set with a target into (inserts, updates) and call
    ``write(target, inserts, updates)`` once per data set, in order of last change.
    A frame that feeds later ones is kept until the last of them is written (it is
    computed once)."""
    by_name = {d.name: d for d in datasets}
    todo = [n for n in result.changed if by_name.get(n) is not None and by_name[n].target is not None]

    def write_one(name: str, frame: DataFrame) -> None:
        ds = by_name[name]
        dates = [f.out for f in ds.fields if f.type == DATE]
        write(ds.target, *split_changes(frame, ds.target.columns, ds.target.pk, old_id=OLD_ID, dates=dates))

    return save_changed(result.frames, todo, write_one, reads=result.reads)
