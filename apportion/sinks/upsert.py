"""Insert-or-update of changed rows.

A changed row whose stored id (``OLD_ID``) is null is an insert, otherwise an
update of the stored row with that primary key. Only mapped columns are
written; DATE columns travel as ``yyyyMMddHHmmss`` text and are turned back
into timestamps here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.functions.scalar import text_to_ts
from apportion.operators.keys import join_matches


def _mapped(df: DataFrame, mapping: Mapping[str, str], dates: Sequence[str]) -> list:
    cols = []
    for src, dst in mapping.items():
        c = F.col(src)
        if src in dates:
            c = text_to_ts(c)
        cols.append(c.alias(dst))
    return cols


def split_changes(changed: DataFrame, mapping: Mapping[str, str], pk: str, old_id: str = "OLD_ID",
                  dates: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(inserts, updates): inserts carry all mapped columns; updates carry the
    mapped columns but the primary key, plus the key taken from ``old_id``."""
    inserts = changed.where(F.col(old_id).isNull()).select(*_mapped(changed, mapping, dates))
    upd_map = {s: d for s, d in mapping.items() if d != pk}
    updates = changed.where(F.col(old_id).isNotNull()).select(
        F.col(old_id).alias(pk), *_mapped(changed, upd_map, dates))
    return inserts, updates


def merge_frame(target: DataFrame, inserts: DataFrame, updates: DataFrame, pk: str) -> DataFrame:
    """The target after the changes: untouched rows, updated rows (unmapped
    columns kept from the stored row), inserted rows. For plain files, which
    have no MERGE; tables with MERGE support take ``inserts``/``updates`` directly."""
    upd_cols = set(updates.columns)
    kept = target.join(updates.select(pk), pk, "left_anti")
    stored_rest = [c for c in target.columns if c not in upd_cols]
    upd_full = updates.join(target.select(pk, *stored_rest), pk, "inner") if stored_rest else updates
    return (kept.unionByName(upd_full.select(*target.columns))
            .unionByName(inserts.select(*[F.col(c) if c in inserts.columns else F.lit(None).alias(c)
                                          for c in target.columns])))


def tag_changes(changed: DataFrame, mapping: Mapping[str, str], pk: str, old_id: str = "OLD_ID",
                dates: Sequence[str] = (), action: str = "action") -> DataFrame:
    """Inserts and updates in one pass: ``action`` ('insert'/'update') plus the
    mapped columns; an update's primary key comes from ``old_id``, an insert's
    from its mapped key column (null when the key is generated by the store)."""
    is_new = F.col(old_id).isNull()
    cols = [F.when(is_new, F.lit("insert")).otherwise(F.lit("update")).alias(action)]
    mapped = dict(zip(mapping.values(), _mapped(changed, mapping, dates)))
    pk_new = F.col(next(s for s, d in mapping.items() if d == pk)) if pk in mapped else F.lit(None)
    cols.append(F.when(is_new, pk_new).otherwise(F.col(old_id)).alias(pk))
    for src, dst in mapping.items():
        if dst != pk:
            c = F.col(src)
            cols.append((text_to_ts(c) if src in dates else c).alias(dst))
    return changed.select(*cols)


def merge_changes(stored: DataFrame, changed: DataFrame, mapping: Mapping[str, str], pk: str,
                  old_id: str = "OLD_ID", dates: Sequence[str] = ()) -> DataFrame:
    """The stored table after the changes: one left join with the updates, and the inserts appended as they lie.

    Stored rows without a change stay, updated rows take the mapped columns
    from the change (unmapped columns from the stored row). Updates of one
    stored row are counted per key; several raise when it is evaluated. An
    update of a row that is not stored changes nothing. Inserts are neither
    shuffled nor aggregated, so keys that the store makes later (null here) gather nowhere.
    """
    tagged = tag_changes(changed, mapping, pk, old_id, dates, action="__action")
    new = {c: f"__new_{c}" for c in tagged.columns if c != "__action"}
    updates = (tagged.where(F.col("__action") == "update").select(*[F.col(c).alias(n) for c, n in new.items()])
               .groupBy(new[pk]).agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*new.values())).alias("__row")))
    j = join_matches(stored, updates, [(pk, new[pk])])
    several = F.raise_error(F.concat(F.lit("several changes of one stored row: "), F.col(new[pk]).cast("string")))
    changes = F.when(F.col("__n") > 1, several.cast("boolean")).otherwise(F.col("__n").isNotNull())
    types = {f.name: f.dataType for f in stored.schema.fields}  # a change never alters a stored column's type
    kept = j.select(*[F.when(changes, F.col("__row")[new[c]].cast(types[c])).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
                      for c in stored.columns])
    inserts = tagged.where(F.col("__action") == "insert")
    return kept.unionByName(inserts.select(*[(F.col(c) if c in new else F.lit(None)).cast(types[c]).alias(c) for c in stored.columns]))
