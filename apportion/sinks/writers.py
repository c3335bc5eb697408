"""Writers: JDBC batches, overwrite saves, file dumps, saving changed data sets."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def write_jdbc(df: DataFrame, url: str, table: str, props: Mapping[str, str] | None = None,
               mode: str = "append", batch_size: int = 2000, partitions: int | None = None) -> None:
    """Batched JDBC insert; ``partitions`` caps concurrent connections to the database
    (a shuffle, so the stage that computes the rows keeps its own width)."""
    if partitions:
        df = df.repartition(partitions)
    (df.write.mode(mode).option("batchsize", str(batch_size))
     .jdbc(url, table, properties=dict(props or {})))


def save(df: DataFrame, path: str | None = None, fmt: str = "parquet", mode: str = "overwrite",
         partition_by: Sequence[str] = (), partitions: int | None = None, **options: str) -> None:
    """Save through any data source (never overwrite the path being read), in ``partitions`` parts if given."""
    if partitions:
        df = df.repartition(partitions)
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path) if path else w.save()


def save_changed(frames: Mapping[str, DataFrame], order: Sequence[str], writer,
                 persist: bool = True, reads: Mapping[str, Collection[str]] | None = None) -> list[str]:
    """Write each changed data set once, in order of last change; ``writer(name, df)``.

    A settled frame often feeds a later one (orders feed customers), so with
    ``persist`` every frame to be written is kept (memory, spilling to disk):
    each is computed once, not once per consumer. ``reads`` (see
    :func:`apportion.operators.formula.data_set_reads`) says from which others a
    data set's rows come: a kept frame is then released after its last
    reader's write; without it all are kept until the end. Lost cached blocks are
    recomputed from lineage.
    """
    last = {name: max(n for n, other in enumerate(order) if reads is None or other == name or name in reads.get(other, ()))
            for name in order}
    kept: dict[str, DataFrame] = {}
    if persist:
        for name in order:
            kept[name] = frames[name].persist(StorageLevel.MEMORY_AND_DISK)
    done = []
    try:
        for n, name in enumerate(order):
            writer(name, frames[name])
            done.append(name)
            for over in [k for k in kept if last[k] <= n]:
                kept.pop(over).unpersist()
    finally:
        for df in kept.values():
            df.unpersist()
    return done


#: Columns of a staging table beside the target's: the stored row's key, and 1 for an insert (0: an update).
STAGED_KEY, STAGED_NEW = "STAGED_KEY", "STAGED_NEW"


def merge_statement(table: str, staging: str, updated: Sequence[str], inserted: Sequence[str], pk: str, condition: str = "AND") -> str:
    """The one SQL MERGE that applies a staging table: rows marked new are inserted, the others update the row of their key.

    ``condition`` is the dialect's form of a condition on inserts: ``AND`` (the
    standard's ``WHEN NOT MATCHED AND ..``) or ``WHERE`` (after the values).
    """
    if condition not in ("AND", "WHERE"):
        raise ValueError("condition must be AND or WHERE")
    new, values = ", ".join(inserted), ", ".join(f"s.{c}" for c in inserted)
    text = f"MERGE INTO {table} t USING {staging} s ON (s.{STAGED_NEW} = 0 AND t.{pk} = s.{STAGED_KEY})"
    if updated:
        text += " WHEN MATCHED THEN UPDATE SET " + ", ".join(f"t.{c} = s.{c}" for c in updated)
    if condition == "AND":
        return f"{text} WHEN NOT MATCHED AND s.{STAGED_NEW} = 1 THEN INSERT ({new}) VALUES ({values})"
    return f"{text} WHEN NOT MATCHED THEN INSERT ({new}) VALUES ({values}) WHERE s.{STAGED_NEW} = 1"


def jdbc_merge_writer(url: str, execute: Callable[[str], None], props: Mapping[str, str] | None = None,
                      batch_size: int = 2000, partitions: int | None = None, suffix: str = "_STAGING",
                      types: Mapping[str, str] | None = None, condition: str = "AND"):
    """A ``write(target, inserts, updates)`` callback for :func:`apportion.plans.job.save`.

    Inserts and updates go to one staging table (parallel batches), marked by
    ``STAGED_NEW``, updates with their row's key in ``STAGED_KEY``; then the
    database applies all of them with one MERGE, given to ``execute`` (a
    function of the caller's own database connection). The stored table is
    neither read nor replaced by Spark, and a failure at any point leaves it
    either as it was or with all changes of the data set. ``types`` gives the
    database types of staging columns whose default type cannot be compared (long text keys).
    """

    def write(target, inserts: DataFrame, updates: DataFrame) -> None:
        staging, kind = f"{target.table}{suffix}", updates.schema[target.pk].dataType
        # databases differ in how they take a null of an unknown text type, so an insert has an empty key
        no_key = F.lit("") if isinstance(kind, StringType) else F.lit(0) if isinstance(kind, NumericType) else F.lit(None)
        old = updates.withColumn(STAGED_KEY, F.col(target.pk)).withColumn(STAGED_NEW, F.lit(0))
        if target.pk not in inserts.columns:
            old = old.drop(target.pk)
        rows = old.unionByName(inserts.withColumn(STAGED_KEY, no_key.cast(kind)).withColumn(STAGED_NEW, F.lit(1)))
        own = {**(types or {}), **({STAGED_KEY: types[target.pk]} if target.pk in (types or {}) else {})}
        given = ", ".join(f"{c} {own[c]}" for c in rows.columns if c in own)
        write_jdbc(rows, url, staging, {**(props or {}), **({"createTableColumnTypes": given} if given else {})}, mode="overwrite",
                   batch_size=batch_size, partitions=partitions)
        execute(merge_statement(target.table, staging, [c for c in updates.columns if c != target.pk], inserts.columns, target.pk, condition))

    return write
