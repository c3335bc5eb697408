"""Stored tables of which a change rewrites only a part.

The rows lie in folders by a hash of their primary key
(``bucket=<n>``). Updates rewrite the folders they fall into, with Spark's dynamic
partition overwrite; inserts are added as new files. Folders without updates keep
their files, so a save costs what it touches and not the whole table.

A folder is replaced when the job commits, after all its files are written, and the
updates are in place before the inserts are added. A job that dies in between
can run again: updates set the same values, and with ``OLD_ID`` attached anew
stored inserts are updates. DataFrames read before a save list files that may be gone: read again after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from apportion.sinks.upsert import merge_changes, tag_changes
from apportion.sources.readers import stored as stored_rows

BUCKET = "bucket"


def _bucket(pk: Column, others: Sequence[Column], buckets: int) -> Column:
    """The folder of a key; rows without one are spread by a hash of the row."""
    return F.pmod(F.when(pk.isNotNull(), F.xxhash64(pk)).otherwise(F.xxhash64(*others) if others else F.lit(0)), F.lit(buckets)).cast("int")


def _in_folders(df: DataFrame, pk: str, buckets: int) -> DataFrame:
    if BUCKET in df.columns:
        raise ValueError(f"the column name {BUCKET!r} is taken")
    return df.withColumn(BUCKET, _bucket(F.col(pk), [F.col(c) for c, t in df.dtypes if c != pk and not t.startswith(("map", "variant"))], buckets))


def create_stored(df: DataFrame, path: str, pk: str, buckets: int) -> None:
    """Store ``df`` in ``buckets`` folders, each written by one task; the path must not exist."""
    _in_folders(df, pk, buckets).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def read_stored(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a stored table; a table without rows has no files to tell its columns, so give its ``schema``."""
    reader = spark.read if schema is None else spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())]))
    return reader.parquet(path).drop(BUCKET)


def save_changes(changed: DataFrame, path: str, mapping: Mapping[str, str], pk: str, buckets: int, old_id: str = "OLD_ID",
                 dates: Sequence[str] = (), schema: StructType | None = None) -> list[int]:
    """Apply ``changed`` (see :func:`apportion.sinks.upsert.tag_changes`) to a stored table; returns the folders rewritten.

    ``buckets`` is that of :func:`create_stored`. Only the rows of folders with
    updates are read, joined and written. The driver gets the numbers of these
    folders, at most ``buckets``. The changes are written to the shared scratch folder
    first: they may have read the stored table, whose files go.
    """
    spark = changed.sparkSession
    changed = stored_rows(changed.select(old_id, *[c for c in mapping if c != old_id]), "changes")
    schema = schema or read_stored(spark, path).schema
    stored = spark.read.schema(StructType([*schema.fields, StructField(BUCKET, IntegerType())])).parquet(path)
    updates = changed.where(F.col(old_id).isNotNull())
    touched = sorted(r.b for r in updates.select(_bucket(F.col(old_id).cast(schema[pk].dataType), [], buckets).alias("b")).distinct().collect())
    if touched:
        here = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = merge_changes(here, updates, mapping, pk, old_id, dates)
        (_in_folders(merged, pk, buckets).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(path))
    tagged = tag_changes(changed.where(F.col(old_id).isNull()), mapping, pk, old_id, dates, action="__action")
    inserts = tagged.select(*[(F.col(f.name) if f.name in tagged.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    _in_folders(inserts, pk, buckets).repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path)
    return touched
