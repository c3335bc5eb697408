"""File and table readers. Every reader is lazy; selections and predicates
given here are plain DataFrame operations, so Catalyst pushes them into the
scan (``ReadSchema`` / ``PushedFilters`` in ``explain``)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from apportion.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None,
               where: Column | str | None = None) -> DataFrame:
    """One parquet table ``<base>/<name>.parquet`` with optional projection and predicate."""
    return select_where(spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet"), columns, where)


def read_format(spark: SparkSession, fmt: str, path: str | None = None, columns: Sequence[str] | None = None,
                where: Column | str | None = None, schema: str | None = None, **options: str) -> DataFrame:
    """Any data source by format name (a key-value-store connector where installed,
    parquet/orc/csv otherwise); an empty ``columns`` list means all columns."""
    reader = spark.read.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path) if path else reader.load()
    return select_where(df, columns, where)


def select_where(df: DataFrame, columns: Sequence[str] | None, where: Column | str | None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; pass a schema in production (inference is an extra pass)."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as a single ``value`` column."""
    return spark.read.text(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one that ``spark.checkpoint.dir`` names."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/apportion-scratch/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends there and the rows are fixed."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
