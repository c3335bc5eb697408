"""Stored tables bucketed by their natural key.

A table saved once in buckets sorted by the key is already dealt out for
joins and groupings on that key: :func:`apportion.sources.load.attach_old_id` and formula
inputs then move the other side alone, whatever the size of the stored one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Save ``df`` as catalog table ``name`` in ``buckets`` buckets sorted by ``keys`` and return it as stored.

    Choose the buckets so that one (of its total size) sorts comfortably in one
    task; joins on the keys run with as many tasks. Each bucket is written by one
    task. With ``path`` the files lie there (a folder shared by all executors) and
    outlive the table's name.
    """
    writer = df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return read_bucketed(df.sparkSession, name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """A bucketed table by its name."""
    return spark.table(name)
