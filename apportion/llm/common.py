"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from apportion.session import ensure_checkpoint_dir, ship_package

T = TypeVar("T")

#: Bytes of text that a worker handles at once (one longer text is handled alone).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names."""
    ship_package(spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark drops a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends there, the files outlive any executor.

    Nothing reads the write's shuffle files again, so they are dropped with it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``budget`` bytes of ``column``: bounds a worker's memory."""
    for batch in batches:
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lens):
            if held and held + n > budget:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lens):
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8 bytes; null reads as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


_KEPT: list[tuple] = []


def kept_in_worker(key: Hashable, build: Callable[[], T]) -> T:
    """What ``build`` made for ``key`` in this worker process: later tasks find it, until another operator keeps its own.

    One thing is kept at a time, so a worker that serves many operators holds
    the tables of the last one only.
    """
    if not _KEPT or _KEPT[0][0] != key:
        _KEPT.clear()
        _KEPT.append((key, build()))
    return _KEPT[0][1]


def tokenizer_folder() -> str:
    """Folder of the public vocabulary files (a parameter of the operators that use one)."""
    return os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
