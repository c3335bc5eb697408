"""Helpers of the operators on embeddings: scaled integer vectors, sums over all rows, replaced tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A scaled component beyond this (either sign) raises: squared distances and their sums must fit 64 bits.
LIMIT = 1 << 26


def scaled(vectors: DataFrame, scale: int = 256) -> tuple[DataFrame, int]:
    """(vec_id, label, x) with ``x = floor(scale * component)`` as long, and the width of ``x``.

    Vectors that are null or empty or hold null or non-finite components are
    dropped, and so are those that do not have the commonest length of the
    rest (of equally common ones the larger). A table without ``label`` gets a
    null one. The width of a table without vectors is 0.
    """
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    label: Column = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    rows = vectors.where(v.isNotNull() & finite & (F.size(v) > 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.transform(v, lambda c: F.floor(c * scale)).alias("x"))
    most = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if most is None:
        return rows, 0
    beyond = F.exists("x", lambda c: (c > LIMIT) | (c < -LIMIT))
    raised = F.raise_error(F.concat(F.lit("a component is too large, vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    x = F.when(beyond, raised.cast("array<bigint>")).otherwise(F.col("x"))
    return rows.where(F.size("x") == most.width).withColumn("x", x), most.width


def matrix(column: pa.Array, width: int, dtype: type = np.int64) -> np.ndarray:
    """An Arrow column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as an Arrow column of equally long lists."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.array(values.reshape(-1)))


def summed(df: DataFrame, add: Callable[[pa.RecordBatch, np.ndarray], None], length: int, dtype: type = np.int64) -> np.ndarray:
    """The sum over all batches of what ``add(batch, total)`` adds to a vector of ``length``.

    A partition sends one row per position, Spark adds them up, and ``length``
    numbers reach the driver, however large the table is.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, dtype)
        for batch in batches:
            add(batch, total)
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "v"])

    kind = "long" if dtype is np.int64 else "double"
    out = np.zeros(length, dtype)
    for r in df.mapInArrow(partial, f"place long, v {kind}").groupBy("place").agg(F.sum("v").alias("v")).collect():
        out[r.place] = r.v
    return out


def drop_written(df: DataFrame) -> None:
    """Remove the files of a table of :func:`apportion.llm.common.written` that a later table has replaced."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
