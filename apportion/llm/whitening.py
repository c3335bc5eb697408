"""Embedding whitening by incremental eigendecomposition.

The fit list holds each distinct integer vector (:func:`apportion.llm.vectors.scaled`)
once. Its rows are dealt to parts of a few thousand by hash; a part keeps the
decomposition of its centred scatter and changes it with each row by a
rank-one update (:mod:`apportion.llm.eigen_updates`). Parts are combined in a
tree, 32 at a time, by one update for each eigenvector of the smaller one.
A last pass over the fit list projects the exactly centred rows on the basis
found and diagonalises the covariance of the projections (Rayleigh-Ritz),
which leaves components to double precision whatever the order of the
updates was.

Count and sums of the fit list are exact integers. The driver gets one
decomposition and a few matrices of the vectors' width, nothing that grows with
the rows. Rows that occur more than once weigh once in the fit and each get
their result; null ids are kept. Components without variance are left out,
so one distinct vector has none. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import written
from apportion.llm.eigen_updates import Spectrum
from apportion.llm.vectors import lists, matrix, scaled, summed

#: Distinct vectors of a part, and parts that are combined at a time.
PART, FAN_IN = 4096, 32
#: A component whose share of the variance is below this has none.
LEAST_SHARE = 1e-12

_SPECTRUM = "part long, n long, mean array<double>, values array<double>, vectors array<double>"


@dataclass(frozen=True)
class Whitening:
    """The fitted map: rows ``x`` become ``(x - sums / n) @ components / sqrt(eigenvalues)``."""

    n: int
    sums: np.ndarray
    components: np.ndarray  # columns, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    identity_error: float
    scale: int = 256

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact."""
        return self.n * x - self.sums

    def transform(self, vectors: DataFrame) -> DataFrame:
        """(vec_id, deviation, whitened): exact squared distance from the mean times n squared
        (null beyond 64 bits), and one number per component."""
        rows, width = scaled(vectors, self.scale)
        turn = self.components / np.sqrt(self.eigenvalues)

        def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                off = self.centred(matrix(batch.column("x"), width))
                if len(off) and float(np.abs(off).max()) ** 2 * width >= 2**63:
                    totals = (off.astype(object) ** 2).sum(1)
                    deviation = pa.array([int(t) if t < 2**63 else None for t in totals], pa.int64())
                else:
                    deviation = pa.array((off * off).sum(1))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, lists(off / self.n @ turn)], names=["vec_id", "deviation", "whitened"])

        return rows.select("vec_id", "x").mapInArrow(apply, "vec_id long, deviation long, whitened array<double>")


def _row(part: int, s: Spectrum) -> dict:
    return {"part": [part], "n": [s.n], "mean": [s.mean.tolist()], "values": [s.values.tolist()], "vectors": [s.vectors.reshape(-1).tolist()]}


def _spectrum(row: dict) -> Spectrum:
    values = np.array(row["values"])
    return Spectrum(row["n"], np.array(row["mean"]), values, np.array(row["vectors"]).reshape(len(values), -1))


def spectrum(fit: DataFrame, n: int, width: int) -> Spectrum:
    """The spectrum of the fit list's scatter: rank-one updates within parts, then a tree of merges."""
    parts = -(-n // PART)
    schema = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("values", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64()))])

    def update(key: tuple, rows: pa.Table) -> pa.Table:
        x = matrix(rows.column("x").combine_chunks(), width, np.float64)
        return pa.Table.from_pydict(_row(key[0].as_py(), Spectrum.empty(width).with_rows(x)), schema)

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        found = [_spectrum(r) for r in sorted(rows.to_pylist(), key=lambda r: r["part"])]
        total = found[0]
        for other in found[1:]:
            total = total.merged(other)
        return pa.Table.from_pydict(_row(key[0].as_py(), total), schema)

    dealt = fit.select("x", F.pmod(F.xxhash64("x"), F.lit(parts)).alias("dealt"))
    partial = dealt.groupBy("dealt").applyInArrow(update, _SPECTRUM)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        partial = partial.withColumn("dealt", F.floor(F.col("part") / FAN_IN)).groupBy("dealt").applyInArrow(merge, _SPECTRUM)
    return _spectrum(partial.collect()[0].asDict())


def fit_whitening(vectors: DataFrame, components: int = 4, scale: int = 256) -> Whitening | None:
    """The whitening of the distinct vectors onto the ``components`` directions of largest variance; None without vectors."""
    rows, width = scaled(vectors, scale)
    if not width:
        return None
    fit = written(rows.select(F.col("x").cast("array<int>").alias("x")).distinct(), "fit-list")

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        total[0] += batch.num_rows
        total[1:] += matrix(batch.column("x"), width).sum(0)

    counted = summed(fit, count, width + 1)
    n, sums = int(counted[0]), counted[1:]
    basis = spectrum(fit, n, width).vectors

    def project(turn: np.ndarray):
        def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
            p = (n * matrix(batch.column("x"), width) - sums) / n @ turn
            total += (p.T @ p).reshape(-1)

        return summed(fit, add, turn.shape[1] ** 2, np.float64).reshape(turn.shape[1], -1) / n

    ritz = project(basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    trace = float(values.sum())
    top = np.argsort(-values, kind="stable")[:components]
    top = top[values[top] > LEAST_SHARE * trace]
    found = basis @ turn[:, top]
    found /= np.sqrt((found**2).sum(0))
    largest = np.abs(found).argmax(0)
    found = found * np.sign(found[largest, np.arange(len(top))])  # the largest entry is positive
    error = float(np.abs(project(found / np.sqrt(values[top])) - np.eye(len(top))).max()) if len(top) else 0.0
    return Whitening(n, sums, found, values[top], trace, error, scale)


def whitened_components(vectors: DataFrame, components: int = 4) -> DataFrame:
    """One row per vector and component (from 1): the contract of the query ``op12_eigen_whitening``."""
    fitted = fit_whitening(vectors, components)
    columns = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fitted is None or not len(fitted.eigenvalues):
        return vectors.sparkSession.createDataFrame([], columns)
    shares = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues])
    each = fitted.transform(vectors).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return each.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("k") + 1).alias("explained"), F.lit(fitted.identity_error).alias("identity_error"))
