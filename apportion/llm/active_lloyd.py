"""Vector codes by Lloyd rounds that only look at the entries that moved.

Vectors of integers are cut into equal consecutive parts, and each part
position has a codebook, which starts as that part of the first rows by
vec_id (of equal ids the smaller vector; null ids last). A round assigns every part to the nearest entry
(squared Euclidean distance, ties to the lower index) and replaces each entry
that has parts by the floor of their mean.

The state of a part (its entry and exact distance) is stored between rounds.
A part whose entry did not move since it was assigned keeps its distance, and
the other entries that did not move either cannot beat it, so it is compared
with the moved entries alone. A part whose entry moved is compared with
all. Both give the entry a full search gives, ties included.

All arithmetic is on 64-bit integers, so results do not depend on partitions.
Each partition sends one row per entry and component; the driver
holds the codebooks only. Repeated rows count as often as they occur, null ids
and labels are kept, fewer rows than entries make a smaller codebook, an
empty table gives no rows. Which vectors take part: :func:`apportion.llm.vectors.scaled`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import written
from apportion.llm.vectors import drop_written, lists, matrix, scaled, summed


@dataclass(frozen=True)
class VectorCodes:
    """``codes`` (vec_id, label, code, error, compared) and the codebooks (part, entry, component).

    ``code`` is binary, one byte per part; ``compared`` counts the entries that
    the row's parts were compared with in all rounds.
    """

    codes: DataFrame
    books: np.ndarray

    def decoded(self) -> DataFrame:
        """(vec_id, x): the vectors that the codes stand for."""
        books = self.books

        def rebuild(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code = _codes(batch.column("code"), len(books))
                x = books[np.arange(len(books)), code].reshape(len(code), -1)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists(x)], names=["vec_id", "x"])

        return self.codes.select("vec_id", "code").mapInArrow(rebuild, "vec_id long, x array<bigint>")

    def books_sha256(self) -> str:
        """SHA-256 of all entries' components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index (the lowest of equally near ones) and squared distance of each row's nearest entry."""
    d = (book * book).sum(1) - 2 * (x @ book.T)
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code] + (x * x).sum(1)


def active_entries(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, error, entries compared) after ``book`` changed at the ``moved`` entries.

    ``code`` and ``error`` are right for the book before.
    """
    code, error = code.copy(), error.copy()
    stayed, entries = ~moved[code], np.flatnonzero(moved)
    if len(entries) and stayed.any():
        best, d = nearest_entries(x[stayed], book[entries])
        best = entries[best]
        take = (d < error[stayed]) | ((d == error[stayed]) & (best < code[stayed]))
        code[stayed] = np.where(take, best, code[stayed])
        error[stayed] = np.where(take, d, error[stayed])
    if not stayed.all():
        code[~stayed], error[~stayed] = nearest_entries(x[~stayed], book)
    return code, error, np.where(stayed, len(entries), len(book))


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray | None, label: str) -> DataFrame:
    """The rows with every part's entry and distance; ``moved`` None: no state yet, every part is compared with all."""
    parts, entries, width = books.shape

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), parts * width)
            n = len(x)
            code, error = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            compared = np.zeros(n, np.int64)
            if moved is not None:
                code, error = _codes(batch.column("code"), parts), matrix(batch.column("error"), parts).copy()
                compared += batch.column("compared").to_numpy()
            for p in range(parts):
                own = x[:, p * width : (p + 1) * width]
                if moved is None:
                    (code[:, p], error[:, p]), looked = nearest_entries(own, books[p]), entries
                else:
                    code[:, p], error[:, p], looked = active_entries(own, books[p], moved[p], code[:, p], error[:, p])
                compared += looked
            packed = pa.array([row.tobytes() for row in code.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), lists(x.astype(np.int32)), packed, lists(error), pa.array(compared)],
                names=["vec_id", "label", "x", "code", "error", "compared"])

    return state.mapInArrow(assign, f"vec_id long, label {label}, x array<int>, code binary, error array<bigint>, compared long")


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The books after an update: floors of the means, entries without parts as they were."""
    parts, entries, width = books.shape

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        code = _codes(batch.column("code"), parts) + entries * np.arange(parts)
        x = matrix(batch.column("x"), width).reshape(-1)
        counts, sums = total[: parts * entries], total[parts * entries :]
        np.add.at(counts, code.reshape(-1), 1)
        np.add.at(sums, (code.reshape(-1, 1) * width + np.arange(width)).reshape(-1), x)

    total = summed(state.select("x", "code"), add, parts * entries * (1 + width))
    counts = total[: parts * entries].reshape(parts, entries, 1)
    sums = total[parts * entries :].reshape(books.shape)
    return np.where(counts > 0, sums // np.maximum(counts, 1), books)


def encode_vectors(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> VectorCodes:
    """Codes of all vectors (vec_id, embedding, label) after ``rounds`` updates of the codebooks.

    ``entries`` is at most 256 and the width a multiple of ``parts``. Runs
    one stored pass a round; a round's table is removed when the next is complete.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    rows, width = scaled(vectors, scale)
    label = rows.schema["label"].dataType.simpleString()
    if not width:
        empty = vectors.sparkSession.createDataFrame([], f"vec_id long, label {label}, code binary, error long, compared long")
        return VectorCodes(empty, np.zeros((parts, 0, 0), np.int64))
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).toArrow().column("x").combine_chunks()
    books = matrix(first, width).reshape(-1, parts, width // parts).transpose(1, 0, 2)
    state, moved = written(_assigned(rows, books, None, label), "lloyd"), None
    for k in range(rounds):
        before, books = books, _means(state, books)
        moved = (books != before).any(2)
        after = _assigned(state, books, moved, label)
        if k + 1 == rounds:
            total = F.aggregate("error", F.lit(0).cast("long"), lambda a, b: a + b)
            after = after.select("vec_id", "label", "code", total.alias("error"), "compared")
        after = written(after, "lloyd")
        drop_written(state)
        state = after
    if not rounds:
        total = F.aggregate("error", F.lit(0).cast("long"), lambda a, b: a + b)
        state = state.select("vec_id", "label", "code", total.alias("error"), "compared")
    return VectorCodes(state, books)


def code_digests(found: VectorCodes) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): codes as hex, errors also summed over equal labels (nulls together).

    The sums are stored, so Spark knows their size: a small table is broadcast,
    a large one is joined by sorting, and a hot label's rows are split.
    """
    codes = found.codes
    sums = written(codes.groupBy(F.struct("label").alias("__of")).agg(F.sum("error").alias("label_error")), "label-errors")
    of = sums.select(F.col("__of")["label"].alias("__label"), "label_error")
    joined = codes.join(of, F.col("label").eqNullSafe(F.col("__label")), "left")
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(found.books_sha256()).alias("codebooks_sha256"))
