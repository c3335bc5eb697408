"""Approximate nearest neighbours by adaptive dimension scan.

Vectors are turned by a random rotation and fall into inverted lists by their
nearest centroid (fitted on a bounded sample; every vector is indexed). Lists
are stored in blocks of bounded size, so a list that holds a third of all rows
is many blocks. A query scans its nearest list first, then the next ones, then
the rest of its probed lists; its tenth best distance so far goes with it. In
each block its distance to the candidates grows by column blocks of the
rotated vectors, and after each a hypothesis test abandons the candidates whose
partial distance says that they lie beyond the tenth best. Survivors are
measured exactly on the original vectors. ``scanned_share`` says which share of
all components of the probed candidates a query has looked at.

In a (list, block) the candidates come first and the queries stream past them:
a task holds one block and one Arrow batch, and no candidate is copied.

The width is the commonest length of the usable vectors (of equally common ones
the larger). Null, zero, empty or other-length vectors and vectors with null or
non-finite components take no part. Repeated rows are kept once with their number,
are candidates as often as they occur and ask once; a query never finds rows of its
own id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from apportion.llm.common import written
from apportion.llm.vectors import matrix

#: Vectors that the centroids are fitted on, at most.
SAMPLE = 20_000
#: Rows of a list and of a stored block of it (on average), columns in a column block.
LIST_ROWS, BLOCK, COLUMNS = 1024, 4096, 16
#: Slack of the hypothesis test in standard deviations: a candidate as far as the tenth best fails one with a chance of 0.005 to 0.02.
SLACK = 2.5


@dataclass(frozen=True)
class Index:
    """Rotation and centroids; of a size set by ``SAMPLE``, not by the table."""

    rotation: np.ndarray
    centroids: np.ndarray  # rotated

    def rotate(self, x: np.ndarray) -> np.ndarray:
        return x @ self.rotation

    def distances(self, rotated: np.ndarray) -> np.ndarray:
        return (rotated**2).sum(1)[:, None] - 2 * rotated @ self.centroids.T + (self.centroids**2).sum(1)[None, :]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part; ``v`` in double precision."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def fit_index(vectors: DataFrame, n_rows: int, rounds: int = 8, seed: int = 4) -> Index:
    """Rotation and k-means centroids of a sample of vectors of one length: the ``SAMPLE`` rows of smallest id hash."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow().column("v").to_pylist()
    x = np.array(rows)
    width = x.shape[1]
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
    x = x @ rotation
    # at most one centroid per square root of the rows (lists and probes grow alike), and lists worth a matrix
    n_lists = int(max(1, min(np.sqrt(n_rows), np.ceil(n_rows / LIST_ROWS), len(x) // 8)))
    index = Index(rotation, np.unique(x, axis=0)[rng.permutation(len(np.unique(x, axis=0)))[:n_lists]])
    for _ in range(rounds):
        near = index.distances(x).argmin(1)
        sums = np.zeros_like(index.centroids)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(index.centroids))
        index = Index(rotation, np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], index.centroids))
    return index


def share_below(b: int, width: int) -> float:
    """The share of a squared distance that its first ``b`` of ``width`` rotated components hold at most, if the test is not to fail.

    After a random rotation that share has a beta distribution (b / 2, (width - b) / 2): its mean and ``SLACK`` deviations.
    """
    return 1.0 if b >= width else min(1.0, b / width + SLACK * np.sqrt(2 * b * (width - b) / (width**2 * (width + 2))))


def _scan(rotated: np.ndarray, original: np.ndarray, others: np.ndarray, q_rotated: np.ndarray, q: np.ndarray, limit: float, top: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(exact squared distance, place) of the candidates ``others`` that no test abandoned, and the components looked at.

    ``limit`` is the squared distance of the tenth best so far (infinite: none yet).
    """
    width = rotated.shape[1]
    alive, scanned = others, 0
    if not np.isfinite(limit) and len(alive) >= top:  # a first threshold: the exact distances of a few candidates
        limit = np.sort(((original[alive[: 4 * top]] - q) ** 2).sum(1))[top - 1]
        scanned += min(len(alive), 4 * top) * width
    partial, rounding = np.zeros(len(alive)), 1e-10 * float(q @ q)  # of the rotation
    for a in range(0, width, COLUMNS):
        b = min(a + COLUMNS, width)
        partial += ((rotated[alive, a:b] - q_rotated[a:b]) ** 2).sum(1)
        scanned += len(alive) * (b - a)
        scale = share_below(b, width)
        keep = partial <= limit * scale + rounding
        if b < width and keep.sum() > 4 * top:  # the best so far tighten the threshold
            guess = alive[keep][np.argpartition(partial[keep], top - 1)[:top]]
            limit = min(limit, ((original[guess] - q) ** 2).sum(1).max())
            scanned += top * width
            keep = partial <= limit * scale + rounding
        alive, partial = alive[keep], partial[keep]
    scanned += len(alive) * width
    return ((original[alive] - q) ** 2).sum(1), alive, scanned


def block_of(n_blocks: Column) -> Column:
    """The block of a row in its list, from its data alone: a task that runs again deals alike."""
    return F.pmod(F.xxhash64("vec_id", "v"), n_blocks).cast("int")


def waves(probes: int) -> list[tuple[int, int]]:
    """Which of a query's probed lists are scanned together: the nearest one, up to an eighth of all, the rest."""
    ends = sorted({1, max(1, probes // 8), probes})
    return list(zip([0, *ends[:-1]], ends))


def nearest(vectors: DataFrame, query_step: int = 100, top: int = 10, probe_share: float = 0.75) -> DataFrame:
    """The ``top`` nearest other rows of each row whose id ``query_step`` divides, out of its probed lists."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    most = rows.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, scanned_share double")
    width = most.width
    rows = rows.where(F.size("v") == width).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    index = fit_index(rows, most.n)
    shared = spark.sparkContext.broadcast(index)  # as large as the bounded sample allows
    n_lists = len(index.centroids)
    probes = max(min(n_lists, 8), int(np.ceil(probe_share * n_lists)))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = shared.value.distances(shared.value.rotate(matrix(batch.column("v"), width, np.float64))).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32))], names=[*batch.schema.names, "list"])

    def probed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(shared.value.distances(shared.value.rotate(matrix(batch.column("v"), width, np.float64))), axis=1, kind="stable")[:, :probes]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(near.astype(np.int32)))], names=[*batch.schema.names, "lists"])

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, block, parts = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("list", "block", "asks")], 1)
            starts = np.flatnonzero(np.any(np.diff(keys, axis=0), axis=1)) + 1
            for a, b in zip([0, *starts], [*starts, batch.num_rows]):
                run, (*where, asks) = batch.slice(a, b - a), keys[a].tolist()
                if where != place:
                    place, block, parts = where, None, []
                x = matrix(run.column("v"), width, np.float64)
                numbers = [run.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "copies", "tenth")]
                if not asks:
                    parts.append((x, *numbers[:2]))
                elif parts or block is not None:
                    if block is None:
                        original, ids, copies = (np.concatenate(c) for c in zip(*parts))
                        block, parts = (shared.value.rotate(original), original, ids, copies), []
                    yield _answers(block, x, shared.value.rotate(x), numbers[0], numbers[2], top)

    # (vec_id, v, copies, list) of every row, stored: each wave reads the same lists
    listed = written(rows.mapInArrow(assign, "vec_id long, v array<double>, copies long, list int"), "lists")
    # bounded by n_lists rows: how many blocks each list needs
    blocks = listed.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    none = F.lit(None).cast("double").alias("tenth")
    stored = listed.join(F.broadcast(blocks), "list").select("list", block_of(F.col("n_blocks")).alias("block"), F.lit(0).alias("asks"), "vec_id", "v", "copies", none)
    queries = written(rows.where(F.col("vec_id") % query_step == 0).mapInArrow(probed, "vec_id long, v array<double>, copies long, lists array<int>"), "queries")

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    found = None
    for start, end in waves(probes):
        asking = queries.withColumn("tenth", none)
        if found is not None:
            # at most `top` rows of a query from each block that it has scanned
            tenth = found.where("vec_id IS NOT NULL").withColumn("rank", rank).where(F.col("rank") == top).select(F.col("query_id").alias("vec_id"), F.col("score").alias("tenth"))
            asking = queries.join(tenth, "vec_id", "left")
        asking = asking.select("vec_id", "v", "copies", "tenth", F.explode(F.slice("lists", start + 1, end - start)).alias("list")).join(F.broadcast(blocks), "list")
        asking = asking.select("list", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), F.lit(1).alias("asks"), "vec_id", "v", "copies", "tenth")
        met = stored.unionByName(asking).repartition("list", "block").sortWithinPartitions("list", "block", "asks")
        new = written(met.mapInArrow(meet, "query_id long, vec_id long, score double, scanned long, components long"), "found")
        found = new if found is None else found.unionByName(new)
    share = found.groupBy("query_id").agg((F.sum("scanned") / F.sum("components")).alias("scanned_share"))
    best = found.where("vec_id IS NOT NULL").withColumn("rank", rank).where(F.col("rank") <= top)
    return best.join(share, "query_id").select("query_id", "rank", "vec_id", "score", "scanned_share")


def _answers(block: tuple, x: np.ndarray, turned: np.ndarray, query_ids: np.ndarray, tenths: np.ndarray, top: int) -> pa.RecordBatch:
    """The nearest of a block's candidates for each query, and for each a row without ``vec_id`` that counts components."""
    rotated, original, ids, copies = block
    out: list[list] = [[], [], [], [], []]
    for own, tenth, q, q_rotated in zip(query_ids.tolist(), np.nan_to_num(tenths.astype(float), nan=np.inf), x, turned):
        others = np.flatnonzero(ids != own)
        squared, alive, scanned = _scan(rotated, original, others, q_rotated, q, tenth * tenth, top)
        order = np.lexsort((ids[alive], squared))[:top]
        order = np.repeat(order, np.minimum(copies[alive[order]], top))[:top]
        n = len(order)
        for column, values in zip(out, ([own] * (n + 1), [*ids[alive[order]].tolist(), None], [*np.sqrt(squared[order]).tolist(), None],
                                        [0] * n + [scanned], [0] * n + [len(others) * rotated.shape[1]])):
            column += values
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["query_id", "vec_id", "score", "scanned", "components"])
