"""Document fingerprints from improbable features in chained Bloom filters.

A feature is a window of 32 bytes. Its level is its entropy in thousandths of
the largest possible, computed exactly for every window of a text from the
window before it. Spark counts the levels over all documents; the
fewer windows of the corpus have a level, the rarer it is and the better its
rank (levels below 100, as in runs of one byte, come after all others: such
windows are rare but say little). In each run of 32 neighbouring features the leftmost of
best rank gains a point, and features of 8 points or more (or of the text's most) are selected. A text
whose features fit one filter takes them all. Each different one is put into a chain of Bloom filters of
2,048 bits by five hashes; after 160 features a new filter begins.

The likeness of two fingerprints goes through the filters of the shorter
chain: for each the best bit overlap with a filter of the other chain, as a share of
the way from the overlap expected by chance to the largest possible, 0 when it is within three
standard deviations of chance; the mean weighs filters by their features.

Texts below 32 bytes are one feature, empty and null texts have none; two empty
fingerprints are alike (1), an empty one and another are not (0). Equal texts
have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import text_slices, texts, written
from apportion.llm.vectors import summed

#: Bytes of a feature; neighbours that compete (a power of two, WINDOW at most); points of a selected one.
WINDOW, RUN, POINTS = 32, 32, 8
#: Least level of a telling feature, number of levels.
LEAST_LEVEL, LEVELS = 100, 1001
#: Bits of a filter, features of a filter, hashes of a feature.
BITS, CAPACITY, HASHES = 2048, 160, 5
#: Window starts handled at once, rows and bytes of text handled at once.
BLOCK, SLICE_ROWS, SLICE = 1 << 16, 2048, 1 << 20
#: Blocks of neighbouring documents per shuffle partition; equal rows (id and text) beyond which copies are counted instead of moved.
SPREAD, COPIES = 8, 1000

_N = np.arange(WINDOW + 1)
#: n * log2(n) as integers: entropies are exact and the same on every machine.
_WEIGHT = np.rint(_N * np.log2(np.maximum(_N, 1)) * (1 << 20)).astype(np.int64)
_STEP = np.diff(_WEIGHT)
_WORST = np.int64(np.iinfo(np.int64).max)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of unsigned numbers (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = _mixed(np.arange(1, WINDOW + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def levels(data: np.ndarray) -> np.ndarray:
    """The level of the window that starts at each byte (none for the last ones)."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int16)
    out = np.empty(n, np.int16)
    for a in range(0, n, BLOCK):
        b = min(a + BLOCK, n)
        part = data[a : b + WINDOW - 1]
        ahead, behind = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for d in range(1, WINDOW):  # equal bytes within a window's reach on either side
            same = (part[:-d] == part[d:]).view(np.uint8)
            ahead[:-d] += same
            behind[d:] += same
        first = _WEIGHT[np.bincount(part[:WINDOW])].sum()
        # the next window loses its first byte and gains one
        change = _STEP[behind[WINDOW : WINDOW + b - a - 1]] - _STEP[ahead[: b - a - 1]]
        held = np.concatenate([[first], first + np.cumsum(change)])
        out[a:b] = 1000 * (_WEIGHT[-1] - held) // _WEIGHT[-1]
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """The rank of each level: the rarest first (equally rare ones from the lowest), levels below ``LEAST_LEVEL`` last."""
    order = np.lexsort((np.arange(LEVELS), counts, np.arange(LEVELS) < LEAST_LEVEL))
    rank = np.empty(LEVELS, np.int64)
    rank[order] = np.arange(LEVELS)
    return rank


def _joined(parts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array, and where each starts and ends."""
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), ends - [len(p) for p in parts], ends


def level_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of all texts have each level."""

    def add(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for part in text_slices([batch]):
            data, starts, ends = _joined(texts(part))
            own = np.zeros(max(0, len(data) - WINDOW + 1), bool)
            for s, e in zip(starts, ends):
                own[s : max(s, e - WINDOW + 1)] = True
            total += np.bincount(levels(data)[own], minlength=LEVELS)

    return summed(docs.select("text"), add, LEVELS)


def _points(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The points of the feature at each byte, for texts of at least a window."""
    feature, leads = np.zeros(len(data), bool), np.zeros(len(data), bool)
    for s, e in zip(starts, ends):
        feature[s : e - WINDOW + 1] = True
        leads[s : max(s + 1, e - WINDOW - RUN + 2)] = True  # runs of neighbours start here
    points = np.zeros(len(data) + RUN, np.uint8)
    for a in range(0, len(data), 4 * BLOCK):
        b = min(a + 4 * BLOCK, len(data))
        found = levels(data[a : b + WINDOW + RUN - 2])
        best = np.full(b - a + RUN - 1, _WORST)
        own = feature[a : a + len(best)]
        place = np.flatnonzero(own)
        best[place] = (rank[found[place]] << 32) | place
        shift = 1
        while shift < RUN:
            best = np.minimum(best[:-shift], best[shift:])
            shift *= 2
        winners = best[: b - a][leads[a:b]] & 0xFFFFFFFF
        gained = np.bincount(winners, minlength=b - a + RUN)
        points[a : a + len(gained)] += gained.astype(np.uint8)[: len(points) - a]
    return points[: len(data)]


@dataclass(frozen=True)
class Digest:
    """The number of features and the filters (rows of 32 words of 64 bits)."""

    n: int
    filters: np.ndarray

    def text(self) -> str:
        return f"{self.n}:{base64.b64encode(self.filters.astype('<u8').tobytes()).decode()}"

    @staticmethod
    def parse(text: str) -> "Digest":
        n, bits = text.split(":")
        return Digest(int(n), np.frombuffer(base64.b64decode(bits), "<u8").reshape(-1, BITS // 64))

    def weights(self) -> np.ndarray:
        return np.minimum(CAPACITY, self.n - CAPACITY * np.arange(len(self.filters)))

    def likeness(self, other: "Digest") -> float:
        if not self.n or not other.n:
            return float(self.n == other.n)
        if len(self.filters) == len(other.filters):
            return (self._best(other) + other._best(self)) / 2
        return self._best(other) if len(self.filters) < len(other.filters) else other._best(self)

    def _best(self, other: "Digest") -> float:
        """The weighted mean of each own filter's best score."""
        theirs = np.bitwise_count(other.filters).sum(1, dtype=np.int64)
        best = np.empty(len(self.filters))
        for k, own in enumerate(self.filters):
            mine = int(np.bitwise_count(own).sum(dtype=np.int64))
            shared = np.bitwise_count(other.filters & own).sum(1, dtype=np.int64)
            most, dense = np.minimum(mine, theirs), np.maximum(mine, theirs) / BITS
            chance = most * dense
            score = np.where(shared > chance + 3 * np.sqrt(chance * (1 - dense)), (shared - chance) / np.maximum(most - chance, 1e-9), 0)
            best[k] = min(1.0, score.max())
        weights = self.weights()
        return float((best * weights).sum() / weights.sum())


def digests(parts: Sequence[bytes], rank: np.ndarray) -> list[Digest]:
    """The digest of each text."""
    doc, hashes = [], []
    long = [k for k, p in enumerate(parts) if len(p) >= WINDOW]
    if long:
        data, starts, ends = _joined([parts[k] for k in long])
        points = _points(data, starts, ends, rank)
        needed = np.minimum(POINTS, np.maximum.reduceat(points, starts))
        chosen = points >= np.repeat(needed, ends - starts)
        few = ends - starts < CAPACITY + WINDOW
        for s, e in zip(starts[few], ends[few]):
            chosen[s : e - WINDOW + 1] = True
        place = np.flatnonzero(chosen)
        windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)
        for a in range(0, len(place), BLOCK // 4):
            hashes.append((windows[place[a : a + BLOCK // 4]].astype(np.uint64) + np.uint64(1)) @ _FACTORS)
        doc.append(np.array(long)[np.searchsorted(starts, place, "right") - 1])
    for k, p in enumerate(parts):
        if 0 < len(p) < WINDOW:
            hashes.append(((np.frombuffer(p, np.uint8).astype(np.uint64) + np.uint64(1)) * _FACTORS[: len(p)]).sum(keepdims=True, dtype=np.uint64))
            doc.append(np.array([k]))
    if not doc:
        return [Digest(0, np.zeros((0, BITS // 64), np.uint64)) for _ in parts]
    of, value = np.concatenate(doc), _mixed(np.concatenate(hashes))
    # each different feature of a text once, where it came first
    order = np.lexsort((np.arange(len(of)), value, of))
    again = np.zeros(len(of), bool)
    again[order[1:]] = (of[order[1:]] == of[order[:-1]]) & (value[order[1:]] == value[order[:-1]])
    of, value = of[~again], value[~again]
    order = np.argsort(of, kind="stable")
    of, value = of[order], value[order]
    n = np.bincount(of, minlength=len(parts))
    chains = -(-n // CAPACITY)
    begin = np.concatenate([[0], np.cumsum(chains)])
    within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    row = begin[of] + within // CAPACITY
    filters = np.zeros((begin[-1], BITS // 64), np.uint64)
    for k in range(HASHES):
        bit = (value >> np.uint64(11 * k)) & np.uint64(BITS - 1)
        np.bitwise_or.at(filters, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return [Digest(int(c), filters[begin[k] : begin[k + 1]]) for k, c in enumerate(n)]


def fingerprint_documents(docs: DataFrame, counts: np.ndarray | None = None, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text; ``counts`` (default: of these documents) are those of :func:`level_counts`."""
    rank = ranks(level_counts(docs) if counts is None else counts)
    kept = docs.drop(out)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = pa.array([d.text() for d in digests(texts(part), rank)], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*part.schema.names, out])

    return kept.mapInArrow(add, kept.select("*", F.lit(None).cast("string").alias(out)).schema)


def with_likeness(pairs: DataFrame, left: str, right: str, out: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness of the fingerprints in two columns (null if one is null)."""
    kept = pairs.drop(out)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(left).to_pylist(), batch.column(right).to_pylist())
            found = [None if a is None or b is None else Digest.parse(a).likeness(Digest.parse(b)) for a, b in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, out])

    return kept.mapInArrow(add, kept.select("*", F.lit(None).cast("double").alias(out)).schema)


# ------------------------------------------------- fingerprints of documents and of their edited texts

_ROW, _AFTER, _ALONE = 0, 1, 2
_DEALT = "block int, role int, doc_id long, h1 long, h2 long, text string, copies int"
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, copies int"


def _key(doc_id: int | None, h1: int, h2: int) -> tuple:
    """Sorts by id (null last), then by the hashes of the text."""
    return (doc_id is None, doc_id or 0, h1, h2)


def _dealt(rows: DataFrame, heads: list[tuple], skipped: frozenset) -> DataFrame:
    """Rows with the number of their block; a block's first row is also sent after the block before it (the first block's after the last)."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = {head: (b - 1) % len(heads) for b, head in enumerate(heads)}
        for batch in batches:
            take, block, role = [], [], []
            for i, key in enumerate(map(_key, *(batch.column(c).to_pylist() for c in ("doc_id", "h1", "h2")))):
                if key in skipped:
                    continue
                take.append(i)
                block.append(bisect_right(heads, key) - 1)
                role.append(_ROW)
                if key in first:
                    take.append(i)
                    block.append(first[key])
                    role.append(_AFTER)
            kept = batch.take(pa.array(take, pa.int64()))
            ones = pa.array([1] * len(take), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(role, pa.int32()), *(kept.column(c) for c in ("doc_id", "h1", "h2", "text")), ones],
                names=["block", "role", "doc_id", "h1", "h2", "text", "copies"])

    return rows.select("doc_id", "h1", "h2", "text").mapInArrow(deal, _DEALT)


def _digested(rank: np.ndarray):
    """The pass over sorted blocks: every row with the row after it."""

    def finish(rows: list[list], following: list | None) -> pa.RecordBatch | None:
        """Results of ``rows``; each ends [.., digest], filled in here. ``following``: the row after the last, if it is known."""
        todo = rows + ([following] if following is not None else [])
        missing = [r for r in todo if r[5] is None]
        for row, d in zip(missing, digests([r[3].encode() for r in missing], rank)):
            row[5] = d
        done, edited = [], []
        for k, row in enumerate(rows):
            block, role, _, text, _, _ = row
            if role == _AFTER:
                continue
            after = row if role == _ALONE else (todo[k + 1] if k + 1 < len(todo) else None)
            if after is None or after[0] != block or (role == _ROW and after[1] == _ALONE):
                raise RuntimeError("a document's successor is not in its block: the input changed between passes")
            half = len(text) // 2
            done.append((row, after))
            edited.append((text[: len(text) - half] + after[3][:half]).encode())
        if not done:
            return None
        columns: list[list] = [[] for _ in range(8)]
        for (row, after), e, d in zip(done, edited, digests(edited, rank)):
            own = row[5]
            values = (row[2], len(row[3]), hashlib.sha256(e).hexdigest(), own.text(), d.text(), own.likeness(d), own.likeness(after[5]), row[4])
            for column, v in zip(columns, values):
                column.append(v)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32())
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "copies"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list] = []
        held = 0
        for batch in batches:
            for part in text_slices([batch], budget=SLICE):
                for values in zip(*(part.column(c).to_pylist() for c in ("block", "role", "doc_id", "text", "copies"))):
                    row = [*values, None]
                    if waiting and (held >= SLICE or len(waiting) >= SLICE_ROWS):
                        if (out := finish(waiting, row)) is not None:
                            yield out
                        waiting, held = [], 0
                    waiting.append(row)
                    held += len(row[3])
        if waiting and (out := finish(waiting, None)) is not None:
            yield out

    return run


def edited_digests(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts: the contract of the query ``op13_improbable_digest``.

    In an edited text the last half of the code points (rounded down) is
    replaced by as many from the start of the next document by id (nulls last, equal
    ids by hashes of the text; the first after the last, a single document
    after itself). Documents are dealt to blocks of neighbouring ids
    (at most ``SPREAD`` blocks per shuffle partition, whose first keys the driver
    knows); the first row of a block also goes to the block before it, so every
    pair meets in one task and a text moves once. Rows of equal id and text
    beyond ``COPIES`` and beyond a block's even share are represented by one row and counted;
    each result of theirs but the last is the one next to itself.
    """
    spark = docs.sparkSession
    counts = level_counts(docs)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit(1)).alias("h2"))
    keys = written(rows.select("doc_id", "h1", "h2").groupBy("doc_id", "h1", "h2").agg(F.count("*").alias("n")), "digest-keys")
    total = keys.agg(F.sum("n")).first()[0]
    result = [c.split()[0] for c in _RESULT.split(", ")][:-1]
    if not total:
        return spark.createDataFrame([], _RESULT).select(*result)
    n_blocks = SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))
    missing = F.col("doc_id").isNull()
    ranged = keys.repartitionByRange(n_blocks, missing, F.col("doc_id"), F.col("h1"), F.col("h2"))
    first = F.min(F.struct(missing.alias("missing"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h1", "h2")).alias("head")
    heads = sorted(tuple(r.head) for r in ranged.groupBy(F.spark_partition_id()).agg(first).collect())
    hot_rows = keys.where(F.col("n") > max(COPIES, total // n_blocks))
    hot = frozenset(_key(r.doc_id, r.h1, r.h2) for r in hot_rows.collect())  # fewer than blocks

    dealt = _dealt(rows, heads, hot)
    if hot:
        same = [rows[c].eqNullSafe(hot_rows[c]) for c in ("doc_id", "h1", "h2")]
        kept = rows.join(F.broadcast(hot_rows), same[0] & same[1] & same[2], "left_semi")
        one = kept.groupBy("doc_id", "h1", "h2").agg(F.any_value("text").alias("text"), F.count("*").alias("n"))
        one = written(one, "digest-copies")
        chunk = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 2, F.lit(COPIES).cast("long"))).alias("k", "at")
        lone = one.select("*", chunk).select(
            F.pmod(F.xxhash64("doc_id", "h1", "k"), F.lit(len(heads))).cast("int").alias("block"), F.lit(_ALONE).alias("role"), "doc_id", "h1", "h2", "text",
            F.least(F.lit(COPIES).cast("long"), F.col("n") - 1 - F.col("at")).cast("int").alias("copies"))
        dealt = dealt.unionByName(_dealt(one, heads, frozenset())).unionByName(lone)
    in_order = dealt.repartition("block").sortWithinPartitions("block", "role", F.col("doc_id").asc_nulls_last(), "h1", "h2")
    found = in_order.select("block", "role", "doc_id", "text", "copies").mapInArrow(_digested(ranks(counts)), _RESULT)
    if hot:
        found = found.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return found.select(*result)
