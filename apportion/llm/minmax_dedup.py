"""Near-duplicate documents by min-max hashing.

A document's set holds the hashes of its distinct word shingles. Each
permutation of the hash space gives two signature values, the set's minimum
and its maximum, so half as many permutations are evaluated as values are
kept; each value of two sets agrees with the probability of their similarity.
The values are banded. Documents of one and the same set are one class from
the start; classes that share a band are candidates and are confirmed on the
full sets.

A band with thousands of classes is not expanded into pairs. Each class is
first compared with one hub, the smallest class of the bands that it shares.
Where a band still holds more than one component after that, its classes meet
in blocks of bounded size, inside which everything across components is
compared and only links leave; so no link between components is lost.

A null or empty text (no words) has an empty set and is linked with nothing;
a text of fewer words than a shingle is one shingle. Rows of one ``doc_id`` are
one document. Rows without ``doc_id`` stay alone: their component is null and
they are kept. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import kept_in_worker, text_slices, texts, written
from apportion.llm.components import components

CACHED_WORDS = 400_000
#: Classes of a block in which a band's classes are compared.
BLOCK = 1024
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class MinMaxRules:
    """Shingle width in words, similarity in percent, and the banding.

    240 values (120 permutations) in 40 bands of 6 miss a pair of similarity
    0.8 with probability (1 - 0.8 ** 6) ** 40 = 5e-6.
    """

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _B
    return h ^ (h >> np.uint64(29))


class Shingles:
    """Shingle hash sets of texts."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.hashes = np.zeros(0, np.uint64)

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        found = np.fromiter((self.index.get(w, -1) for w in words), np.int64, len(words))
        gaps = np.flatnonzero(found < 0)
        if len(gaps):
            new = [words[i] for i in gaps.tolist()]
            fresh = list(dict.fromkeys(new))
            self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh64_intdigest(w) for w in fresh], np.uint64)])
            self.index.update(zip(fresh, range(len(self.index), len(self.index) + len(fresh))))
            found[gaps] = [self.index[w] for w in new]
        return self.hashes[found]

    def sets(self, docs: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        split = [text.lower().split() for text in docs]
        h = self.word_hashes([w for words in split for w in words])
        k, out, a = self.width, [], 0
        rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for j in range(k if len(rolled) else 0):
            rolled = _mixed(rolled * _A + h[j : j + len(rolled)])
        for words in split:
            n = len(words)
            if n >= k:
                out.append(np.unique(rolled[a : a + n - k + 1]))
            elif n:
                out.append(np.array([xxhash.xxh64_intdigest(b" ".join(words), n)], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
            a += n
        return out


def band_keys(sets: list[np.ndarray], rules: MinMaxRules) -> np.ndarray:
    """Band keys (one row per set) of non-empty sets."""
    n_values = rules.bands * rules.rows
    draw = np.random.default_rng(8).integers(0, 1 << 63, (2, (n_values + 1) // 2), np.uint64)
    values = np.empty((n_values + n_values % 2, len(sets)), np.uint64)
    h, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    image = np.empty_like(h)
    for p in range(draw.shape[1]):
        np.multiply(h, draw[0, p] | np.uint64(1), out=image)
        image ^= draw[1, p]
        values[2 * p] = np.minimum.reduceat(image, starts)
        values[2 * p + 1] = np.maximum.reduceat(image, starts)
    keys = np.empty((rules.bands, len(sets)), np.uint64)
    for band in range(rules.bands):
        key = np.full(len(sets), band + 1, np.uint64)
        for value in values[band * rules.rows : (band + 1) * rules.rows]:
            key = _mixed(key * _A + value)
        keys[band] = key
    return keys.T.astype(np.int64)


def signatures(docs: DataFrame, rules: MinMaxRules) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty) and its band keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = kept_in_worker(("shingles", rules.words), lambda: Shingles(rules.words))
        for part in text_slices(batches):
            sets = shingles.sets(texts(part))
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(full, rules)) if full else iter(())
            bands = [next(keys) if len(s) else np.zeros(0, np.int64) for s in sets]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, rules: MinMaxRules) -> DataFrame:
    """(node, full, brief): the shingle hashes of the wanted documents, and their low halves."""
    found = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = kept_in_worker(("shingles", rules.words), lambda: Shingles(rules.words))
        for part in text_slices(batches):
            sets = shingles.sets(texts(part))
            full = pa.array([x.tobytes() for x in sets], pa.binary())
            brief = pa.array([x.astype(np.uint32).tobytes() for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), full, brief], names=["node", "full", "brief"])

    return found.select("doc_id", "text").mapInArrow(run, "node long, full binary, brief binary")


def confirmed(pairs: DataFrame, sets: DataFrame, rules: MinMaxRules) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("full").alias("full_u"))
    right = sets.select(F.col("node").alias("v"), F.col("full").alias("full_v"))

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "full_u"):
            keep = []
            for a, b in zip(part.column("full_u").to_pylist(), part.column("full_v").to_pylist()):
                small, big = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
                at = np.searchsorted(big, small)
                common = int((big[np.minimum(at, len(big) - 1)] == small).sum()) if len(big) else 0
                keep.append(common > 0 and 100 * common >= rules.percent * (len(small) + len(big) - common))
            kept = part.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("u"), kept.column("v")], names=["u", "v"])

    return pairs.join(left, "u").join(right, "v").select("u", "v", "full_u", "full_v").mapInArrow(check, "u long, v long").distinct()


def _similar(nodes: np.ndarray, component: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of different components whose brief sets are similar enough; two hashes may meet by chance, so by a slack of two."""
    sizes = np.array([len(x) for x in sets])
    known, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    names, place, count = np.unique(component, return_inverse=True, return_counts=True)
    out, has = [], np.zeros(len(known), np.int32)
    for x in np.flatnonzero(place != count.argmax()):  # of two components, one is not the largest
        own = codes[starts[x] : starts[x] + sizes[x]]
        has[own] = 1
        common = np.add.reduceat(has[codes], starts) + 2
        has[own] = 0
        near = (component != component[x]) & (100 * common >= percent * (sizes + sizes[x] - common))
        out += [(int(max(nodes[x], nodes[y])), int(min(nodes[x], nodes[y]))) for y in np.flatnonzero(near)]
    return out


def across_components(rows: DataFrame, sets: DataFrame, rules: MinMaxRules) -> DataFrame:
    """Candidate links (u, v) between components inside bands: each band's classes meet in pairs of bounded blocks.

    A band of n classes is ceil(n / BLOCK) blocks; a row goes to as many tasks
    as there are blocks, and only likely links leave a task.
    """
    sized = rows.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = rows.join(sized, "band").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("band", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "node", "component")
    met = met.join(sets.select("node", "brief"), "node").repartition("band", "a", "b").sortWithinPartitions("band", "a", "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("band", "a", "b", "node", "component", "brief"))))
        found: set[tuple[int, int]] = set()
        for _, group in groupby(rows, key=lambda r: r[:3]):
            *_, nodes, component, brief = zip(*group)  # two blocks at most
            if len(set(component)) > 1:
                found.update(_similar(np.array(nodes), np.array(component), [np.frombuffer(x, np.uint32) for x in brief], rules.percent))
            if len(found) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["u", "v"])
                found.clear()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["u", "v"])

    return met.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, rules: MinMaxRules | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked id) and kept of each row."""
    rules = rules or MinMaxRules()
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    signed = written(signatures(rows, rules), "signatures")
    able = signed.where("digest is not null and doc_id is not null")
    # copies of a set are one class, named by its smallest id
    classes = written(able.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "classes")
    banded = classes.select(F.explode("bands").alias("band"), "node")
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").select("band", "hub")
    shared = written(banded.join(hubs, "band"), "shared-bands")  # the classes that share a band with another one
    sets = written(full_sets(rows.where("doc_id is not null"), shared.select("node").distinct(), rules), "sets")

    # each class against the hub with which it shares most bands
    ties = shared.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("n"))
    best = ties.groupBy("node").agg(F.max(F.struct("n", (-F.col("hub")).alias("hub"))).alias("best"))
    links = written(confirmed(best.select(F.col("node").alias("u"), (-F.col("best.hub")).alias("v")), sets, rules), "links")

    # bands that still hold several components: everything across them
    placed = shared.join(components(links), "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("band")
    likely = written(across_components(placed.join(mixed, "band", "left_semi"), sets, rules), "likely-links")
    final = components(links.union(confirmed(likely, sets, rules)))

    named = classes.select("digest", "node").join(final, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    full = signed.where("digest is not null").select("doc_id", "n_shingles", "digest").join(named, "digest", "left").drop("digest")
    bare = signed.where("digest is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component"))
    out = full.unionByName(bare)  # empty sets stay out of the join: they may be many
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, rules: MinMaxRules | None = None) -> DataFrame:
    """One document of each group (and one of its rows, if it is repeated), all columns as they are."""
    kept = near_duplicates(docs, rules).where("kept and doc_id is not null").select("doc_id").distinct()
    alone = docs.where("doc_id is null")
    return docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(docs.columns).union(alone)
