"""Removal of repeated passages by longest-previous-factor arrays.

A window of ``length`` bytes is removed where the longest previous factor of
its place (the longest string there that also starts earlier in the corpus)
covers it. In suffix order, the nearest earlier-placed suffixes before and
after a suffix (previous and next smaller positions) hold its longest earlier
match, and suffixes that share ``length`` bytes are neighbours; so the arrays
are needed only up to ``length``, over suffixes that can match at all.

Spark finds these. Every window chooses its anchor: the place of the least
hash among its short substrings, so equal windows have equal anchors at equal
offsets, and about one place in 85 is an anchor. Anchors are counted by hash;
those that occur once cannot lie in a repeated window. Of the rest, anchors
whose whole stretch (all windows that chose them) is the same are copies by
that alone. Only where one anchor has several different stretches are the
stretches' bytes (one of each kind) gathered by anchor, put in suffix order
and compared window by window. An anchor with very many different stretches
is not gathered: its windows are counted by their own hash.

``keep="first"`` leaves the first place of every window (by doc_id and place);
``keep="none"`` removes every window that also starts anywhere else.

A null or empty text has nothing to remove. Rows of one id and text are the
same document in first place (none of them is a later copy of the other) and
copies of each other with ``keep="none"``. Null ids come before others. Extra
columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import kept_in_worker, text_slices, texts, written

LENGTH = 200
#: Bytes of the substrings whose hashes choose anchors (a power of two).
GRAM = 32
#: Bytes of text that anchors are chosen in at once.
BLOCK = 1 << 20
#: Bytes of stretches put in suffix order at once (whole anchor groups).
CHUNK = 1 << 19
#: Different stretches of an anchor beyond which its windows are counted by hash.
GATHERED = 2000
NULL_ID = -(1 << 63)

_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) | np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Hash of each substring of ``width`` bytes."""
    h, factor, w = _BYTE[data], _STEP, 1
    while w < width:
        h = h[:-w] * np.uint64(factor) + h[w:]
        factor = factor * factor % (1 << 64)
        w *= 2
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each anchor of a text of at least ``length`` bytes."""
    h = gram_hashes(data)
    # the hash's high half above the place: the minimum tells where it lies, the first place of equal ones
    least = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    span, w = length - GRAM + 1, 1
    while 2 * w <= span:
        least = np.minimum(least[:-w], least[w:])
        w *= 2
    if w < span:
        least = np.minimum(least[: len(least) - (span - w)], least[span - w :])
    place = (least & _LOW).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    last = np.append(first[1:], len(place)) - 1
    return h[place[first]], place[first], first, last


#: What tells documents apart: the id, and 128 bits of the text's hash where ids are equal or null.
DOC = ["doc", "h", "g"]


def key_columns() -> list[Column]:
    """The columns DOC of a document."""
    text = F.col("text").cast("string")
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"), *(h.alias(c) for h, c in zip(text_hashes(text), DOC[1:]))]


def text_hashes(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def keyed(docs: DataFrame, length: int) -> DataFrame:
    """(doc, h, g, text): key and text of the documents that hold a window."""
    return docs.select(*key_columns(), F.col("text").cast("string").alias("text")).where(F.octet_length("text") >= length)


def anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """(gram, stretch, doc, h, g, at, first, last): an anchor's hash, its stretch's hash, its document, its place and its windows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_in_worker("anchors", lambda: None)  # other operators' tables go
        for part in text_slices(batches):
            out: list[tuple[np.ndarray, ...]] = []
            for doc, h, g, text in zip(*(part.column(c).to_pylist() for c in DOC), texts(part)):
                for base in range(0, len(text) - length + 1, BLOCK):
                    block = text[base : base + BLOCK + length - 1]
                    gram, place, first, last = anchors(np.frombuffer(block, np.uint8), length)
                    stretch = [xxhash.xxh64_intdigest(block[a : b + length], p - a) for a, b, p in zip(first.tolist(), last.tolist(), place.tolist())]
                    out.append((gram, np.array(stretch, np.uint64), *(np.full(len(gram), x) for x in (doc, h, g)), base + place, base + first, base + last))
            columns = [np.concatenate(c).astype(np.uint64 if i < 2 else np.int64) for i, c in enumerate(zip(*out))]
            yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["gram", "stretch", *DOC, "at", "first", "last"])

    return rows.mapInArrow(run, "gram long, stretch long, doc long, h long, g long, at long, first long, last long")


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of the keys."""
    order = np.argsort(keys)
    new = np.empty(len(keys), np.int64)
    new[order] = np.cumsum(np.diff(keys[order], prepend=keys[order[:1]]) != 0)
    return new


def suffix_ranks(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Rank of the suffix at each place in the order of all suffixes' first ``length`` bytes, by prefix doubling."""
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    rank, w = _ranks(np.ascontiguousarray(windows).view(">u8").ravel().astype(np.uint64)), 8
    while 2 * w <= length:
        rank = _ranks(rank[:-w] * len(rank) + rank[w:])
        w *= 2
    return _ranks(rank[places] * len(rank) + rank[places + length - w])


def previous_and_next(rank: np.ndarray, *position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the longest previous and the longest next factor of each window reach its whole length.

    Windows of one rank are neighbours in suffix order; with their positions (document
    first) ascending, the previous smaller position that shares the whole window is
    the neighbour before, and the next greater one the neighbour behind.
    """
    order = np.lexsort((*position[::-1], rank))
    r = rank[order]
    same = r[1:] == r[:-1]
    before, behind = np.zeros(len(r), bool), np.zeros(len(r), bool)
    before[order[1:]] = same
    behind[order[:-1]] = same
    return before, behind


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true flags."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


STRETCH = "gram long, n long, kinds long, doc long, h long, g long, first long, bytes binary"


def stretch_bytes(kinds: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """The bytes of one stretch of each kind, cut from its document."""
    wanted = kinds.groupBy(*DOC).agg(F.collect_list(F.struct("gram", "n", "kinds", "first", "last")).alias("wanted"))  # bounded by a document
    source = rows.join(wanted, DOC).dropDuplicates(DOC)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in STRETCH.split(", ")]
        types = [pa.int64()] * 7 + [pa.binary()]
        for part in text_slices(batches):
            out = []
            for doc, h, g, text, wanted in zip(*(part.column(c).to_pylist() for c in DOC), texts(part), part.column("wanted").to_pylist()):
                out += [(w["gram"], w["n"], w["kinds"], doc, h, g, w["first"], text[w["first"] : w["last"] + length]) for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return source.select(*DOC, "text", "wanted").mapInArrow(run, STRETCH)


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of whole anchor groups, about CHUNK bytes at a time."""
    held: list[dict] = []
    size, last = 0, None
    for batch in batches:
        for row in batch.to_pylist():
            if size > CHUNK and row["gram"] != last:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row["bytes"])
            last = row["gram"]
    if held:
        yield held


def matched(stretches: DataFrame, length: int, keep: str) -> DataFrame:
    """(doc, h, g, a, b) byte spans of repeated windows, from stretches gathered by anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _chunks(batches):
            sizes = np.array([len(r["bytes"]) for r in rows])
            ends = np.cumsum(sizes)
            counts = sizes - length + 1
            owner = np.repeat(np.arange(len(rows)), counts)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            rank = suffix_ranks(np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8), (ends - sizes)[owner] + inside, length)
            doc, h, g, first = (np.array([r[c] for r in rows], np.int64) for c in (*DOC, "first"))
            before, behind = previous_and_next(rank, doc[owner], h[owner], g[owner], first[owner] + inside)
            flags = before if keep == "first" else before | behind
            flags = np.insert(flags, np.cumsum(counts), False)  # a run ends with its stretch
            a, b = _runs(flags)
            shifted = np.repeat(np.arange(len(rows)), counts + 1)
            starts = np.cumsum(counts + 1) - (counts + 1)
            who = shifted[a]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[who], h[who], g[who], first[who] + a - starts[who], first[who] + b - starts[who] + length)], names=[*DOC, "a", "b"])

    by_anchor = stretches.where(F.col("kinds") <= GATHERED).repartition("gram").sortWithinPartitions("gram")
    return by_anchor.mapInArrow(run, "doc long, h long, g long, a long, b long")


def counted(stretches: DataFrame, length: int, keep: str) -> DataFrame:
    """The same spans for anchors of very many stretches: their windows meet by hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(a, 256).to_pylist():
                    data = r["bytes"]
                    out += [(xxhash.xxh3_128_digest(data[i : i + length]), r["doc"], r["h"], r["g"], r["first"] + i) for i in range(len(data) - length + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), *[pa.int64()] * 4))], names=["window", *DOC, "at"])

    windows = stretches.where(F.col("kinds") > GATHERED).mapInArrow(run, "window binary, doc long, h long, g long, at long")
    windows = written(windows, "windows")
    shared = windows.groupBy("window").agg(F.min(F.struct(*DOC, "at")).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    hit = windows.join(shared, "window")
    if keep == "first":
        hit = hit.where(F.struct(*DOC, "at") != F.col("earliest"))
    return hit.select(*DOC, F.col("at").alias("a"), (F.col("at") + length).alias("b"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """(doc, h, g, spans): for each document with repeated windows, the byte spans that they cover (unordered, overlapping)."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    rows = keyed(docs, length)
    every = anchor_rows(rows, length)
    # counted by a struct of the hash, so that the join deals both sides anew and can split an anchor that very many share
    often = every.groupBy(F.struct("gram").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key.gram")
    found = written(every.join(often, "gram"), "anchors")

    earliest = F.min(F.struct(*DOC, "at", "first", "last")).alias("earliest")
    kinds = written(found.groupBy("gram", "stretch").agg(F.count("*").alias("n"), earliest), "kinds")
    # copies of whole stretches
    copied = found.join(kinds.where("n > 1").select("gram", "stretch", "earliest"), ["gram", "stretch"])
    if keep == "first":
        copied = copied.where(F.struct(*DOC, "at") != F.struct(*[F.col(f"earliest.{c}") for c in (*DOC, "at")]))
    spans = copied.select(*DOC, F.col("first").alias("a"), (F.col("last") + length).alias("b"))

    # anchors with several kinds of stretch: window by window
    several = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    firsts = kinds.join(several, "gram").select("gram", "n", "kinds", *[f"earliest.{c}" for c in DOC], "earliest.first", "earliest.last")
    stretches = written(stretch_bytes(firsts, rows, length), "stretches")
    spans = spans.union(matched(stretches, length, keep)).union(counted(stretches, length, keep))
    # a set: rows of one id and text send the same spans, so it is bounded by a document however often it repeats
    return spans.groupBy(*DOC).agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """The spans joined where they touch, in order."""
    if not spans:
        return []
    ab = np.array(sorted((s["a"], s["b"]) for s in spans))
    upto = np.maximum.accumulate(ab[:, 1])
    new = np.flatnonzero(np.concatenate([[True], ab[1:, 0] > upto[:-1]]))
    return list(zip(ab[new, 0].tolist(), upto[np.append(new[1:], len(ab)) - 1].tolist()))


def remaining(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def _with_spans(docs: DataFrame, columns: list[str], length: int, keep: str) -> DataFrame:
    """The columns, numbered ``c0``, ``c1``, .. so that no name of theirs clashes, and ``spans``."""
    numbered = [F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]
    keys = docs.select(*numbered, *key_columns())
    return keys.join(repeated_spans(docs, length, keep), DOC, "left").select(*[f"c{i}" for i in range(len(columns))], "spans")


def repeat_digests(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the checksum of the remaining bytes of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "c1"):
            out = []
            for data, spans in zip(texts(part, "c1"), part.column("spans").to_pylist()):
                joined = merged(spans)
                out.append((len(data), sum(b - a for a, b in joined), len(joined), hashlib.sha256(remaining(data, joined)).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([part.column("c0"), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text"), ["doc_id", "text"], length, keep)
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_characters(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the parts of characters at their edges."""
    out = []
    for a, b in spans:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def drop_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without later copies of passages (whole characters); those with no word left of a cut text go."""
    names, schema = docs.columns, docs.schema
    at = {c: f"c{i}" for i, c in enumerate(names)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, at["text"]):
            out, keep = [], []
            for text, data, spans in zip(part.column(at["text"]).to_pylist(), texts(part, at["text"]), part.column("spans").to_pylist()):
                cut = whole_characters(data, merged(spans))
                out.append(remaining(data, cut).decode() if cut else text)
                keep.append(not cut or bool(out[-1].strip()))
            new = {"text": pa.array(out, part.schema.field(at["text"]).type)}
            if "n_chars" in names:
                sizes = [len(t) if s else n for t, s, n in zip(out, part.column("spans").to_pylist(), part.column(at["n_chars"]).to_pylist())]
                new["n_chars"] = pa.array(sizes, part.schema.field(at["n_chars"]).type)
            yield pa.RecordBatch.from_arrays([new[c] if c in new else part.column(at[c]) for c in names], names=names).filter(pa.array(keep, pa.bool_()))

    return _with_spans(docs, names, length, "first").mapInArrow(run, schema)
