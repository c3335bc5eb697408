"""SentencePiece encoding and decoding by max-plus scans.

A text's encoding is the cut into vocabulary pieces of the largest total
score (equal totals: the longest last piece). Texts of one chunk are solved as
they are. A giant text is cut into chunks that separate tasks hold: the state
at a chunk's border is how many of the next chunk's characters a piece that
starts before the border takes, and a chunk is the matrix of best scores from
entry state to exit state. Matrices combine associatively (max, plus) by a
parallel scan into the best score of every border state; from these each chunk
finds, for every exit state, the entry state on the best way, these maps are
composed backwards, and each chunk is traced back on its own.

Characters without a piece become the vocabulary's byte pieces. No piece holds
the word sign behind another character, so every path passes the place before
a word sign that follows another character; a text of words is solved word by
word, and each distinct word once.

A null or empty text has no pieces. Rows are encoded each for itself, repeated
ones alike. The word sign itself, where a text holds it, decodes to a space.
Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import SLICE_BYTES, kept_in_worker, text_slices, written

#: Stands for a space.
SIGN = "▁"
#: Characters of a chunk.
CHUNK = 1 << 18
#: Distinct words whose pieces a worker keeps between texts.
CACHED_WORDS = 250_000
#: Characters up to which words are solved many at a time.
TOGETHER = 40
#: Score below the worst piece of a character without a piece.
UNKNOWN_PENALTY = 10.0
NEVER = -np.inf

ENCODED = "row long, doc_id long, chunk int, n_pieces long, score double, ids array<int>"


class Pieces:
    """A vocabulary file's pieces and scores, and the best cut of short texts."""

    def __init__(self, vocabulary: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=vocabulary)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.bytes_of: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.pieces[piece] = (i, model.get_score(i))
                self.bytes_of.append(piece.replace(SIGN, " ").encode())
        self.longest = max(map(len, self.pieces))
        #: Every start of a piece, with the piece that it is (or None).
        self.starts_of = {p[:k]: self.pieces.get(p[:k]) for p in self.pieces for k in range(1, len(p) + 1)}
        self._lattice_arrays()
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        #: Every path passes the place before a word sign behind another character.
        self.words_part = all(SIGN not in p.lstrip(SIGN) for p in self.pieces)
        # line breaks and tabs that no longer piece holds stand alone, too
        alone = "".join(c for c in "\n\r\t" if not any(c in p for p in self.pieces if len(p) > 1))
        self.word = re.compile(f"[{alone}]|{SIGN}*[^{SIGN}{alone}]+|{SIGN}+" if alone else f"{SIGN}*[^{SIGN}]+|{SIGN}+")
        self.forget()

    # ---- words, each distinct one solved once

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.lens, self.scores, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        return self.word.findall(text) if self.words_part else [text]

    def learn(self, words: list[str]) -> None:
        """Solve distinct new words: those of one length together, long ones and those with byte pieces one by one."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        single = [w for n in by_size if n > TOGETHER for w in by_size[n]]
        for n, group in by_size.items():
            if n <= TOGETHER:
                ids, lens, scores = self.solve_same_length(group, n)
                plain = lens > 0
                self._add([w for w, ok in zip(group, plain.tolist()) if ok], ids, lens[plain], scores[plain])
                single += [w for w, ok in zip(group, plain.tolist()) if not ok]
        if single:
            solved = [self.solve(w) for w in single]
            lens = np.fromiter((len(ids) for ids, _ in solved), np.int64, len(solved))
            self._add(single, np.fromiter((i for ids, _ in solved for i in ids), np.int32, int(lens.sum())), lens, np.array([x for _, x in solved]))

    def _add(self, words: list[str], ids: np.ndarray, lens: np.ndarray, scores: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.scores = np.concatenate([self.scores, scores])
        self.flat = np.concatenate([self.flat, ids])
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))

    def _lattice_arrays(self) -> None:
        """The starts of pieces as a numbered tree: keys (node, character) in order, the node behind, and each node's piece."""
        number = {"": 0} | {start: i + 1 for i, start in enumerate(self.starts_of)}
        signs = sorted({c for start in self.starts_of for c in start[-1]})
        self.sign_of = np.zeros(0x110000, np.int64)  # 0: in no piece
        self.sign_of[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.n_signs = len(signs) + 1
        keys = np.array([number[x[:-1]] * self.n_signs + self.sign_of[ord(x[-1])] for x in self.starts_of])
        order = np.argsort(keys)
        self.keys, self.behind = keys[order], np.arange(1, len(keys) + 1)[order]
        self.piece_of = np.array([-1] + [hit[0] if hit else -1 for hit in self.starts_of.values()], np.int32)
        self.score_of = np.array([NEVER] + [hit[1] if hit else NEVER for hit in self.starts_of.values()])

    def solve_same_length(self, words: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all best cuts, and each word's number of ids (0: it needs byte pieces) and score."""
        n = len(words)
        signs = self.sign_of[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)].reshape(n, size)
        best = np.full((n, size + 1), NEVER)
        back, piece = np.zeros((n, size + 1), np.int64), np.full((n, size + 1), -1, np.int32)
        best[:, 0] = 0
        for i in range(size):
            rows, node = np.arange(n), np.zeros(n, np.int64)
            for j in range(i + 1, min(i + self.longest, size) + 1):
                key = node * self.n_signs + signs[rows, j - 1]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                on = self.keys[at] == key
                rows, node = rows[on], self.behind[at[on]]
                if not len(rows):
                    break
                score = best[rows, i] + self.score_of[node]
                better = score > best[rows, j]
                r = rows[better]
                best[r, j], back[r, j], piece[r, j] = score[better], i, self.piece_of[node[better]]
        # a place that no piece reaches, or a character without a piece, is left to the byte pieces
        able = (best > NEVER).all(1) & self._all_single(signs)
        ids, place, rows = np.full((n, size), -1, np.int32), np.full(n, size), np.flatnonzero(able)
        for k in range(size):
            ids[rows, k] = piece[rows, place[rows]]
            place[rows] = back[rows, place[rows]]
            rows = rows[place[rows] > 0]
            if not len(rows):
                break
        ordered = ids[:, ::-1]
        return ordered[ordered >= 0], (ids >= 0).sum(1), best[:, size]

    def _all_single(self, signs: np.ndarray) -> np.ndarray:
        """Whether every character of each word is a piece (else its byte pieces compete)."""
        at = np.minimum(np.searchsorted(self.keys, signs), len(self.keys) - 1)
        return ((self.keys[at] == signs) & (self.piece_of[self.behind[at]] >= 0)).all(1)

    def encode(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's number of ids and total score."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        words: list[str] = []
        counts = np.zeros(len(marked) + 1, np.int64)
        for i, text in enumerate(marked):
            words += self.words(text)
            counts[i + 1] = len(words)
        found = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        if len(gaps := np.flatnonzero(found < 0)):
            new = [words[i] for i in gaps.tolist()]
            self.learn(list(dict.fromkeys(new)))
            found[gaps] = [self.index[w] for w in new]
        lens = self.lens[found]
        upto = np.concatenate([[0], np.cumsum(lens)])
        ids = self.flat[np.repeat(self.starts[found] - upto[:-1], lens) + np.arange(int(upto[-1]))]
        scores = np.array([self.scores[found[a:b]].sum() for a, b in zip(counts, counts[1:])])
        return ids, np.diff(upto[counts]), scores

    # ---- the lattice

    def run(self, text: str, upto: int, entry: dict[int, float]) -> tuple[list[float], list[int]]:
        """Best score and last start of every place, over pieces that start before ``upto``; -1 marks an entry."""
        size = min(len(text), upto + self.longest - 1)
        best, back = [NEVER] * (size + 1), [-2] * (size + 1)
        for place, score in entry.items():
            if place <= size and score > best[place]:
                best[place], back[place] = score, -1
        starts_of, unknown = self.starts_of, self.unknown
        for i in range(min(upto, size)):
            base = best[i]
            if base == NEVER:
                continue
            for j in range(i + 1, size + 1):
                hit = starts_of.get(text[i:j], 0)
                if hit:
                    score = base + hit[1]
                elif j == i + 1:  # a character without a piece
                    score = base + unknown
                elif hit is None:
                    continue
                else:
                    break
                if score > best[j]:
                    best[j], back[j] = score, i
                if hit == 0:
                    break
        return best, back

    def trace(self, text: str, back: list[int], end: int) -> tuple[list[int], int]:
        """Ids of the best way to ``end`` and the entry place it comes from."""
        out: list[int] = []
        while back[end] >= 0:
            start = back[end]
            hit = self.pieces.get(text[start:end])
            out += [hit[0]] if hit else [self.byte_ids[b] for b in reversed(text[start:end].encode())]
            end = start
        return out[::-1], end

    def solve(self, text: str) -> tuple[list[int], float]:
        hit = self.pieces.get(text)
        if len(text) == 1 and hit:
            return [hit[0]], hit[1]
        best, back = self.run(text, len(text), {0: 0.0})
        return self.trace(text, back, len(text))[0], best[len(text)]

    # ---- chunks

    def cuts(self, text: str, first: int, upto: int) -> tuple[int, int] | None:
        """The first and the last place in [first, upto) that every path passes."""
        if not self.words_part:
            return None
        found = [m.start() + 1 for m in re.finditer(f"[^{SIGN}]{SIGN}", text[:upto]) if m.start() + 1 >= first]
        return (found[0], found[-1]) if found else None

    def matrix(self, text: str, upto: int) -> np.ndarray:
        """Best score from each entry state to each exit state of the chunk text[:upto] (the rest lies ahead)."""
        states = self.longest
        out = np.full((states, states), NEVER)
        cuts = self.cuts(text, states - 1, upto)
        if cuts is None:
            for s in range(min(states, upto + 1)):
                best, _ = self.run(text, upto, {s: 0.0})
                for t, score in enumerate(best[upto : upto + states]):
                    out[s, t] = score
            for s in range(upto, states):  # a chunk shorter than a piece: the piece goes on behind it
                out[s, s - upto] = 0.0
            return out
        first, last = cuts
        middle = self.run(text[first:last], last - first, {0: 0.0})[0][last - first] if last > first else 0.0
        tail, _ = self.run(text[last:], upto - last, {0: 0.0})
        for s in range(states):
            head = self.run(text[:first], first, {s: 0.0})[0][first]
            for t, score in enumerate(tail[upto - last : upto - last + states]):
                out[s, t] = head + middle + score
        return out

    def chunk(self, text: str, upto: int, entry: np.ndarray) -> tuple[list[float], list[int]]:
        """The lattice of a chunk whose entry states have the given scores."""
        return self.run(text, upto, {s: float(x) for s, x in enumerate(entry) if x > NEVER})

    def entries(self, text: str, upto: int, entry: np.ndarray) -> list[int]:
        """The entry state on the best way to each exit state (-1: none)."""
        best, back = self.chunk(text, upto, entry)
        out = []
        for t in range(self.longest):
            at = upto + t
            reached = at < len(best) and best[at] > NEVER
            if not reached:
                out.append(-1)
                continue
            while back[at] >= 0:
                at = back[at]
            out.append(at)
        return out


def max_plus_scan(matrices: np.ndarray) -> np.ndarray:
    """Products M0, M0 M1, M0 M1 M2, ... of (k, n, n) matrices, in log2(k) rounds of independent products."""
    out, step = matrices.copy(), 1
    while step < len(out):
        left, right = out[:-step].copy(), out[step:].copy()
        for i in range(len(left)):
            out[step + i] = (left[i][:, :, None] + right[i][None, :, :]).max(1)
        step *= 2
    return out


def worker_pieces(vocabulary: str) -> Pieces:
    """One vocabulary per worker process: later tasks find its words."""
    return kept_in_worker(("pieces", vocabulary), lambda: Pieces(vocabulary))


def marked(text: str) -> str:
    """The text as the pieces see it: word signs for spaces, and one before it."""
    return SIGN + text.replace(" ", SIGN) if text else ""


def _encoded(part: pa.RecordBatch, chunks: list[int], ids: np.ndarray, counts: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids, pa.int32()))
    return pa.RecordBatch.from_arrays(
        [part.column("row"), part.column("doc_id"), pa.array(chunks, pa.int32()), pa.array(counts, pa.int64()), pa.array(scores, pa.float64()), lists],
        names=["row", "doc_id", "chunk", "n_pieces", "score", "ids"],
    )


def encode(docs: DataFrame, vocabulary: str, chunk: int = CHUNK) -> DataFrame:
    """Pieces of each text: one row per text, or per chunk of a giant one (``row`` tells texts apart)."""
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    giant = F.coalesce(F.char_length("text"), F.lit(0)) >= chunk

    def small(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, row = worker_pieces(vocabulary), TaskContext.get().partitionId() << 40
        for part in text_slices(batches, budget=2 * SLICE_BYTES):  # more new words at once
            ids, counts, scores = pieces.encode([marked(x or "") for x in part.column("text").to_pylist()])
            keyed = pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + part.num_rows)), part.column("doc_id")], names=["row", "doc_id"])
            row += part.num_rows
            yield _encoded(keyed, [0] * part.num_rows, ids, counts, scores)

    return rows.where(~giant).mapInArrow(small, ENCODED).union(_encode_giants(rows.where(giant), vocabulary, chunk))


def _encode_giants(giants: DataFrame, vocabulary: str, chunk: int) -> DataFrame:
    """The chunks of giant texts, solved by scans over their border states."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead = worker_pieces(vocabulary).longest - 1
        row = -(TaskContext.get().partitionId() << 40) - 1
        for part in text_slices(batches):
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                whole = marked(text)
                for k, a in enumerate(range(0, len(whole), chunk)):
                    columns = [[row], [doc], [k], [min(chunk, len(whole) - a)], [whole[a : a + chunk + ahead]]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=["row", "doc_id", "chunk", "size", "text"])
                row -= 1

    chunks = written(giants.mapInArrow(cut, "row long, doc_id long, chunk int, size int, text string").repartition("row", "chunk"), "chunks")

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(vocabulary)
        for part in text_slices(batches):
            out = [pieces.matrix(t, n).ravel() for t, n in zip(part.column("text").to_pylist(), part.column("size").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("chunk"), pa.array(out, pa.list_(pa.float64()))], names=["row", "chunk", "matrix"])

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        """Best score of each entry state of each chunk of one text (a row's 2 GB are 8,000 chunks at most)."""
        pdf = pdf.sort_values("chunk")
        n = int(np.sqrt(len(pdf["matrix"].iloc[0])))
        upto = max_plus_scan(np.array(pdf["matrix"].tolist()).reshape(-1, n, n))
        start = np.full(n, NEVER)
        start[0] = 0.0
        return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "entry": [start, *upto[:-1, 0]]})

    borders = written(chunks.mapInArrow(matrices, "row long, chunk int, matrix array<double>").groupBy("row").applyInPandas(scan, "row long, chunk int, entry array<double>"), "borders")
    placed = chunks.join(borders, ["row", "chunk"])

    def ways(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(vocabulary)
        for part in text_slices(batches):
            rows = zip(part.column("text").to_pylist(), part.column("size").to_pylist(), part.column("entry").to_pylist())
            out = [pieces.entries(t, n, np.array(e)) for t, n, e in rows]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("chunk"), pa.array(out, pa.list_(pa.int32()))], names=["row", "chunk", "ways"])

    def backwards(pdf: pd.DataFrame) -> pd.DataFrame:
        """The exit state of each chunk on the best way through one text."""
        pdf = pdf.sort_values("chunk", ascending=False)
        exits, state = [], 0
        for way in pdf["ways"]:
            exits.append(state)
            state = way[state]
        return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "exit": exits})

    exits = placed.mapInArrow(ways, "row long, chunk int, ways array<int>").groupBy("row").applyInPandas(backwards, "row long, chunk int, exit int")

    def trace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(vocabulary)
        for part in text_slices(batches):
            ids, counts, scores = [], [], []
            for text, n, entry, end in zip(*(part.column(c).to_pylist() for c in ("text", "size", "entry", "exit"))):
                best, back = pieces.chunk(text, n, np.array(entry))
                own, start = pieces.trace(text, back, n + end)
                ids += own
                counts.append(len(own))
                scores.append(best[n + end] - entry[start])
            yield _encoded(part, part.column("chunk").to_pylist(), np.array(ids, np.int32), np.array(counts), np.array(scores))

    return placed.join(exits, ["row", "chunk"]).mapInArrow(trace, ENCODED)


class _Texts:
    """The bytes of the pieces in one array, to put texts together from ids."""

    def __init__(self, pieces: Pieces) -> None:
        self.lens = np.array([len(x) for x in pieces.bytes_of])
        self.flat = np.frombuffer(b"".join(pieces.bytes_of), np.uint8)
        self.starts = np.cumsum(self.lens) - self.lens

    def of(self, part: pa.RecordBatch) -> list[bytes]:
        """The text of each row's ids; the space before a text's first word is dropped."""
        ids = np.asarray(part.column("ids").flatten(), np.int64)
        lens = self.lens[ids]
        upto = np.concatenate([[0], np.cumsum(lens)])
        text = self.flat[np.repeat(self.starts[ids] - upto[:-1], lens) + np.arange(int(upto[-1]))].tobytes()
        ends = upto[np.concatenate([[0], np.cumsum(np.asarray(part.column("n_pieces")))])].tolist()
        return [text[p + (k == 0) : q] if q > p else b"" for p, q, k in zip(ends, ends[1:], part.column("chunk").to_pylist())]


def _few(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            yield batch.slice(a, 256)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The text of each row's ids (UTF-8) beside its columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts(worker_pieces(vocabulary))
        for part in _few(batches):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts.of(part), pa.binary())], names=[*part.schema.names, "text"])

    return encoded.mapInArrow(run, f"{ENCODED}, text binary")


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the one of crc32, highest bit first as crc32 has them."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ 0xEDB88320 if b & 1 else b >> 1
    return out


def crc32_joined(first: int, second: int, n: int) -> int:
    """crc32 of two byte strings in a row, from theirs and the length of the second."""
    power, square, bits = 1 << 31, 1 << 30, 8 * n
    while bits:
        if bits & 1:
            power = _times(square, power)
        square, bits = _times(square, square), bits >> 1
    return _times(power, first) ^ second


DIGESTS = "doc_id long, chunk int, n_pieces long, score double, ids_crc32 long, n_bytes long, text_crc32 long"


def digests(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, chunk (0), n_pieces, score, checksums of ids (little-endian unsigned 32 bits) and of the bytes decoded from them.

    One row per text: the chunks of a giant one are joined in their order.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _Texts(worker_pieces(vocabulary))
        for part in _few(batches):
            ids, counts = np.asarray(part.column("ids").flatten()).astype("<u4"), np.asarray(part.column("n_pieces"))
            ends = np.concatenate([[0], np.cumsum(counts)])
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            text = texts.of(part)
            columns = [part.column(c) for c in ("row", "doc_id", "chunk", "n_pieces", "score")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(crc, pa.int64()), pa.array([len(t) for t in text], pa.int64()), pa.array([zlib.crc32(t) for t in text], pa.int64())],
                names=["row", "doc_id", "chunk", "n_pieces", "score", "ids_crc32", "n_bytes", "text_crc32"],
            )

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, chunks in zip(batch.column("doc_id").to_pylist(), batch.column("chunks").to_pylist()):
                ids_crc, text_crc = chunks[0]["ids_crc32"], chunks[0]["text_crc32"]
                for c in chunks[1:]:
                    ids_crc = crc32_joined(ids_crc, c["ids_crc32"], 4 * c["n_pieces"])
                    text_crc = crc32_joined(text_crc, c["text_crc32"], c["n_bytes"])
                n_pieces, score, n_bytes = (sum(c[k] for c in chunks) for k in ("n_pieces", "score", "n_bytes"))
                out.append((doc, 0, n_pieces, score, ids_crc, n_bytes, text_crc))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in DIGESTS.split(", ")])

    # rows meet by number, and only digests travel: 8,000 chunks of a text at most
    chunks = F.sort_array(F.collect_list(F.struct("chunk", "n_pieces", "score", "ids_crc32", "n_bytes", "text_crc32"))).alias("chunks")
    return encoded.mapInArrow(run, f"row long, {DIGESTS}").groupBy("row").agg(F.max("doc_id").alias("doc_id"), chunks).mapInArrow(join, DIGESTS)
