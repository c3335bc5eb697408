"""Power-of-two packing.

A document's token ids are cut into pieces whose lengths are the binary
decomposition of its length: full sequences first, then one piece for each
binary digit of the rest. A piece is a sequence of its own, so no sequence
crosses documents and none is padded; pieces of one length form a bucket that
a trainer batches together.

A null or empty text has the closing id alone. Repeated rows give pieces of
their own. Extra columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from apportion.llm.common import kept_in_worker, text_slices, texts

#: Words whose ids a worker keeps between texts.
CACHED_WORDS = 1_000_000
#: Stands for the closing id among the words (no word holds a line break).
END = b"\n"
#: A word and the marks behind its last ASCII letter (no apostrophe, and none of the signs of special tokens).
_STEM = re.compile(rb"(?s)(.*[A-Za-z])([!-&(-/:;=?@\[-`{}~]+)|(.*)")


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array with room for ``n`` rows, at least doubled when it grows."""
    if n <= len(array):
        return array
    out = np.zeros((max(n, 2 * len(array)), *array.shape[1:]), array.dtype)
    out[: len(array)] = array
    return out


class WordIds:
    """Token ids of words, each distinct word encoded once.

    The tokenizer drops white space and merges inside words only, so a text's
    ids are those of its words (runs without ASCII white space) in order. A
    word is a stem and the marks behind it; stems of letters alone are encoded
    many at a time, as each ends with the first id that closes a word.
    """

    def __init__(self, vocabulary: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.end_id = end_id
        # for stems of a-z alone, which the normaliser and the letter rules leave as they are
        self.plain = Tokenizer.from_file(vocabulary)
        self.plain.normalizer, self.plain.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        known = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(known.values()) + 1, bool)
        self.closes[[i for piece, i in known.items() if piece.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        # word -> row; a row has its stem's ids and the row of the marks behind it; row 0 is empty
        self.index: dict[bytes, int] = {b"": 0, END: 1}
        self.rows = np.zeros((1 << 12, 3), np.int64)  # start and length of the stem's ids, row of the marks
        self.rows[1, 1] = 1
        self.flat, self.n_ids = np.zeros(1 << 12, np.uint32), 1
        self.flat[0] = self.end_id

    def add(self, words: list[bytes], rows: np.ndarray) -> None:
        n = len(self.index)
        self.rows = _room(self.rows, n + len(words))
        self.rows[n : n + len(words)] = rows
        self.index.update(zip(words, range(n, n + len(words))))

    def add_stems(self, stems: list[bytes], ids: np.ndarray, lens: np.ndarray) -> None:
        self.add(stems, np.stack([self.n_ids + np.cumsum(lens) - lens, lens, np.zeros_like(lens)], axis=1))
        self.flat = _room(self.flat, self.n_ids + len(ids))
        self.flat[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)

    def learn_joined(self, tokenizer, new: list[bytes]) -> bool:
        """Learn stems of letters many at a time; False if they cannot be told apart."""
        joined = tokenizer.encode_batch_fast([b" ".join(new[a : a + 2000]).decode() for a in range(0, len(new), 2000)], add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(x.ids, np.uint32) for x in joined)])
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(new) or len(ends) and ends[-1] != len(ids):
            return False
        self.add_stems(new, ids, np.diff(ends, prepend=0))
        return True

    def learn_stems(self, new: list[bytes]) -> None:
        plain = [x for x in new if x.isalpha() and x.islower()]  # of bytes: a-z alone
        rest = [x for x in new if not (x.isalpha() and x.islower())]
        letters = [x for x in rest if x.decode().isalpha()]
        others = [x for x in rest if not x.decode().isalpha()]
        for tokenizer, stems in ((self.plain, plain), (self.tokenizer, letters)):
            if not self.learn_joined(tokenizer, stems):
                others = others + stems
        got = [x.ids for x in self.tokenizer.encode_batch_fast([x.decode() for x in others], add_special_tokens=False)]
        lens = np.fromiter(map(len, got), np.int64, len(got))
        self.add_stems(others, np.fromiter((i for x in got for i in x), np.uint32, int(lens.sum())), lens)

    def learn(self, words: list[bytes]) -> None:
        """Learn distinct new words: closing marks are a token run of their own behind an ASCII letter."""
        stems: dict[bytes, None] = {}
        whole, first, last = [], [], []
        for w in words:
            m = _STEM.fullmatch(w)
            if m[1] is None:
                stems[w] = None
            else:
                stem, marks = m.group(1, 2)
                stems[stem] = stems[marks] = None
                whole.append(w)
                first.append(stem)
                last.append(marks)
        self.learn_stems([x for x in stems if x not in self.index])
        if whole:
            own = np.fromiter(map(self.index.__getitem__, first), np.int64, len(whole))
            behind = np.fromiter(map(self.index.__getitem__, last), np.int64, len(whole))
            rows = self.rows[own]
            rows[:, 2] = behind
            self.add(whole, rows)

    def encode(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the documents, each closed by the end id, and each document's number of ids."""
        if len(self.index) > CACHED_WORDS:
            self.forget()
        words: list[bytes] = []
        ends = np.empty(len(docs), np.int64)
        for i, text in enumerate(docs):
            # the tokenizer lowers letters itself, except in the names of its special tokens
            words += text.split() if b"<|" in text else text.lower().split()
            words.append(END)
            ends[i] = len(words)
        found = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        if len(gaps := np.flatnonzero(found < 0)):
            new = [words[i] for i in gaps.tolist()]
            self.learn(list(dict.fromkeys(new)))
            found[gaps] = [self.index[w] for w in new]
        rows = self.rows[np.stack([found, self.rows[found, 2]], axis=1).ravel()]
        lens = rows[:, 1]
        upto = np.cumsum(lens)
        ids = self.flat[np.repeat(rows[:, 0] - (upto - lens), lens) + np.arange(int(upto[-1]))]
        return ids, np.diff(upto[2 * ends - 1], prepend=0)


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as a sum of powers of two of at most ``longest``, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_power_of_two(docs: DataFrame, vocabulary: str, end_id: int = 2, longest: int = 4096, with_ids: bool = True) -> DataFrame:
    """One row per piece: its document's id, place, length, bucket (log2 of the length), sequence and (``with_ids``) ids.

    ``longest`` is a power of two. Sequence ids number the pieces of each input
    partition; they are repeated exactly when a task is run again.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence is a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket int" + ", ids array<int>" * with_ids

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = kept_in_worker(("packing", vocabulary, end_id), lambda: WordIds(vocabulary, end_id)), TaskContext.get().partitionId() << 40
        for part in text_slices(batches):
            ids, counts = encoder.encode(texts(part))
            rows: list[tuple] = []
            base = 0
            for doc, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                start = 0
                for length in binary_lengths(n, longest):
                    piece = ids[base + start : base + start + length]
                    row = (doc, start, length, zlib.crc32(piece.astype("<u4").tobytes()), n, sequence, 0, length.bit_length() - 1)
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    start += length
                    sequence += 1
                base += n
            columns = [pa.array(x, pa.int64()) for x in list(zip(*rows))[:7]]
            columns.append(pa.array([r[7] for r in rows], pa.int32()))
            if with_ids:
                columns.append(pa.array([r[8] for r in rows], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, schema)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length."""
    pieces.write.partitionBy("bucket").parquet(path)
