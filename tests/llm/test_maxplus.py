import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from sentencepiece import SentencePieceProcessor

from apportion.llm import maxplus
from apportion.llm.common import tokenizer_folder

VOCABULARY = f"{tokenizer_folder()}/piece_bpe_32k.model"


def _number(data, at):
    out = shift = 0
    while True:
        byte = data[at]
        out |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return out, at


def reference():
    """The library's own best-score cut: the same file read as a unigram model (model type, field 3 of the trainer settings, set to 1)."""
    data = open(VOCABULARY, "rb").read()
    out, at = bytearray(data), 0
    while at < len(data):
        tag, at = _number(data, at)
        size, at = _number(data, at)
        end = at + size
        while tag >> 3 == 2 and at < end:
            field, at = _number(data, at)
            if field & 7 == 0:
                if field >> 3 == 3:
                    out[at] = 1
                _, at = _number(data, at)
            elif field & 7 == 2:
                n, at = _number(data, at)
                at += n
            else:
                at += 4 if field & 7 == 5 else 8
        at = end
    return SentencePieceProcessor(model_proto=bytes(out))


def samples(n):
    rng = random.Random(3)
    return ["".join(rng.choice("abcdeTthe  hing\n.é漢▁ÿ😀") for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_best_cut_is_the_librarys():
    pieces, library = maxplus.Pieces(VOCABULARY), reference()
    compared = 0
    for text in samples(600):
        ids, _, (score,) = pieces.encode([maxplus.marked(text)])
        if score > -(1 << 24):  # the library adds in single precision, exact up to there
            assert ids.tolist() == library.encode(text)
            compared += 1
    assert compared > 40


def test_scan_over_chunks_is_the_whole_cut():
    pieces = maxplus.Pieces(VOCABULARY)
    for parts in (True, False):  # with and without places that every path passes
        pieces.words_part = parts
        for text in samples(40):
            whole = maxplus.marked(text)
            ids, total = pieces.solve(whole) if whole else ([], 0.0)
            for size in (1, 3, 7, 20) if whole else ():
                chunks = [(whole[a : a + size + pieces.longest - 1], min(size, len(whole) - a)) for a in range(0, len(whole), size)]
                upto = maxplus.max_plus_scan(np.array([pieces.matrix(*c) for c in chunks]))
                assert abs(upto[-1][0, 0] - total) < 1e-5
                start = np.full(pieces.longest, maxplus.NEVER)
                start[0] = 0
                entries = [start, *upto[:-1, 0]]
                state, exits = 0, []
                for chunk, entry in zip(reversed(chunks), reversed(entries)):
                    exits.append(state)
                    state = pieces.entries(*chunk, entry)[state]
                got = []
                for (t, n), entry, end in zip(chunks, entries, reversed(exits)):
                    got += pieces.trace(t, pieces.chunk(t, n, entry)[1], n + end)[0]
                assert got == ids


def joined(decoded):
    """(doc_id, ids, text) of each text, its chunks in order."""
    groups = defaultdict(list)
    for r in decoded.collect():
        groups[r.row].append(r)
    out = Counter()
    for rows in groups.values():
        rows.sort(key=lambda r: r.chunk)
        assert [r.chunk for r in rows] == list(range(len(rows))) and all(len(r.ids) == r.n_pieces for r in rows)
        out[rows[0].doc_id, tuple(i for r in rows for i in r.ids), b"".join(bytes(r.text) for r in rows)] += 1
    return out


def test_odd_rows_whole_and_in_chunks(odd_docs, odd_texts, clashing):
    pieces = maxplus.Pieces(VOCABULARY)
    expected = Counter((i, tuple(pieces.encode([maxplus.marked(t or "")])[0].tolist()), (t or "").replace("▁", " ").encode()) for i, t in odd_texts)
    assert joined(maxplus.decode(maxplus.encode(odd_docs, VOCABULARY), VOCABULARY)) == expected
    assert joined(maxplus.decode(maxplus.encode(clashing, VOCABULARY, chunk=500), VOCABULARY)) == expected


def test_digests(odd_docs, odd_texts):
    got = maxplus.digests(maxplus.encode(odd_docs, VOCABULARY), VOCABULARY).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((i, zlib.crc32((t or "").replace("▁", " ").encode())) for i, t in odd_texts)


def test_digests_of_giants_are_of_the_whole_text(odd_docs, odd_texts):
    pieces = maxplus.Pieces(VOCABULARY)
    expected = Counter()
    for i, t in odd_texts:
        ids, _, (score,) = pieces.encode([maxplus.marked(t or "")])
        text = (t or "").replace("▁", " ").encode()
        expected[i, 0, len(ids), round(score, 3), zlib.crc32(ids.astype("<u4").tobytes()), len(text), zlib.crc32(text)] += 1
    for chunk in (500, maxplus.CHUNK):
        got = maxplus.digests(maxplus.encode(odd_docs, VOCABULARY, chunk=chunk), VOCABULARY).collect()
        assert Counter((r.doc_id, r.chunk, r.n_pieces, round(r.score, 3), r.ids_crc32, r.n_bytes, r.text_crc32) for r in got) == expected


def test_no_rows(no_docs):
    assert maxplus.digests(maxplus.encode(no_docs, VOCABULARY), VOCABULARY).collect() == []
