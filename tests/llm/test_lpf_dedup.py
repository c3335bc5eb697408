import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import prose

from apportion.llm import lpf_dedup
from apportion.llm.lpf_dedup import drop_repeats, previous_and_next, repeat_digests, repeated_spans, suffix_ranks, text_hashes


def brute(rows, length, keep):
    """Digests by all windows; rows are (doc_id, order among texts of an id, bytes)."""
    count, first = Counter(), {}
    for i, h, data in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        for a in range(len(data) - length + 1):
            w = data[a : a + length]
            count[w] += 1
            first.setdefault(w, (i, h, a))
    out = Counter()
    for i, h, data in rows:
        gone = np.zeros(len(data) + 1, bool)
        for a in range(len(data) - length + 1):
            w = data[a : a + length]
            if count[w] > 1 if keep == "none" else first[w] != (i, h, a):
                gone[a : a + length] = True
        gone = gone[:-1]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i, len(data), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()] += 1
    return out


def given(docs):
    h, g = text_hashes(docs.text)
    return [(r.doc_id, (r.h, r.g), (r.text or "").encode()) for r in docs.select("doc_id", "text", h.alias("h"), g.alias("g")).collect()]


def got(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("gathered", [lpf_dedup.GATHERED, 1])
def test_odd_rows(spark, odd_docs, clashing, monkeypatch, keep, gathered):
    monkeypatch.setattr(lpf_dedup, "GATHERED", gathered)
    monkeypatch.setattr(lpf_dedup, "BLOCK", 4000)
    expected = brute(given(odd_docs), 200, keep)
    assert got(repeat_digests(odd_docs, keep=keep)) == expected
    assert got(repeat_digests(clashing, keep=keep)) == expected


@pytest.mark.parametrize("keep", ["none", "first"])
def test_edited_copies(spark, keep):
    """Passages of all lengths around the limit, overlapping, inside one document and across."""
    rng, pool, rows = random.Random(4), [prose(k, 80) for k in range(6)], []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            source = rng.choice(pool)
            a = rng.randrange(len(source) - 60)
            parts += [source[a : a + rng.choice([100, 199, 200, 201, 260, 400])], prose(1000 + i, rng.randint(0, 5))]
        rows.append((i, "é".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(repeat_digests(docs, keep=keep)) == brute(given(docs), 200, keep)


def test_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(repeat_digests(docs)) == brute(given(docs), 200, "none")


def test_factors_against_definition():
    """Flags of windows are those of the longest previous and next factor arrays."""
    rng = random.Random(7)
    data = bytes(rng.choice(b"ab") for _ in range(400))
    length, n = 8, 393
    before, behind = previous_and_next(suffix_ranks(np.frombuffer(data, np.uint8), np.arange(n), length), np.zeros(n, np.int64), np.arange(n))

    def common(i, j):
        k = 0
        while max(i, j) + k < len(data) and data[i + k] == data[j + k]:
            k += 1
        return k

    assert before.tolist() == [max((common(i, j) for j in range(i)), default=0) >= length for i in range(n)]
    assert behind.tolist() == [max((common(i, j) for j in range(i + 1, n)), default=0) >= length for i in range(n)]


def test_pipeline_form(spark, clashing, no_docs):
    passage = prose(1, 80)
    rows = [(2, f"{prose(2, 20)} {passage} é", 5), (1, f"ünd {passage}", 7), (3, passage, 9), (4, "clean text.", None), (5, None, None), (6, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in drop_repeats(docs).collect()}
    assert set(out) == {1, 2, 4, 5, 6}  # nothing is left of 3
    assert out[1].text == f"ünd {passage}" and out[1].n_chars == 7
    assert passage[50:-50] not in out[2].text and prose(2, 20)[:-1] in out[2].text and out[2].n_chars == len(out[2].text)
    assert out[5].text is None and out[6].text == ""
    assert drop_repeats(clashing).columns == clashing.columns and drop_repeats(no_docs).collect() == []
    assert repeat_digests(no_docs).collect() == []


@pytest.mark.parametrize("keep", ["none", "first"])
def test_texts_of_one_id_are_told_apart_by_all_bits(spark, monkeypatch, keep):
    """Null and equal ids whose texts agree in half of the hash."""
    monkeypatch.setattr(lpf_dedup, "text_hashes", lambda text: (F.lit(5).cast("long"), F.xxhash64(F.lit(1), text)))
    passage, other = prose(1, 60), prose(2, 90)
    rows = [(None, f"{passage} {prose(3, 30)}"), (None, f"{prose(4, 70)} {passage[:250]}"), (None, other), (7, f"{other[20:300]}!"), (7, f"? {passage}"), (7, prose(9, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    h, g = lpf_dedup.text_hashes(docs.text)
    own = [(r.doc_id, (5, r.g), r.text.encode()) for r in docs.select("doc_id", "text", g.alias("g")).collect()]
    assert got(repeat_digests(docs, keep=keep)) == brute(own, 200, keep)


def test_spans_do_not_grow_with_repeated_rows(spark):
    text = prose(1, 300)
    docs = spark.createDataFrame([(None, text)] * 200 + [(1, text[100:900])], "doc_id long, text string").repartition(4)
    assert repeated_spans(docs, 200, "none").agg(F.max(F.size("spans"))).first()[0] <= len(text)
    rows = got(repeat_digests(docs))
    assert rows == brute(given(docs), 200, "none") and sum(rows.values()) == 201


def test_columns_named_like_its_own(spark):
    passage = prose(1, 80)
    docs = spark.createDataFrame([(1, passage, 1, 2, 3, 4), (2, f"a {passage} b", 5, 6, 7, 8)], "doc_id long, text string, __doc int, __h int, spans int, c0 int")
    kept = {r.doc_id: r for r in drop_repeats(docs).collect()}
    assert drop_repeats(docs).columns == docs.columns and kept[1].text == passage and kept[2].c0 == 8 and len(kept[2].text) < 20
