import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from apportion.llm.common import shared_folder, tokenizer_folder
from apportion.llm.packing import binary_lengths, pack_power_of_two, write_buckets

VOCABULARY = f"{tokenizer_folder()}/word_bpe_49k.json"


def expected(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t in texts)


def rebuilt(rows):
    """Documents put together from their pieces (rows of one id in order of their sequences)."""
    docs, left = defaultdict(list), []
    for r in sorted(rows, key=lambda r: r.sequence_id):
        assert len(r.ids) == r.length and r.length & (r.length - 1) == 0 and r.length <= 4096 and r.offset == 0 and r.bucket == r.length.bit_length() - 1
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        if r.start == 0:
            docs[r.doc_id].append([])
        held = docs[r.doc_id][-1]
        assert r.start == len(held)
        held += r.ids
        left.append((r.doc_id, len(held), r.doc_tokens))
    return Counter((i, tuple(x)) for i, xs in docs.items() for x in xs)


def test_odd_rows(odd_docs, odd_texts, clashing):
    for docs in (odd_docs, clashing):
        rows = pack_power_of_two(docs, VOCABULARY).collect()
        assert rebuilt(rows) == expected(odd_texts)
        assert len({r.sequence_id for r in rows}) == len(rows)


def test_ids_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert rebuilt(pack_power_of_two(docs, VOCABULARY).collect()) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_normalised_texts(spark):
    texts = [(k, t) for k, t in enumerate(["ÁB Café, K's, <|endoftext|>. x<|ENDOFTEXT|>,", "\t\x0b a\u0085b 　 it's.", "İ, ſ. 12,3. ǅ, Σ. ΑΣ, don't!? é.", "'s, 's. a.b., ,,.", "가 각 ㅎ"])]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert rebuilt(pack_power_of_two(docs, VOCABULARY).collect()) == expected(texts)


def test_lengths():
    assert binary_lengths(4096 * 2 + 13, 4096) == [4096, 4096, 8, 4, 1]
    assert binary_lengths(1, 4096) == [1]


def test_no_rows_and_wrong_length(no_docs):
    assert pack_power_of_two(no_docs, VOCABULARY).collect() == []
    with pytest.raises(ValueError):
        pack_power_of_two(no_docs, VOCABULARY, longest=1000)


def test_buckets_on_disk(spark, odd_docs):
    path = shared_folder(spark, "buckets")
    write_buckets(pack_power_of_two(odd_docs, VOCABULARY), path)
    stored = spark.read.parquet(path)
    assert stored.where("length <> shiftleft(1, bucket)").count() == 0 and stored.count() > 0
