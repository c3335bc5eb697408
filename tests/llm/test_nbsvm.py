import zlib

import numpy as np
import xxhash

from apportion.llm.nbsvm import Features, dual_coordinate_descent, keep_good, score_quality, shape

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = score_quality(docs, labels).cache()
    assert got.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.collect())
    test = got.where("held_out").join(labels, "doc_id").collect()
    for label in (0, 1):
        own = [r for r in test if r.quality == label]
        assert np.mean([r.predicted == label for r in own]) > 0.85


def test_held_out_labels_are_not_read(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end quality", "toxic")
    score = lambda x: sorted((r.doc_id, r.score) for r in score_quality(docs, x).collect())
    assert score(labels) == score(turned)


def test_odd_rows_and_labels(spark, odd_docs, odd_texts, clashing, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (6, 1, 0), (9, 0, 0), (10, 0, None), (None, 1, 0), (8, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for docs in (odd_docs, clashing):
        got = score_quality(docs, labels).collect()
        assert len(got) == len(odd_texts) and all(0 <= r.score <= 1 for r in got)
        empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
        assert len(empty) == 1
    assert score_quality(no_docs, labels).collect() == []
    none = score_quality(odd_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert keep_good(clashing, labels).columns == clashing.columns


def test_dual_coordinate_descent_meets_the_primal():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    rows = [np.array([2 * label + (rng.random() < 0.1), 5]) for label in y]
    values = [np.array([1.0, rng.normal()]) for _ in y]
    w, b = dual_coordinate_descent(rows, values, y, epochs=200)
    sign = np.where(y > 0, 1, -1)
    share = np.array([np.mean(y == 0), np.mean(y == 1)])

    def loss(w, b):
        margin = np.array([w[r] @ v + b for r, v in zip(rows, values)])
        return 0.5 * (w @ w + b * b) + (np.maximum(0, 1 - sign * margin) / (2 * share[y])).sum()

    best = loss(w, b)
    assert all(best <= loss(w + (np.arange(len(w)) < 8) * rng.normal(0, 0.05, len(w)), b + rng.normal(0, 0.05)) + 1e-6 for _ in range(50))


def test_shape_is_of_the_whole_word():
    words = ["漢字" * 40 + end for end in ("A1", "b!", "")]
    features = Features()
    features.of([w.encode() for w in words])
    for w in words:
        assert features.hashes[features.index[w.encode()], 1] == xxhash.xxh64_intdigest(shape(w).encode(), 1)
    assert len(set(features.hashes[:, 1].tolist())) == 3
