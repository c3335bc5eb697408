import math
import zlib
from collections import Counter

import numpy as np
import pytest

from apportion.llm import lbl
from apportion.llm.lbl import score_documents


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def brute(rows):
    train = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    return Counter((i, len(w := tokens(t)), sum(train[x] > 0 for x in w), n, round(sum(math.log10((train[x] + 1) / (n + 1 * (v + 1))) for x in w), 6)) for i, t in rows)


def got(df):
    rows = df.collect()
    assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)
    return Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


@pytest.mark.parametrize("top", [lbl.TOP_WORDS, 500])
def test_counts_and_base_against_brute_force(spark, monkeypatch, top):
    monkeypatch.setattr(lbl, "TOP_WORDS", top)  # with few frequent words, most counts come from the join
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    scored = score_documents(docs).cache()
    assert got(scored) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in scored.collect())


def test_model_beats_base_on_held_out(spark):
    sums = score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert sums[0] > sums[1]


def test_odd_rows(odd_docs, odd_texts, clashing, no_docs):
    assert got(score_documents(odd_docs)) == brute(odd_texts)
    assert got(score_documents(clashing)) == brute(odd_texts)
    assert score_documents(no_docs).collect() == []


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    params = lbl.Params(*(rng.normal(size=x.shape).astype(np.float32) for x in lbl.Params.start(np.full(lbl.CLASSES, 1 / lbl.CLASSES)).__dict__.values()))
    ctx = np.repeat(rng.integers(0, lbl.CLASSES, (lbl.CONTEXT, 1)), lbl.CLASSES, axis=1)
    assert abs((10 ** lbl.log10_classes(params, ctx, np.arange(lbl.CLASSES))).sum() - 1) < 1e-5


def test_words_of_a_rest_class_share_its_probability():
    words = [lbl.END, *(b"w%d" % i for i in range(2000))]
    counts = np.arange(2001, 0, -1.0)
    import pyarrow as pa

    rest_tokens, rest_words = np.zeros(lbl.REST), np.zeros(lbl.REST)
    own = lbl.CLASSES - lbl.REST
    for w, c in list(zip(words, counts))[own:]:
        rest_tokens[lbl.rest_class(w) - own] += c
        rest_words[lbl.rest_class(w) - own] += 1
    vocabulary = lbl.Vocabulary(pa.array(words, pa.binary()), counts, int(counts.sum()), len(words), np.full(lbl.CLASSES, 1 / lbl.CLASSES), rest_tokens, rest_words)
    _, of_class, _, inside = vocabulary.table()
    for k in set(of_class[own:].tolist()):
        unseen = 10 ** -vocabulary.log_rest()[k]
        assert abs((10 ** inside[of_class == k]).sum() + unseen - 1) < 1e-9


def test_training_lowers_the_loss():
    rng = np.random.default_rng(1)
    target = np.tile(np.arange(8), 2000)
    share = np.full(lbl.CLASSES, 1 / lbl.CLASSES)
    ctx = lbl.contexts(target, np.zeros(len(target), np.int64))
    start = lbl.Params.start(share)
    trainer = lbl.Trainer(start, share)
    for a in range(0, len(target), lbl.BATCH):
        trainer.learn(ctx[:, a : a + lbl.BATCH], target[a : a + lbl.BATCH])
    pick = rng.integers(100, len(target), 500)
    assert lbl.log10_classes(trainer.p, ctx[:, pick], target[pick]).mean() > lbl.log10_classes(start, ctx[:, pick], target[pick]).mean() + 0.3


@pytest.mark.parametrize("n_words", [1000, 5000])
def test_classes_grow_with_the_counted_words(spark, n_words):
    often = [(b"w%d" % i, lbl.LEAST + i % 3) for i in range(n_words)]
    rare = [(b"r%04dish" % i, 1 + i % 5) for i in range(9000)]  # of a hundred endings
    counts = spark.createDataFrame([(lbl.END, 7), *often, *rare], "word binary, n long")
    vocabulary = lbl.vocabulary(counts)
    index, of_class, _, _ = vocabulary.table()
    assert len({int(of_class[index[w]]) for w, _ in often}) == n_words == vocabulary.own - 1
    assert (vocabulary.n, vocabulary.v) == (7 + sum(n for _, n in often + rare), 1 + n_words + 9000)
    sizes = np.bincount(of_class[[index[w] for w, _ in rare]], minlength=len(vocabulary.share))[vocabulary.own :]
    assert len(sizes) > lbl.REST and sizes.max() <= 3 * 9000 / len(sizes) and vocabulary.rest_words.tolist() == sizes.tolist()


def test_grown_class_probabilities_sum_to_one_and_learn():
    classes = 3001  # the last group is short
    share = np.full(classes, 1 / classes)
    target = np.tile(np.arange(1000, 3000, 10), 400)
    ctx = lbl.contexts(target, np.zeros(len(target), np.int64))
    start = lbl.Params.start(share)
    trainer = lbl.Trainer(start, share, (0, 1))
    for a in range(0, len(target), lbl.BATCH):
        trainer.learn(ctx[:, a : a + lbl.BATCH], target[a : a + lbl.BATCH])
    every = lbl.log10_classes(trainer.p, np.repeat(ctx[:, 500:501], classes, axis=1), np.arange(classes))
    assert abs((10**every).sum() - 1) < 1e-5
    assert lbl.log10_classes(trainer.p, ctx[:, :600], target[:600]).mean() > lbl.log10_classes(start, ctx[:, :600], target[:600]).mean() + 0.3
