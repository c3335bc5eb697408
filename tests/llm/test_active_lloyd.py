import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportion.llm.active_lloyd import active_entries, code_digests, encode_vectors, nearest_entries

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain Lloyd rounds that compare every part with every entry."""
    kept = [(i, np.floor(256 * np.array(v, np.float64)).astype(int), lab) for i, v, lab in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    x = np.array([r[1] for r in kept]).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        code = d.argmin(2)
        if k < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    own = x[code[:, p] == e, p]
                    if len(own):
                        books[p, e] = np.floor(own.sum(0) / len(own)).astype(int)
    errors = d.min(2).sum(1)
    by_label = {}
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + int(e)
    sha = hashlib.sha256(",".join(map(str, books.reshape(-1))).encode()).hexdigest()
    return sorted(((i, "".join(f"{c:02x}" for c in code[n]), int(errors[n]), by_label[lab], sha) for n, (i, _, lab) in enumerate(kept)), key=repr)


def got(df, **kw):
    return sorted(map(tuple, code_digests(encode_vectors(df, **kw)).collect()), key=repr)


def test_table_against_plain_rounds(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert got(table) == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])


def test_moved_entries_give_what_a_full_search_gives():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x, before = rng.integers(-3, 4, (80, 2)), rng.integers(-3, 4, (9, 2))
        after = before.copy()
        changed = rng.random(9) < 0.3
        after[changed] += rng.integers(-2, 3, (int(changed.sum()), 2))
        moved = (after != before).any(1)
        code, error, looked = active_entries(x, after, moved, *nearest_entries(x, before))
        full = nearest_entries(x, after)
        assert (code == full[0]).all() and (error == full[1]).all()
        assert ((looked == 9) | (looked == moved.sum())).all()


def test_odd_rows_ties_repeats_and_clashes(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in rng.integers(-2, 3, 32) / 16], i % 3 if i % 5 else None) for i in range(150)]
    good += [(7, good[7][1], 1)] * 40 + [(None, good[3][1], 2), (None, [0.0] * 32, None)]
    bad = [(900, None, 1), (901, [float("nan")] + [0.0] * 31, 1), (902, [None] + [0.0] * 31, 1), (903, [float("inf")] + [0.0] * 31, 1), (904, [1.0], 1), (905, [], 1)]
    rows = [(*r, "clash", 0) for r in good + bad]
    df = spark.createDataFrame(rows, TABLE + ", code string, x int").repartition(5)
    assert got(df, rounds=3) == brute(good, rounds=3)


def test_few_rows_and_none(spark):
    few = [(i, [i / 256] * 16, None) for i in range(5)]
    assert got(spark.createDataFrame(few, TABLE)) == brute(few)
    assert got(spark.createDataFrame([], TABLE)) == []
    assert got(spark.createDataFrame([(1, None, 1)], TABLE)) == []


def test_codes_stand_for_vectors_and_few_entries_are_compared(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = encode_vectors(table, rounds=8)
    x = table.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * 256)).alias("own"))
    off = F.aggregate(F.zip_with("own", "x", lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"), lambda a, b: a + b)
    assert found.decoded().join(x, "vec_id").join(found.codes, "vec_id").where(off != F.col("error")).count() == 0
    # later rounds move few entries: far below nine full searches
    assert found.codes.agg(F.max("compared")).first()[0] < 9 * 16 * 64


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e9] * 16, 0)], TABLE)
    with pytest.raises(Exception, match="too large"):
        encode_vectors(df)
    with pytest.raises(ValueError):
        encode_vectors(spark.createDataFrame([(1, [1.0] * 5, 0)], TABLE))
