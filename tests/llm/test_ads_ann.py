import numpy as np
import pytest
from pyspark.sql import functions as F

from apportion.llm import ads_ann
from apportion.llm.ads_ann import nearest

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows, step, top=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        out[int(ids[i])] = [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:top]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def vectors(n, seed=0, width=24):
    x = np.random.default_rng(seed).normal(size=(n, width)).astype(np.float32)
    return [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]


def test_recall_on_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    expected, got = brute(rows, 100), found(nearest(table))
    hits = sum(len({j for _, j in expected[q]} & {j for _, j in got[q]}) for q in expected)
    print("recall", hits / sum(map(len, expected.values())))
    assert set(got) == set(expected) and hits >= 0.9 * sum(map(len, expected.values()))
    exact = {q: dict((j, d) for d, j in brute(rows, 100, len(rows))[q]) for q in list(expected)[:3]}
    assert all(abs(exact[q][j] - d) < 1e-12 for q in exact for d, j in got[q])


def test_all_lists_are_exact_with_ties_and_hot_vectors(spark, monkeypatch):
    monkeypatch.setattr(ads_ann, "BLOCK", 32)
    monkeypatch.setattr(ads_ann, "LIST_ROWS", 50)
    rows = vectors(300) + [(1000 + i, [1.0] * 24, 0) for i in range(200)]  # a large part of all rows is one vector
    got = found(nearest(spark.createDataFrame(rows, TABLE).repartition(4), query_step=50, probe_share=1.0))
    expected = brute(rows, 50)
    assert set(got) == set(expected)
    for q in expected:
        assert [j for _, j in got[q]] == [j for _, j in expected[q]] and np.allclose([d for d, _ in got[q]], [d for d, _ in expected[q]], atol=1e-12)


def test_rows_that_take_no_part(spark):
    good = vectors(40)
    odd = [(100, None, 0), (200, [0.0] * 24, 0), (300, [float("nan")] * 24, 0), (400, [float("inf")] + [1.0] * 23, 0), (500, [None] + [1.0] * 23, 0), (600, [1.0], 0), (None, [1.0] * 24, 0), (700, [], 0)]
    df = spark.createDataFrame([(*r, "clash") for r in good + odd], TABLE + ", list string")
    got = found(nearest(df, query_step=10, probe_share=1.0))
    expected = brute(good, 10)
    assert {q: [j for _, j in x] for q, x in got.items()} == {q: [j for _, j in x] for q, x in expected.items()}


def test_few_and_repeated_rows(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0)]
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest(spark.createDataFrame(rows, TABLE)).collect()] == [(0, 1, 1)]


@pytest.mark.parametrize("rows", [[], [(1, None, 0)]])
def test_no_rows(spark, rows):
    assert nearest(spark.createDataFrame(rows, TABLE)).collect() == []


def test_one_short_vector_does_not_set_the_width(spark):
    rows = vectors(40)
    first = spark.range(40).orderBy(F.xxhash64("id")).first().id  # the row that a sample begins with
    cut = [(i, v[:3] if i == first else v, x) for i, v, x in rows]
    got = found(nearest(spark.createDataFrame(cut, TABLE), query_step=5, probe_share=1.0))
    expected = brute([r for r in rows if r[0] != first], 5)
    assert {q: [j for _, j in x] for q, x in got.items()} == {q: [j for _, j in x] for q, x in expected.items()}
    tied = [(i, [float(i + 1)] * (2 if i < 20 else 3), 0) for i in range(40)]
    assert set(found(nearest(spark.createDataFrame(tied, TABLE), query_step=10, probe_share=1.0))) == {20, 30}


def test_blocks_come_from_the_data(spark):
    df = spark.createDataFrame(vectors(60), TABLE).selectExpr("vec_id", "cast(embedding as array<double>) v")
    dealt = [{r.vec_id: r.b for r in df.repartition(n).select("vec_id", ads_ann.block_of(F.lit(3)).alias("b")).collect()} for n in (1, 7)]
    assert dealt[0] == dealt[1] and set(dealt[0].values()) == {0, 1, 2}


def test_waves_cover_the_probed_lists_once():
    for n in (1, 2, 7, 8, 9, 40, 1875):
        assert [k for a, b in ads_ann.waves(n) for k in range(a, b)] == list(range(n))


def test_tests_abandon_components(spark):
    """The share of components that the table's queries look at, exact measures of survivors included."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    shares = {r.query_id: r.scanned_share for r in nearest(table).collect()}
    print("mean scanned share", sum(shares.values()) / len(shares))
    assert sum(shares.values()) / len(shares) < 0.85


def test_shares_of_a_random_rotation_pass_the_test():
    x = np.random.default_rng(1).normal(size=(4000, 64))
    parts = (x**2).cumsum(1) / (x**2).sum(1, keepdims=True)
    assert all((parts[:, b - 1] > ads_ann.share_below(b, 64)).mean() < 0.025 for b in (16, 32, 48))


def test_repeated_rows_are_found_as_often_as_they_occur(spark):
    rows = [(0, [1.0, 0.0], 0)] * 3 + [(1, [0.0, 1.0], 0)] * 4 + [(2, [5.0, 5.0], 0)] * 50
    got = nearest(spark.createDataFrame(rows, TABLE).repartition(3)).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 1)] * 4 + [(0, 2)] * 6
