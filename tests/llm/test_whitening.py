import numpy as np
import pytest

from apportion.llm import whitening
from apportion.llm.eigen_updates import Spectrum, rank_one
from apportion.llm.whitening import fit_whitening, spectrum, whitened_components

TABLE = "vec_id long, embedding array<float>, label int"


def brute(rows, components=4):
    """All results from one covariance matrix and one eigendecomposition."""
    x = {k: tuple(int(np.floor(256 * float(np.float32(c)))) for c in v) for k, (_, v) in enumerate(rows)}
    fit = np.array(sorted(set(x.values())))
    n, sums = len(fit), fit.sum(0)
    c = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    out = {}
    for k, (i, _) in enumerate(rows):
        off = [n * a - int(s) for a, s in zip(x[k], sums)]
        for e in range(min(components, fit.shape[1])):
            if values[-1 - e] > 1e-12 * values.sum():
                w = np.array(off) / n @ vectors[:, -1 - e] / np.sqrt(values[-1 - e])
                out.setdefault((i, e + 1), []).append((n, sum(o * o for o in off), w, values[-1 - e] / values.sum()))
    return out


def compare(df, rows, components=4):
    expected, got = brute(rows, components), {}
    for r in whitened_components(df, components).collect():
        got.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, r.whitened, r.explained))
        assert 0 <= r.identity_error <= 1e-9
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in expected.items()}
    for component in {k[1] for k in got}:
        keys = sorted((k for k in got if k[1] == component), key=repr)
        a = [v for k in keys for v in sorted(got[k], key=lambda v: (v[1], abs(v[2])))]
        b = [v for k in keys for v in sorted(expected[k], key=lambda v: (v[1], abs(v[2])))]
        assert [v[:2] for v in a] == [v[:2] for v in b]
        wa, wb = np.array([v[2] for v in a]), np.array([v[2] for v in b])
        sign = np.sign(wa @ wb)
        assert np.allclose(wa, sign * wb, atol=1e-9) and np.allclose([v[3] for v in a], [v[3] for v in b], rtol=1e-10)


def test_table_against_one_decomposition(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    compare(table, [(r.vec_id, r.embedding) for r in table.collect()])


def test_many_parts_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PART", 16)
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=9) * np.arange(1, 10)]) for i in range(400)]
    df = spark.createDataFrame([(*r, 0) for r in rows], TABLE).repartition(4)
    compare(df, rows)
    x = np.unique(np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(float)), axis=0)
    fit = spark.createDataFrame([([int(c) for c in r],) for r in x], "x array<int>")
    got, c = spectrum(fit, len(x), 9), x - x.mean(0)
    assert got.n == len(x) and np.allclose(got.mean, x.mean(0))
    assert np.allclose(got.vectors @ np.diag(got.values) @ got.vectors.T, c.T @ c, rtol=1e-10, atol=1e-6)


@pytest.mark.parametrize("kind", range(6))
def test_rank_one_updates_and_merges(kind):
    rng = np.random.default_rng(kind)
    for _ in range(30):
        k = int(rng.integers(1, 12))
        x = rng.integers(-3, 4, (int(rng.integers(2, 40)), k)).astype(float)
        if kind == 1:
            x[:, 0] = 0  # a direction without variance
        if kind == 2:
            x = np.repeat(x[:1], 10, 0)  # one vector
        if kind == 3:
            x = x * 10.0 ** rng.integers(-8, 8, k)
        if kind == 4:
            x = np.round(x / 3)  # equal eigenvalues
        if kind == 5:
            x = np.vstack([np.eye(k), -np.eye(k)])
        c = x - x.mean(0)
        scatter, size = c.T @ c, max((x**2).sum(), 1e-300)
        cut = len(x) // 2
        for s in (Spectrum.empty(k).with_rows(x), Spectrum.empty(k).with_rows(x[:cut]).merged(Spectrum.empty(k).with_rows(x[cut:]))):
            assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() < 1e-11 * size
            assert np.abs(s.vectors.T @ s.vectors - np.eye(k)).max() < 1e-12 and (np.diff(s.values) >= 0).all()


def test_nothing_to_add_changes_nothing():
    values, vectors = np.array([1.0, 2.0]), np.eye(2)
    assert rank_one(values, vectors, np.zeros(2), 3.0) == (values, vectors)
    assert rank_one(values, vectors, np.ones(2), 0.0) == (values, vectors)


def test_odd_rows_repeats_and_clashes(spark):
    rng = np.random.default_rng(4)
    good = [(i, [float(c) for c in rng.integers(-9, 9, 6) / 8]) for i in range(60)]
    good += [good[3]] * 30 + [(1000, good[5][1]), (None, good[7][1]), (None, [0.0] * 6)]
    bad = [(900, None), (901, [float("nan")] + [0.0] * 5), (902, [None] + [0.0] * 5), (903, [float("-inf")] + [0.0] * 5), (904, [1.0]), (905, [])]
    df = spark.createDataFrame([(*r, 0, "clash", 1) for r in good + bad], TABLE + ", whitened string, n int").repartition(3)
    compare(df, good)
    flat = [(i, [v[0], 0.0, v[0], 0.0, 1.0, 0.0]) for i, v in good]  # one direction only
    compare(spark.createDataFrame([(*r, 0) for r in flat], TABLE), flat)


def test_one_vector_and_none(spark):
    assert whitened_components(spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, TABLE)).collect() == []
    assert whitened_components(spark.createDataFrame([], TABLE)).collect() == []
    assert fit_whitening(spark.createDataFrame([(1, None, 0)], TABLE)) is None
