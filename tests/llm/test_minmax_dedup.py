import random
from collections import Counter

import numpy as np
import pytest
from samples import prose

from apportion.llm import minmax_dedup
from apportion.llm.components import components
from apportion.llm.minmax_dedup import MinMaxRules, Shingles, band_keys, keep_one, near_duplicates


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(rows, k):
    """(doc_id, n_shingles, component, kept) by comparing all pairs; rows of one id are one document."""
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if None not in (i, j) and s and t and 100 * len(s & t) >= 80 * len(s | t):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return Counter((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets)


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


@pytest.mark.parametrize("k", [2, 5])
def test_odd_rows(odd_docs, odd_texts, clashing, k):
    expected = brute(odd_texts, k)
    assert got(near_duplicates(odd_docs, MinMaxRules(words=k))) == expected
    assert got(near_duplicates(clashing, MinMaxRules(words=k))) == expected


def test_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(near_duplicates(docs, MinMaxRules(words=2))) == brute([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_near_copies_around_the_limit(spark, monkeypatch):
    """A group whose members are mostly just below the limit: bands with many components, compared in several blocks."""
    monkeypatch.setattr(minmax_dedup, "BLOCK", 16)
    rng, base, rows = random.Random(1), prose(5, 150).split(), []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([2, 6, 9, 12])):
            words[rng.randrange(len(words))] = f"edit{rng.random()}"
        rows.append((i * 3 + 1, " ".join(words)))
    rng.shuffle(rows)
    expected = brute(rows, 2)
    assert 1 < len({c for _, _, c, _ in expected}) < 119
    assert got(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), MinMaxRules(words=2))) == expected


def test_pipeline_form_keeps_one(spark, odd_docs, clashing, no_docs):
    kept = keep_one(clashing).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({i for i, _, c, k in got(near_duplicates(odd_docs)) if k and i is not None})
    assert sum(r.doc_id is None for r in kept) == 2
    assert keep_one(clashing).columns == clashing.columns and keep_one(no_docs).collect() == []
    assert near_duplicates(no_docs).collect() == []


def test_signature_is_unbiased():
    rules = MinMaxRules(words=1, bands=200, rows=1)
    shared, a, b = prose(1, 400), prose(2, 100), prose(3, 100)
    sets = Shingles(1).sets([f"{shared} {a}".encode(), f"{shared} {b}".encode()])
    common = len(np.intersect1d(*sets))
    keys = band_keys(sets, rules)
    assert abs((keys[0] == keys[1]).mean() - common / (len(sets[0]) + len(sets[1]) - common)) < 0.1


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(30)] + [(500, x) for x in range(501, 560)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    joined = {x for e in edges if e[0] != e[1] for x in e}
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted((r.node, r.component) for r in found) == sorted((x, root(x)) for x in joined)
