import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import prose

from apportion.llm import improbable_digest as op
from apportion.llm.improbable_digest import Digest, digests, edited_digests, fingerprint_documents, level_counts, levels, ranks, with_likeness

COLUMNS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


def plain_level(window: bytes) -> int:
    weight = lambda n: round(n * math.log2(n) * 2**20)
    return 1000 * (weight(op.WINDOW) - sum(map(weight, Counter(window).values()))) // weight(op.WINDOW)


def plain_counts(parts):
    return Counter(plain_level(p[i : i + op.WINDOW]) for p in parts for i in range(len(p) - op.WINDOW + 1))


def plain_mix(x):
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = ((x ^ (x >> shift)) * factor) % 2**64
    return x ^ (x >> 31)


FACTORS = [plain_mix((k * 0x9E3779B97F4A7C15) % 2**64) | 1 for k in range(1, op.WINDOW + 1)]


def plain_filters(text: bytes, order: dict) -> tuple[int, list[set]]:
    """Features of a text, chosen and hashed with plain loops."""
    windows = [text[i : i + op.WINDOW] for i in range(len(text) - op.WINDOW + 1)] or ([text] if text else [])
    points = Counter()
    if len(windows) > 1 or len(text) == op.WINDOW:
        rank = [order[plain_level(w)] for w in windows]
        for i in range(max(1, len(windows) - op.RUN + 1)):
            points[min(range(i, min(i + op.RUN, len(windows))), key=lambda k: (rank[k], k))] += 1
    needed = min(op.POINTS, max(points.values(), default=0))
    small = len(text) < op.CAPACITY + op.WINDOW
    seen = {}
    for i, w in enumerate(windows):
        if small or points[i] >= needed:
            seen.setdefault(plain_mix(sum((b + 1) * f for b, f in zip(w, FACTORS)) % 2**64), None)
    hashes = list(seen)
    return len(hashes), [{h >> 11 * k & 2047 for h in hashes[a : a + 160] for k in range(5)} for a in range(0, len(hashes), 160)]


def plain_text(n, filters):
    raw = b"".join(sum(1 << b for b in f).to_bytes(256, "little") for f in filters)
    return f"{n}:{base64.b64encode(raw).decode()}"


def plain_likeness(a, b):
    if not a[0] or not b[0]:
        return float(a[0] == b[0])

    def best(x, y):
        total = 0
        for k, own in enumerate(x[1]):
            scores = [0.0]
            for other in y[1]:
                most, dense = min(len(own), len(other)), max(len(own), len(other)) / 2048
                chance, shared = most * dense, len(own & other)
                if shared > chance + 3 * math.sqrt(chance * (1 - dense)):
                    scores.append(min(1.0, (shared - chance) / (most - chance)))
            total += max(scores) * min(160, x[0] - 160 * k)
        return total / x[0]

    if len(a[1]) == len(b[1]):
        return (best(a, b) + best(b, a)) / 2
    return best(a, b) if len(a[1]) < len(b[1]) else best(b, a)


def brute(rows):
    """All result rows; equal rows are next to each other, in the order of the operator's keys."""
    parts = [(i, t or "") for i, t, _, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[3]))]
    counts = plain_counts([t.encode() for _, t in parts])
    order = {lv: k for k, lv in enumerate(sorted(range(1001), key=lambda lv: (lv < op.LEAST_LEVEL, counts[lv], lv)))}
    found, out = {}, []
    of = lambda t: found.setdefault(t, plain_filters(t.encode(), order))
    for k, (i, t) in enumerate(parts):
        after = parts[(k + 1) % len(parts)][1]
        half = len(t) // 2
        e = t[: len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), plain_text(*of(t)), plain_text(*of(e)), round(plain_likeness(of(t), of(e)), 9), round(plain_likeness(of(t), of(after)), 9)))
    return sorted(out, key=repr)


def keyed(docs):
    t = F.coalesce("text", F.lit(""))
    return [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(t), F.xxhash64(t, F.lit(1))).collect()]


def got(docs):
    df = edited_digests(docs)
    assert df.columns == COLUMNS
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=repr)


def test_levels_are_those_of_each_window(monkeypatch):
    rng = np.random.default_rng(0)
    data = np.concatenate([rng.integers(0, 256, 300), np.full(100, 7), rng.integers(97, 103, 400)]).astype(np.uint8)
    expected = [plain_level(data[i : i + op.WINDOW].tobytes()) for i in range(len(data) - op.WINDOW + 1)]
    assert levels(data).tolist() == expected
    monkeypatch.setattr(op, "BLOCK", 37)
    assert levels(data).tolist() == expected
    assert not len(levels(data[:5]))


def test_odd_documents_against_plain_loops(spark, odd_docs, clashing, monkeypatch):
    expected = brute(keyed(odd_docs))
    assert got(odd_docs) == expected
    monkeypatch.setattr(op, "BLOCK", 64)  # runs of neighbours across blocks
    monkeypatch.setattr(op, "SLICE_ROWS", 2)  # pairs across slices
    assert got(clashing) == expected


def test_repeated_rows_beyond_an_even_share(spark, monkeypatch):
    monkeypatch.setattr(op, "COPIES", 5)
    monkeypatch.setattr(op, "SPREAD", 1)
    rows = [(k, prose(k, 60)) for k in range(30)] + [(None, prose(99, 50))] * 60 + [(7, prose(98, 40))] * 23 + [(7, prose(97, 40)), (8, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(docs) == brute(keyed(docs))


@pytest.mark.parametrize("rows", [[(5, prose(1, 80))], [(5, "short")], [(None, None)], [(1, "é" * 40), (2, "é" * 40)]])
def test_few_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(docs) == brute(keyed(docs))


def test_no_documents(spark, no_docs):
    assert got(no_docs) == []


def test_table(spark):
    """Equal texts have equal fingerprints, edited texts stay near, others do not; some rows against plain loops."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in edited_digests(docs).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(text)
    assert sorted(rows) == ids
    by_text = {}
    for i in ids:
        by_text.setdefault(text[i], set()).add(rows[i].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    counts = plain_counts([t.encode() for t in text.values()])
    assert dict(enumerate(level_counts(docs).tolist())) == {lv: counts[lv] for lv in range(1001)}
    order = {lv: k for k, lv in enumerate(sorted(range(1001), key=lambda lv: (lv < op.LEAST_LEVEL, counts[lv], lv)))}
    assert order == dict(enumerate(ranks(level_counts(docs)).tolist()))
    for k in range(0, len(ids), 19):
        i, after = ids[k], ids[(k + 1) % len(ids)]
        half = len(text[i]) // 2
        e = text[i][: len(text[i]) - half] + text[after][:half]
        own, new, other = (plain_filters(t.encode(), order) for t in (text[i], e, text[after]))
        r = rows[i]
        assert (r.fingerprint, r.edited_fingerprint, r.edited_sha256) == (plain_text(*own), plain_text(*new), hashlib.sha256(e.encode()).hexdigest())
        assert abs(r.near_edited - plain_likeness(own, new)) < 1e-9 and abs(r.near_next - plain_likeness(own, other)) < 1e-9
    long = [i for i in ids if len(text[i]) > 300]
    assert np.mean([rows[i].near_edited > 0.3 for i in long]) > 0.95
    assert np.mean([rows[i].near_next for i in ids]) < 0.05


def test_general_interface(spark, clashing):
    marked = fingerprint_documents(clashing, out="score")
    assert set(marked.columns) == set(clashing.columns) and marked.count() == clashing.count()
    by_text = {}
    for r in marked.collect():
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(f) == 1 for f in by_text.values())
    pairs = marked.select(F.col("score").alias("a"), F.col("score").alias("b")).union(spark.createDataFrame([(None, "0:"), ("0:", "1:" + base64.b64encode(bytes(256)).decode())], "a string, b string"))
    assert sorted(map(str, (r.likeness for r in with_likeness(pairs, "a", "b").collect()))) == sorted(["1.0"] * clashing.count() + ["None", "0.0"])


def test_long_text_is_a_chain():
    text = prose(3, 9000).encode()
    rank = ranks(np.bincount(levels(np.frombuffer(text, np.uint8)), minlength=op.LEVELS))
    whole, cut = digests([text, text[:9000] + text[9100:]], rank)
    assert len(whole.filters) > 5 and whole.likeness(whole) == 1
    assert 0.5 < whole.likeness(cut) < 1 and Digest.parse(whole.text()).likeness(whole) == 1
