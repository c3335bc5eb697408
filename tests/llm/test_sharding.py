import zlib
from collections import Counter, defaultdict

from apportion.llm import sharding
from apportion.llm.common import shared_folder
from apportion.llm.sharding import SlotMap, even_map, grow, rebalance, shard_by_slots


def check(rows, texts, n_shards):
    assert Counter((r.doc_id, r.text_crc32, r["size"]) for r in rows) == Counter((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in texts)
    places = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n_shards and r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in places.values())


def test_odd_rows(odd_docs, odd_texts, clashing):
    check(shard_by_slots(odd_docs, 4, 64).collect(), odd_texts, 4)
    check(shard_by_slots(clashing, 4, 64).collect(), odd_texts, 4)


def test_no_rows(no_docs):
    assert shard_by_slots(no_docs, 4, 64).collect() == []


def test_bytes_near_equal(spark):
    docs = spark.range(20000).selectExpr("id as doc_id", "repeat('x', cast(50 + pmod(hash(id), 900) as int)) as text")
    total = Counter()
    for r in shard_by_slots(docs, 40).collect():
        total[r.shard] += r["size"]
    assert max(total.values()) - min(total.values()) < 0.01 * max(total.values())


def test_repeated_rows_keep_the_law(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 64)
    same = spark.range(8000).selectExpr("cast(null as long) doc_id", "repeat('y', 500) text")
    others = spark.range(12000).selectExpr("id as doc_id", "repeat('x', cast(50 + pmod(hash(id), 900) as int)) as text")
    rows = shard_by_slots(same.union(others).repartition(5), 40).collect()
    check(rows, [(None, "y" * 500)] * 8000 + [(r.doc_id, r.text) for r in others.collect()], 40)
    total = Counter()
    for r in rows:
        total[r.shard] += r["size"]
    assert len(total) == 40 and max(total.values()) - min(total.values()) < 0.01 * max(total.values())
    assert len({r.virtual_slot for r in rows if r.doc_id is None}) > 3000


def test_maps_are_versions(spark):
    sizes = {s: 100 + 7 * (s % 13) for s in range(512)}
    first = even_map(512, 8)
    second = rebalance(first, sizes)
    assert (first.version, second.version) == (0, 1)
    path = shared_folder(spark, "maps")
    first.save(spark, path)
    second.save(spark, path)
    assert SlotMap.load(spark, path, 8, 0) == first and SlotMap.load(spark, path, 8, 1) == second
    moved = sum(a != b for a, b in zip(first.owner, second.owner))
    assert moved < 64

    third = grow(second, sizes)
    assert third.n_shards == 9 and all(b in (a, 8) for a, b in zip(second.owner, third.owner))
    load = Counter()
    for s, shard in enumerate(third.owner):
        load[shard] += sizes[s]
    assert abs(load[8] - sum(sizes.values()) / 9) < 300
