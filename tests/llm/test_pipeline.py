import hashlib
from collections import Counter

import corpus_pipeline
from test_lpf_dedup import given
from test_minmax_dedup import brute as components_of
from test_packing import expected, rebuilt

from apportion.llm.common import table, written
from apportion.llm.line_quality import LineRules, judge
from apportion.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "minhash_near_dedup", "suffix_array_dedup", "packing"]
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)


def test_each_stage_on_its_own_input(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)

    good = written(stages["quality_classifier"](spark, docs, SF), "t")
    assert good.schema == docs.schema
    ids = {r.doc_id for r in good.collect()}
    right = [(i in ids) == (q == 1) for i, q in labels.items()]
    assert sum(right) > 0.97 * len(right)

    clean = written(stages["quality_rules"](spark, good, SF), "t")
    expected = {r.doc_id: judge(r.text, LineRules()) for r in good.collect()}
    assert {r.doc_id: r.text for r in clean.collect()} == {i: text for i, (digest, text) in expected.items() if digest[6]}

    single = written(stages["minhash_near_dedup"](spark, clean, SF), "t")
    kept = {i for i, _, _, k in components_of([(r.doc_id, r.text) for r in clean.collect()], 5) if k}
    assert sorted(r.doc_id for r in single.collect()) == sorted(kept) and single.schema == docs.schema

    cut = written(stages["suffix_array_dedup"](spark, single, SF), "t")
    seen: set[bytes] = set()
    before = {r.doc_id: r.text for r in single.collect()}
    for r in cut.orderBy("doc_id").collect():
        data = r.text.encode()
        assert r.text == before[r.doc_id] or len(r.text) < len(before[r.doc_id])
        windows = {hashlib.md5(data[a : a + 210]).digest() for a in range(len(data) - 209)}
        joined = r.text != before[r.doc_id]
        assert joined or not windows & seen  # what is left unchanged repeats nothing earlier
        seen |= windows
    assert cut.schema == docs.schema and len(given(cut)) == cut.count()


def test_run_is_the_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "t")
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).select(*columns).collect())) == Counter(map(tuple, docs.select(*columns).collect()))


def test_stages_on_odd_rows(spark, clashing, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (clashing, no_docs):
            out = written(stage(spark, docs, SF), "t")
            assert name == "packing" or out.columns == docs.columns
            assert docs is clashing or out.count() == 0


def test_packing_keeps_the_ids(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF).collect()
    assert rebuilt(rows) == expected([(r.doc_id, r.text) for r in docs.collect()])
