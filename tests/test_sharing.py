"""Joins shared across the formulas of a chain, and kept frames released after their last reader."""

import random

import pytest

from apportion import Formula, Item, lookup, settle, sum_of
from apportion.operators.formula import add_result_columns, data_set_reads
from apportion.plans.job_queries import shared_chain
from apportion.sinks.writers import save_changed
from apportion.specs import list_of

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def joins(df) -> int:
    return plan(df).count("Join ")


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


LESS = {"orders": 1, "customer": 2}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_chain_has_fewer_exchanges_and_the_same_rows(spark):
    frames, formulas = shared_chain(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for chain, target in ((formulas[:4], "orders"), (formulas, "customer")):
            shared, alone = settle(frames, chain)[target], settle(frames, chain, share=False)[target]
            assert exchanges(shared) <= exchanges(alone) - LESS[target]
            assert rows(shared) == rows(alone)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def frames(spark):
    t = spark.createDataFrame([(1, 10, 1.0), (2, 20, 2.0), (3, None, 3.0)], "k int, g int, own double")
    s = spark.createDataFrame([(1, 5.0, "a"), (1, 6.0, "b"), (2, 7.0, "a"), (None, 8.0, "a")], "k int, v double, kind string")
    return {"t": add_result_columns(t, {"r": "double", "q": "double"}), "s": add_result_columns(s, {"w": "double"})}


def total(field, dataset="s", on="k", **kw):
    return sum_of("x", dataset, field, on=on, **kw)


def test_a_write_of_the_read_column_ends_the_sharing(frames):
    fs = [
        Formula.of("a", "t", [Item("r", "$x", (total("v"),))]),
        Formula.of("b", "s", [Item("v", "v * 10")]),
        Formula.of("c", "t", [Item("q", "$x", (total("v"),))]),
    ]
    out = settle(frames, fs)["t"]
    assert joins(out) == 2 and out.columns == ["k", "g", "own", "r", "q"]
    assert rows(out) == [(1, 10, 1.0, 11.0, 110.0), (2, 20, 2.0, 7.0, 70.0), (3, None, 3.0, 0.0, 0.0)]


def test_a_write_of_another_column_does_not(frames):
    fs = [
        Formula.of("a", "t", [Item("r", "$x", (total("v"),))]),
        Formula.of("b", "s", [Item("w", "v * 10")]),
        Formula.of("c", "t", [Item("q", "$x", (total("v", filter={"kind": "a"}),))], filter={"k": 1}),
    ]
    out = settle(frames, fs)["t"]
    assert joins(out) == 1
    assert rows(out) == [(1, 10, 1.0, 11.0, 5.0), (2, 20, 2.0, 7.0, 0.0), (3, None, 3.0, 0.0, 0.0)]


def test_written_filter_and_match_columns_end_it(frames):
    kinds = [
        Formula.of("a", "t", [Item("r", "$x", (total("v", filter={"kind": "a"}),))]),
        Formula.of("b", "s", [Item("kind", "'a'")]),
        Formula.of("c", "t", [Item("q", "$x", (total("v", filter={"kind": "a"}),))]),
    ]
    assert rows(settle(frames, kinds)["t"]) == [(1, 10, 1.0, 5.0, 11.0), (2, 20, 2.0, 7.0, 7.0), (3, None, 3.0, 0.0, 0.0)]
    keys = [
        Formula.of("a", "t", [Item("r", "$x", (total("v"),))]),
        Formula.of("b", "t", [Item("k", "3 - k")], filter={"r": 7}),
        Formula.of("c", "t", [Item("q", "$x", (total("v"),))]),
    ]
    assert rows(settle(frames, keys)["t"]) == [(1, 10, 1.0, 11.0, 11.0), (1, 20, 2.0, 7.0, 11.0), (3, None, 3.0, 0.0, 0.0)]


def test_carried_columns_are_seen_by_no_other_formula(frames):
    fs = [
        Formula.of("a", "t", [Item("r", "$x", (total("v"),))]),
        Formula.of("b", "s", [Item("kind", "$x", (list_of("x", "t", "own", on="k", fn="json"),))]),
        Formula.of("c", "t", [Item("q", "$x", (total("v"),))]),
    ]
    out = settle(frames, fs)
    assert "__" not in "".join(r.kind for r in out["s"].collect())
    assert out["t"].columns == frames["t"].columns and joins(out["t"]) == 1


def test_a_shared_lookup_raises_only_for_the_rows_of_its_formula(frames):
    fs = [
        Formula.of("a", "t", [Item("r", "$x", (total("v"),))]),
        Formula.of("b", "t", [Item("q", "$x", (lookup("x", "s", "v", on="k"),))], filter={"k": 2}),
    ]
    assert rows(settle(frames, fs)["t"])[1] == (2, 20, 2.0, 7.0, 7.0)
    with pytest.raises(Exception, match="key matches 2 rows"):
        settle(frames, [fs[0], Formula.of("b", "t", fs[1].items)])["t"].collect()


@pytest.mark.parametrize("seed", range(3))
def test_random_chains_equal_unshared_ones(frames, seed):
    rng = random.Random(seed)
    fields = {"t": ["own", "r", "q", "k"], "s": ["v", "w", "k"]}
    fs = []
    for n in range(5):
        target = rng.choice("ts")
        other = "s" if target == "t" else "t"
        items = []
        for _ in range(rng.randint(1, 2)):
            flt = {"k": rng.choice([1, 2])} if rng.random() < 0.3 else None
            source = rng.choice([other, other, other, target])
            read = rng.choice(fields[source][:-1])
            inp = total(read, source, filter=flt) if rng.random() < 0.5 else list_of("x", source, read, on="k", fn=rng.choice(["count", "max"]))
            field = rng.choice(fields[target])
            items.append(Item(field, "least($x, 2)" if field == "k" else "$x + 1", (inp,)))
        fs.append(Formula.of(f"f{n}", target, items, filter={"k": 1} if rng.random() < 0.3 else None))
    for every in (None, 2):
        shared, alone = settle(frames, fs, every), settle(frames, fs, share=False)
        for name in frames:
            assert rows(shared[name]) == rows(alone[name])


def test_kept_frames_are_released_after_their_last_reader(spark):
    frames = {n: spark.range(5).selectExpr("id", f"'{n}' as name") for n in "abc"}
    fs = [Formula.of("f", "a", []), Formula.of("g", "b", [Item("name", "$x", (lookup("x", "a", "name", on="id"),))]), Formula.of("h", "c", [])]
    reads = data_set_reads(fs)
    assert reads == {"a": set(), "b": {"a"}, "c": set()}
    frames = settle(frames, fs)
    held = {}

    def write(name, df):
        df.count()
        held[name] = {n for n in frames if frames[n].storageLevel.useMemory}

    assert save_changed(frames, ["a", "b", "c"], write, reads=reads) == ["a", "b", "c"]
    assert held == {"a": {"a", "b", "c"}, "b": {"a", "b", "c"}, "c": {"c"}}
    assert not any(f.storageLevel.useMemory for f in frames.values())


def test_reads_go_through_other_data_sets():
    fs = [Formula.of("f", "b", [Item("v", "$x", (total("v", "a"),))]), Formula.of("g", "c", [Item("v", "$x", (total("v", "b"),))])]
    assert data_set_reads(fs) == {"b": {"a"}, "c": {"a", "b"}}
