"""Formula engine on tiny frames: binding, null and zero rules, sequencing."""

import pytest
from pyspark.sql import functions as F

from apportion.operators.formula import add_result_columns, apply_formula, changed_datasets, settle
from apportion.specs import Formula, Item, avg_of, list_of, lookup, sum_of
from apportion.functions.scalar import js_div


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])


@pytest.fixture
def frames(spark):
    target = spark.createDataFrame(
        [("k1", "A", 0.0, 0.0), ("k2", "A", 0.0, 0.0), ("k3", "B", 0.0, 0.0), (None, "A", 0.0, 0.0)],
        "k string, grp string, x double, y double")
    src = spark.createDataFrame(
        [("k1", 10.0, 4.0, "u"), ("k2", 7.0, None, "u"), ("k2", 1.0, 2.0, "v"), ("k9", 5.0, 5.0, "u"),
         (None, 100.0, 100.0, "u")],
        "k string, a double, b double, tag string")
    return {"t": target, "s": src}


def test_names_bind_in_order(frames):
    # x = a - b with a = lookup 10, b = sum 4: 6 (not 4 - 10)
    f = Formula.of("f", "t", [Item("x", "$a - $b", (
        lookup("a", "s", "a", on="k", filter={"tag": "u"}),
        sum_of("b", "s", "b", on="k", filter={"tag": "u"})))])
    out = apply_formula(frames, f)["t"]
    assert dict(rows(out, "k", "x"))["k1"] == 6.0


def test_all_items_survive_and_chain(frames):
    f = Formula.of("f", "t", [Item("x", "1"), Item("y", "x + 1", (lookup("p", "t", "x"),))])
    out = apply_formula(frames, f)["t"]
    assert {(r["x"], r["y"]) for r in out.collect()} == {(1.0, 2.0)}
    f2 = Formula.of("f", "t", [Item("x", "1"), Item("y", "$p + 1", (lookup("p", "t", "x"),))])
    assert {(r["x"], r["y"]) for r in apply_formula(frames, f2)["t"].collect()} == {(1.0, 2.0)}


def test_sum_unmatched_default_and_keep_old(frames):
    keep = Formula.of("f", "t", [Item("x", "$s", (sum_of("s", "s", "a", on="k"),))])
    zero = Formula.of("f", "t", [Item("x", "$s", (sum_of("s", "s", "a", on="k", default=0.0),))])
    t = frames["t"].withColumn("x", F.lit(9.0))
    fr = {**frames, "t": t}
    assert rows(apply_formula(fr, keep)["t"], "k", "x") == [(None, 9.0), ("k1", 10.0), ("k2", 8.0), ("k3", 9.0)]
    assert rows(apply_formula(fr, zero)["t"], "k", "x") == [(None, 0.0), ("k1", 10.0), ("k2", 8.0), ("k3", 0.0)]


def test_null_keys_never_match(frames):
    f = Formula.of("f", "t", [Item("x", "$s", (sum_of("s", "s", "a", on="k"),))])
    out = dict((r["grp"] + str(r["k"]), r["x"]) for r in apply_formula(frames, f)["t"].collect())
    assert out["ANone"] == 0.0


def test_average_counts_zero_loaded_nulls(spark):
    t = spark.createDataFrame([("a", 0.0)], "k string, x double")
    s = spark.createDataFrame([("a", 4.0), ("a", None)], "k string, v double").fillna(0.0)
    f = Formula.of("f", "t", [Item("x", "$m", (avg_of("m", "s", "v", on="k"),))])
    assert apply_formula({"t": t, "s": s}, f)["t"].first()["x"] == 2.0


def test_different_fields_same_match_not_confused(frames):
    f = Formula.of("f", "t", [
        Item("x", "$sa", (sum_of("sa", "s", "a", on="k"),)),
        Item("y", "$sb", (sum_of("sb", "s", "b", on="k"),)),
    ])
    out = apply_formula(frames, f)["t"]
    assert dict(rows(out, "k", "y"))["k2"] == 2.0 and dict(rows(out, "k", "x"))["k2"] == 8.0


def test_lookup_duplicates_raise_only_when_matched(frames):
    f = Formula.of("f", "t", [Item("x", "$a", (lookup("a", "s", "a", on="k"),))])
    with pytest.raises(Exception, match="matches 2 rows"):
        apply_formula(frames, f)["t"].collect()
    # k2 outside the formula filter: its duplicate is never evaluated
    g = Formula.of("f", "t", [Item("x", "$a", (lookup("a", "s", "a", on="k"),))], filter={"grp": "B"})
    assert rows(apply_formula(frames, g)["t"], "k", "x")[0] == (None, 0.0)


def test_formula_filter_fixed_at_start(frames):
    # the first item rewrites the filter column; the second item still uses the starting set
    t = frames["t"].withColumn("z", F.lit(1.0))
    f = Formula.of("f", "t", [Item("z", "2"), Item("x", "5")], filter={"z": 1})
    out = apply_formula({**frames, "t": t}, f)["t"]
    assert {(r["z"], r["x"]) for r in out.collect()} == {(2.0, 5.0)}


def test_numeric_filter_given_as_text(frames):
    t = frames["t"].withColumn("n", F.lit(3).cast("int"))
    f = Formula.of("f", "t", [Item("x", "7")], filter={"n": "3"})
    assert {r["x"] for r in apply_formula({**frames, "t": t}, f)["t"].collect()} == {7.0}


def test_keyless_sum_and_lookup(spark, frames):
    f = Formula.of("f", "t", [Item("x", "$s", (sum_of("s", "s", "a"),))])
    assert {r["x"] for r in apply_formula(frames, f)["t"].collect()} == {123.0}
    g = Formula.of("f", "t", [Item("x", "$a", (lookup("a", "s", "a", filter={"k": "k9"}),))])
    assert {r["x"] for r in apply_formula(frames, g)["t"].collect()} == {5.0}
    h = Formula.of("f", "t", [Item("x", "$a", (lookup("a", "s", "a"),))])
    with pytest.raises(Exception):
        apply_formula(frames, h)["t"].collect()


def test_multi_column_keys_are_typed(spark):
    t = spark.createDataFrame([("a", "bc", 0.0), ("ab", "c", 0.0)], "p string, q string, x double")
    s = spark.createDataFrame([("a", "bc", 1.0)], "p string, q string, v double")
    f = Formula.of("f", "t", [Item("x", "$v", (lookup("v", "s", "v", on=["p", "q"]),))])
    assert rows(apply_formula({"t": t, "s": s}, f)["t"], "p", "x") == [("a", 1.0), ("ab", 0.0)]


def test_list_functions(spark, frames):
    t = add_result_columns(frames["t"], {"txt": "string", "n": "bigint", "first_tag": "string"})
    f = Formula.of("f", "t", [
        Item("txt", "$l", (list_of("l", "s", "a", on="k", fn="text", order_by=["tag"]),)),
        Item("n", "$c", (list_of("c", "s", "a", on="k", fn="count"),)),
        Item("first_tag", "$f", (list_of("f", "s", "tag", on="k", fn="first", order_by=["a"]),)),
        Item("x", "$m", (list_of("m", "s", "a", on="k", fn="max"),)),
        Item("y", "$sq", (list_of("sq", "s", "a", on="k",
                                  fn=lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v * v)),)),
    ])
    out = {r["k"]: r for r in apply_formula({**frames, "t": t}, f)["t"].collect()}
    assert out["k2"]["txt"] == "7.0,1.0" and out["k2"]["n"] == 2 and out["k2"]["first_tag"] == "v"
    assert out["k2"]["x"] == 7.0 and out["k2"]["y"] == 50.0
    assert out["k3"]["txt"] is None and out["k3"]["n"] == 0


def test_objects_and_json(spark, frames):
    t = add_result_columns(frames["t"], {"js": "string"})
    f = Formula.of("f", "t", [Item("js", "$j", (list_of("j", "s", "a", on="k", fn="json", fields=["a", "tag"],
                                                      order_by=["tag"]),))])
    out = {r["k"]: r["js"] for r in apply_formula({**frames, "t": t}, f)["t"].collect()}
    assert out["k2"] == '[{"a":"7.0","tag":"u"},{"a":"1.0","tag":"v"}]'


def test_keyless_list_needs_decomposable_fn():
    with pytest.raises(ValueError):
        list_of("l", "s", "a", fn="array")


def test_column_named_value_does_not_clash(spark):
    t = spark.createDataFrame([("a", 0.0, 3.0)], "k string, x double, value double")
    s = spark.createDataFrame([("a", 4.0)], "k string, value double")
    f = Formula.of("f", "t", [Item("x", "value + $v", (sum_of("v", "s", "value", on="k"),))])
    assert apply_formula({"t": t, "s": s}, f)["t"].first()["x"] == 7.0


def test_division_rules(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (1.0, -0.0)], "a double, b double")
    got = [r[0] for r in df.select(js_div("a", "b")).collect()]
    assert got[0] == float("inf") and got[1] == float("-inf") and got[2] != got[2] and got[3] == 2.0
    assert got[4] == float("inf")
    # try_divide: null result keeps the old value
    t = spark.createDataFrame([("a", 5.0, 0.0)], "k string, x double, z double")
    f = Formula.of("f", "t", [Item("x", "try_divide(1, z)")])
    assert apply_formula({"t": t}, f)["t"].first()["x"] == 5.0


def test_settle_order_and_changed(spark, frames):
    fs = [Formula.of("a", "t", [Item("x", "1")]), Formula.of("b", "s", [Item("a", "2")]),
          Formula.of("c", "t", [Item("y", "x + 1")])]
    out = settle(frames, fs)
    assert {r["y"] for r in out["t"].collect()} == {2.0}
    assert changed_datasets(fs) == ["s", "t"]


def test_settle_checkpoint_cuts_lineage(spark, frames):
    fs = [Formula.of(f"f{i}", "t", [Item("x", "x + 1")]) for i in range(4)]
    out = settle(frames, fs, checkpoint_every=2)
    assert {r["x"] for r in out["t"].collect()} == {4.0}


def test_match_column_rewritten_rejoins(spark):
    t = spark.createDataFrame([("a", 0.0, 0.0)], "k string, x double, y double")
    s = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    t = t.withColumn("k2", F.lit("a"))
    f = Formula.of("f", "t", [
        Item("x", "$v", (lookup("v", "s", "v", on={"k2": "k"}),)),
        Item("k2", "CAST(NULL AS STRING)"),  # null result keeps 'a'
        Item("y", "$v", (lookup("v", "s", "v", on={"k2": "k"}),)),
    ])
    r = apply_formula({"t": t, "s": s}, f)["t"].first()
    assert r["x"] == 1.0 and r["y"] == 1.0


def test_later_formula_sees_changed_source(spark, frames):
    # formula 1 changes the source; formula 2 sums it: the new values count
    fs = [Formula.of("a", "s", [Item("a", "1")]),
          Formula.of("b", "t", [Item("x", "$s", (sum_of("s", "s", "a", on="k"),))])]
    out = settle(frames, fs)["t"]
    assert dict(rows(out, "k", "x"))["k2"] == 2.0


def test_formula_without_items_is_a_no_op(frames):
    out = apply_formula(frames, Formula.of("empty", "t", []))
    assert out["t"] is frames["t"]


def test_self_aggregate_uses_current_frame(spark):
    t = spark.createDataFrame([("g", 1.0, 0.0), ("g", 3.0, 0.0)], "k string, v double, s double")
    f = Formula.of("f", "t", [Item("v", "v * 10"), Item("s", "$tot", (sum_of("tot", "t", "v", on="k"),))])
    assert {r["s"] for r in apply_formula({"t": t}, f)["t"].collect()} == {40.0}


def test_registered_list_functions(spark, frames):
    from apportion.functions.lists import register_list_fn

    register_list_fn("first_minus_last", fn=lambda arr: F.element_at(arr, 1) - F.element_at(arr, -1))
    t = frames["t"]
    f = Formula.of("f", "t", [
        Item("x", "$sp", (list_of("sp", "s", "a", on="k", fn="spread"),)),            # aggregate form
        Item("y", "$fl", (list_of("fl", "s", "a", on="k", fn="first_minus_last", order_by=["tag"]),)),
    ])
    out = {r["k"]: (r["x"], r["y"]) for r in apply_formula({**frames, "t": t}, f)["t"].collect()}
    assert out["k2"] == (6.0, 6.0) and out["k1"] == (0.0, 0.0)
    plan = apply_formula({**frames, "t": t}, Formula.of("g", "t", [
        Item("x", "$sp", (list_of("sp", "s", "a", on="k", fn="spread"),))]))["t"]._jdf.queryExecution()
    assert "collect_list" not in plan.optimizedPlan().toString()


def test_different_filters_share_one_join(spark, frames):
    t = add_result_columns(frames["t"], {"txt": "string", "n": "bigint"})
    f = Formula.of("f", "t", [
        Item("x", "$su", (sum_of("su", "s", "a", on="k", filter={"tag": "u"}),)),
        Item("y", "$sv", (sum_of("sv", "s", "a", on="k", filter={"tag": "v"}),)),
        Item("txt", "$l", (list_of("l", "s", "a", on="k", fn="text", order_by=["a"]),)),   # no filter: all rows
        Item("n", "$c", (list_of("c", "s", "a", on="k", fn="count", filter={"tag": "v"}),)),
    ])
    out_df = apply_formula({**frames, "t": t}, f)["t"]
    out = {r["k"]: (r["x"], r["y"], r["txt"], r["n"]) for r in out_df.collect()}
    assert out["k1"] == (10.0, 0.0, "10.0", 0)
    assert out["k2"] == (7.0, 1.0, "1.0,7.0", 1)
    assert out["k3"] == (0.0, 0.0, None, 0)
    plan = out_df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1


def test_filtered_lookups_count_their_own_rows(spark, frames):
    # k2 has two source rows, one per tag: a lookup filtered to one tag is unique
    f = Formula.of("f", "t", [
        Item("x", "$a", (lookup("a", "s", "a", on="k", filter={"tag": "v"}),)),
        Item("y", "$b", (lookup("b", "s", "b", on="k", filter={"tag": "u"}),)),
    ])
    out = {r["k"]: (r["x"], r["y"]) for r in apply_formula(frames, f)["t"].collect()}
    assert out["k2"] == (1.0, 0.0) and out["k1"] == (0.0, 4.0)


def test_default_keeps_decimal_exact(spark):
    from decimal import Decimal

    # 19 significant digits: a double in between would lose the cents
    t = spark.createDataFrame([("a", "0"), ("z", "0")], "k string, x string").withColumn(
        "x", F.col("x").cast("decimal(24,2)"))
    s = spark.createDataFrame([("a", "12345678901234567.89")], "k string, v string").withColumn(
        "v", F.col("v").cast("decimal(20,2)"))
    f = Formula.of("f", "t", [Item("x", "$s + 0.05", (sum_of("s", "s", "v", on="k", default=0.0),))])
    out = apply_formula({"t": t, "s": s}, f)["t"]
    assert dict((r["k"], r["x"]) for r in out.collect()) == {"a": Decimal("12345678901234567.94"),
                                                             "z": Decimal("0.05")}


@pytest.mark.parametrize("seed,ns", [(1, 2000), (2, 120)])
def test_random_formulas_against_pandas(spark, seed, ns):
    """Random targets/sources with null keys, several filters on one match and a
    formula filter, against a plain pandas evaluation of the same rules."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(seed)
    nt = 300  # ns=120: many keys lack some tags, so filters sharing a join must still act alone
    keys = [f"k{i}" for i in range(60)] + [None]
    tpdf = pd.DataFrame({"id": np.arange(nt), "k": rng.choice(keys, nt), "g": rng.choice(["A", "B"], nt),
                         "x": np.zeros(nt), "y": np.zeros(nt), "z": np.zeros(nt), "t": [None] * nt})
    spdf = pd.DataFrame({"k": rng.choice(keys, ns), "tag": rng.choice(["u", "v", "w"], ns),
                         "a": rng.integers(-50, 50, ns).astype(float)})
    t = spark.createDataFrame(tpdf, "id long, k string, g string, x double, y double, z double, t string")
    s = spark.createDataFrame(spdf, "k string, tag string, a double")
    f = Formula.of("f", "t", [
        Item("x", "$su - $av", (sum_of("su", "s", "a", on="k", filter={"tag": "u"}),
                                avg_of("av", "s", "a", on="k", filter={"tag": "v"}, default=0.0))),
        Item("y", "$n + x", (list_of("n", "s", "a", on="k", fn="count", filter={"tag": "w"}),)),
        Item("z", "$mn", (lookup("mn", "s", "a", on="k", filter={"tag": "w"}, on_duplicate="any"),)),
        Item("t", "$tx", (list_of("tx", "s", "a", on="k", fn="text", filter={"tag": "u"}, order_by=["a"]),)),
    ], filter={"g": "A"})
    res = apply_formula({"t": t, "s": s}, f)["t"].collect()
    got = {r["id"]: (r["x"], r["y"], r["z"]) for r in res}
    got_t = {r["id"]: r["t"] for r in res}

    src = spdf[spdf["k"].notna()]
    su = src[src.tag == "u"].groupby("k")["a"].sum()
    av = src[src.tag == "v"].groupby("k")["a"].mean()
    cnt = src[src.tag == "w"].groupby("k").size()
    mn = src[src.tag == "w"].groupby("k")["a"].min()
    tx = src[src.tag == "u"].groupby("k")["a"].apply(lambda v: ",".join(str(float(a)) for a in sorted(v)))
    for row in tpdf.itertuples():
        x = y = z = 0.0
        want_t = tx.get(row.k) if (row.g == "A" and row.k is not None) else None
        assert got_t[row.id] == want_t, row
        if row.g == "A":
            k = row.k
            s_u = su.get(k) if k is not None else None
            a_v = av.get(k, 0.0) if k is not None else 0.0
            if s_u is not None:
                x = s_u - a_v
            n = cnt.get(k) if k is not None else None
            if n is not None:
                y = n + x
            m = mn.get(k) if k is not None else None
            if m is not None:
                z = m
        assert got[row.id] == pytest.approx((x, y, z)), row


def test_keyless_count_same_with_or_without_shared_filters(spark, frames):
    lone = Formula.of("f", "t", [Item("x", "$c", (list_of("c", "s", "a", fn="count", filter={"tag": "zz"}),))])
    shared = Formula.of("f", "t", [
        Item("x", "$c", (list_of("c", "s", "a", fn="count", filter={"tag": "zz"}),)),
        Item("y", "$s", (sum_of("s", "s", "a", filter={"tag": "u"}),)),
    ])
    a = {r["x"] for r in apply_formula(frames, lone)["t"].collect()}
    b = {r["x"] for r in apply_formula(frames, shared)["t"].collect()}
    assert a == b == {0.0}


def test_objects_default_to_all_source_columns(spark, frames):
    t = add_result_columns(frames["t"], {"js": "string"})
    f = Formula.of("f", "t", [Item("js", "$j", (list_of("j", "s", "a", on="k", fn="json", order_by=["tag"]),))])
    out = {r["k"]: r["js"] for r in apply_formula({**frames, "t": t}, f)["t"].collect()}
    assert out["k1"] == '[{"k":"k1","a":"10.0","b":"4.0","tag":"u"}]'
