"""Plan properties that matter at scale, read from the physical plans."""

import re

import pytest

from apportion.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_input_filter_and_columns_reach_the_scan(spark):
    plan = initial_plan(QUERIES["sum_of_filtered"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_returnflag:string>" in plan


def test_inputs_sharing_a_match_use_one_aggregate_and_one_join(spark):
    # list_fn binds four inputs on (lineitem, l_orderkey): one join, no Python
    plan = initial_plan(QUERIES["list_fn"](spark, SF))
    assert len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan)) == 1
    assert "Python" not in plan and "ArrowEval" not in plan
    plan = initial_plan(QUERIES["multi_input"](spark, SF))
    # lookup on customer + sum and average on lineitem: two joins, not three
    assert len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan)) == 2


def test_formula_chain_is_one_plan_without_cross_products(spark):
    plan = initial_plan(QUERIES["formula_chain"](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
    # the unused gross column of lineitem is pruned away: tax is never read
    assert "l_tax" not in plan


def test_keyless_input_is_a_scalar_subquery(spark):
    plan = initial_plan(QUERIES["sum_global"](spark, SF))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_broadcasts_follow_the_byte_threshold(spark):
    """A side beyond Spark's own threshold is shuffled; no hint overrides it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1KB")
    try:
        for name in ("sum_of", "lookup_one", "three_way_join", "formula_chain"):
            assert "BroadcastHashJoin" not in initial_plan(QUERIES[name](spark, SF)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def exchanges(spark, name: str) -> int:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return initial_plan(QUERIES[name](spark, SF)).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["sum_of", "lookup_multi_key"])
def test_formula_join_reuses_the_aggregates_partitioning(spark, name):
    assert exchanges(spark, name) == 2


def test_waterfall_windows_hold_one_range_of_a_key(spark):
    plan = initial_plan(QUERIES["waterfall"](spark, SF))
    assert "windowspecdefinition(__range" in plan and "Python" not in plan
    assert plan.count("Exchange SinglePartition") == 0


@pytest.mark.parametrize("name", ["first_per_key", "dup_keys", "udaf_group"])
def test_per_key_work_is_partially_aggregated(spark, name):
    plan = initial_plan(QUERIES[name](spark, SF))
    assert "partial_" in plan or "MapInPandas" in plan  # the pandas pass reduces each batch


def test_or_of_input_filters_reaches_the_scan(spark):
    from apportion.operators.formula import add_result_columns, settle
    from apportion.sources.readers import read_table
    from apportion.specs import Formula, Item, sum_of

    orders = add_result_columns(read_table(spark, SF, "orders", ["o_orderkey"]), {"r": "double", "a": "double"})
    li = read_table(spark, SF, "lineitem", ["l_orderkey", "l_extendedprice", "l_returnflag"])
    on = {"o_orderkey": "l_orderkey"}
    f = Formula.of("f", "orders", [
        Item("r", "$r", (sum_of("r", "lineitem", "l_extendedprice", on=on, filter={"l_returnflag": "R"}),)),
        Item("a", "$a", (sum_of("a", "lineitem", "l_extendedprice", on=on, filter={"l_returnflag": "A"}),)),
    ])
    plan = initial_plan(settle({"orders": orders, "lineitem": li}, [f])["orders"])
    assert re.search(r"PushedFilters: \[[^\]]*(Or\(EqualTo\(l_returnflag,R\),EqualTo\(l_returnflag,A\)\)|"
                     r"In\(l_returnflag, \[(A,R|R,A)\]\))", plan), plan
    assert len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan)) == 1


def test_hot_target_key_is_split_by_aqe(spark):
    """A third of the target rows on one key: the formula join runs as a skew join."""
    from pyspark.sql import functions as F

    from apportion.operators.formula import add_result_columns, settle
    from apportion.sources.readers import read_table
    from apportion.specs import Formula, Item, sum_of

    li = read_table(spark, "/root/testdata/sf0.01", "lineitem", ["l_orderkey", "l_returnflag", "l_extendedprice"])
    # several map tasks (the test file has one row group): AQE splits a skewed
    # partition along map outputs
    items = add_result_columns(li.select(
        F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("k"),
        F.col("l_extendedprice").alias("amt")).repartition(8), {"share": "double"})
    totals = items.groupBy("k").agg(F.sum("amt").alias("tot"))
    f = Formula.of("share", "items", [Item("share", "amt / $t", (sum_of("t", "totals", "tot", on="k", hot_keys=True),))])
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        check = settle({"items": items, "totals": totals}, [f])["items"].agg(F.sum("share").alias("s"))
        plan = final_plan(check)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan, [l for l in plan.splitlines() if "Join" in l or "AQEShuffleRead" in l or "ShuffleQueryStage" in l]
