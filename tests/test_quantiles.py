import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from apportion.operators.quantiles import keyed_quantiles

SHARES = {"least": 0, "tenth": "0.1", "q25": 0.25, "median": 0.5, "q90": 0.9, "q999": 0.999, "most": 1}


def plain(rows):
    out = {}
    for k, v in rows:
        if v is not None:
            out.setdefault(k, []).append(v)
    return {k: (len(v), *(sorted(v)[max(1, math.ceil(Decimal(str(q)) * len(v))) - 1] for q in SHARES.values())) for k, v in out.items()}


@pytest.mark.parametrize("kind", ["bigint", "decimal(9,2)", "string", "double"])
def test_random_against_sorted_lists(spark, kind):
    rng = random.Random(1)
    make = {"bigint": lambda x: x, "decimal(9,2)": lambda x: Decimal(x) / 100, "string": lambda x: f"{x:05d}", "double": lambda x: x / 7}[kind]
    rows = [(k, make(rng.randint(0, 10**rng.randint(1, 4)))) for k in ["hot"] * 700 + [None] * 300 + [f"k{rng.randint(0, 80)}" for _ in range(500)]]
    rows += [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, f"k string, v {kind}").repartition(4)
    got = keyed_quantiles(df, "k", "v", SHARES, partitions=13)
    assert {r.k: tuple(r)[1:] for r in got.collect()} == plain(rows)


def test_several_keys_ties_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", 5)] * 30 + [(1, "b", 2), (1, "b", 3)], "k int, n string, v int")
    got = keyed_quantiles(df.withColumnRenamed("n", "part"), ["k", "part"], "v", {"median": 0.5})
    assert sorted(map(tuple, got.collect())) == [(1, "a", 30, 5), (1, "b", 2, 2)]
    assert keyed_quantiles(df.where("false"), "k", "v", {"median": 0.5}).collect() == []
    for wrong in ({}, {"q": 1.5}, {"n": 0.5}):
        with pytest.raises(ValueError):
            keyed_quantiles(df, "k", "v", wrong)


def test_no_list_and_no_join_by_key(spark):
    df = spark.range(5000).select(F.lit("hot").alias("k"), "id")
    plan = keyed_quantiles(df, "k", "id", {"median": 0.5}, partitions=8)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in text and "percentile" not in text
    assert tuple(plan.first()) == ("hot", 5000, 2499)
