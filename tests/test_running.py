"""Running rules against a plain fold."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from apportion.operators.running import CLAMPED_DOUBLE, CLAMPED_LONG, Steps, composed, keyed_fold, running_balance


def fold(rows, floor=None, cap=None, factor=1, start=0):
    """rows: (key, order, add); states in order per key."""
    out, state = {}, {}
    for k, o, add in sorted(rows, key=lambda r: (repr(r[0]), r[1])):
        x = factor * state.get(k, start) + (add or 0)
        x = x if floor is None else max(x, floor)
        x = x if cap is None else min(x, cap)
        out[o] = state[k] = x
    return out


def items(seed, n=1500, nulls=True):
    """A third of all rows on one key, a third on the null key."""
    rng = random.Random(seed)
    keys = ["hot"] * (n // 3) + [None] * (n // 3) + [f"k{rng.randint(0, 200)}" for _ in range(n - 2 * (n // 3))]
    rng.shuffle(keys)
    return [(k, o, None if nulls and rng.random() < 0.05 else rng.randint(-60, 60)) for o, k in enumerate(keys)]


@pytest.mark.parametrize("floor, cap, start", [(0, 100, 0), (None, None, 5), (0, None, 50), (None, 10, 0), (-20, 20, 7), (30, 10, 0)])
def test_random_balances_against_a_fold(spark, floor, cap, start):
    rows = items(floor or 1)
    df = spark.createDataFrame(rows, "k string, o long, a long").repartition(5)
    got = running_balance(df, "k", ["o"], "a", floor=floor, cap=cap, start=start, partitions=11)
    assert got.columns == ["k", "o", "a", "balance"]
    assert {r.o: r.balance for r in got.collect()} == fold(rows, floor, cap, start=start)


def test_decimals_are_exact(spark):
    rows = [(k, o, None if a is None else Decimal(a) / 100) for k, o, a in items(2)]
    df = spark.createDataFrame(rows, "k string, o long, a decimal(12,2)")
    got = running_balance(df, ["k"], [F.asc("o")], "a", floor=0, cap=F.lit(Decimal("1.23")), out="left", partitions=7)
    assert dict(got.dtypes)["left"] == "decimal(20,2)"
    assert {r.o: r.left for r in got.collect()} == fold(rows, Decimal(0), Decimal("1.23"))


def test_decay_and_bounds_by_row(spark):
    rows = items(3, nulls=False)
    df = spark.createDataFrame([(k, o, float(a)) for k, o, a in rows], "k string, o long, a double")
    got = {r.o: r.balance for r in running_balance(df, "k", ["o"], "a", factor=0.5, floor=-10.0, partitions=9).collect()}
    expected = fold(rows, floor=-10, factor=0.5)
    assert all(abs(got[o] - expected[o]) < 1e-9 for o in expected)
    reset = F.when(F.col("o") % 10 == 0, 3)  # a reset: floor and cap are the value
    low, high = F.coalesce(reset, F.lit(-10**9)), F.coalesce(reset, F.lit(10**9))
    whole = spark.createDataFrame(rows, "k string, o long, a long")
    got = {r.o: r.balance for r in running_balance(whole, "k", ["o"], "a", floor=low, cap=high, partitions=9).collect()}
    state, expected = {}, {}
    for k, o, a in sorted(rows, key=lambda r: r[1]):
        state[k] = expected[o] = 3 if o % 10 == 0 else state.get(k, 0) + a
    assert got == expected


def test_ties_repeated_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1, 1)] * 50 + [("b", 1, 2)] * 3, "k string, o long, a long")
    got = running_balance(df, "k", ["o"], "a", partitions=6).collect()
    assert sorted(r.balance for r in got if r.k == "a") == list(range(1, 51)) and sorted(r.balance for r in got if r.k == "b") == [2, 4, 6]
    assert running_balance(df.where("false"), "k", ["o"], "a").collect() == []


def test_own_family_of_steps(spark):
    """A user's own closed family: the running maximum."""
    largest = Steps(1, "long", lambda a, b: (np.maximum(a[0], b[0]),), lambda s, x: np.maximum(s[0], x))
    rows = items(4, nulls=False)
    df = spark.createDataFrame(rows, "k string, o long, a long")
    got = {r.o: r.state for r in keyed_fold(df, ["k"], ["o"], [F.col("a")], largest, start=-1000, partitions=8).collect()}
    state, expected = {}, {}
    for k, o, a in rows:
        state[k] = expected[o] = max(state.get(k, -1000), a)
    assert got == expected


@pytest.mark.parametrize("family", [CLAMPED_LONG, CLAMPED_DOUBLE])
def test_composition_agrees_with_steps_one_by_one(family):
    rng = np.random.default_rng(0)
    n = 300
    low = rng.integers(-50, 0, n).astype(family.dtype)
    steps = (rng.integers(0, 2, n).astype(family.dtype), rng.integers(-30, 30, n).astype(family.dtype), low, low + rng.integers(0, 90, n).astype(family.dtype))
    starts = np.maximum.accumulate(np.where(rng.random(n) < 0.05, np.arange(n), 0))
    got = family.apply(composed(steps, starts, family), np.full(n, 4, family.dtype))
    state = None
    for i in range(n):
        before = 4 if starts[i] == i else state
        state = family.apply(tuple(s[i : i + 1] for s in steps), np.array([before], family.dtype))[0]
        assert got[i] == state


def test_hot_key_is_split(spark):
    """No range holds more than a small part of a key with most of the rows."""
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("o"), F.lit(1).alias("a"))
    got = running_balance(df, "k", ["o"], "a", cap=10**9, partitions=16)
    assert got.agg(F.max("balance"), F.count("*")).first() == (20000, 20000)
    from apportion.sources.readers import read_format  # the ranges are data: read them back

    path = got.inputFiles()[0].rsplit("/", 1)[0]
    sizes = [r["count"] for r in read_format(spark, "parquet", path).groupBy("__range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 20000 / 16
