"""Rows without a key match nothing and gather in no task."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from apportion.operators.formula import add_result_columns, settle
from apportion.operators.keys import join_matches
from apportion.sinks.upsert import merge_changes
from apportion.sources.load import attach_old_id
from apportion.specs import Formula, Item, avg_of, list_of, lookup, sum_of


@pytest.fixture
def plain_shuffles(spark):
    """16 partitions, no broadcasts, no help from adaptive execution."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def largest(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count")).first()


def target(spark):
    """Two thirds of 60,000 rows without a key."""
    return spark.range(60000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 500).alias("k"), F.col("id").cast("double").alias("v"))


@pytest.mark.parametrize("kind", [lookup, sum_of, avg_of, list_of])
def test_formula_joins(spark, plain_shuffles, kind):
    source = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("x"))
    value = {"list_of": "$i[0]"}.get(kind.__name__, "$i")
    f = Formula.of("f", "t", [Item("r", value, (kind("i", "s", "x", on="k"),))])
    out = settle({"t": add_result_columns(target(spark), {"r": "double"}), "s": source}, [f])["t"]
    most, total = largest(out.select("id", "k", "r"))
    assert total == 60000 and most < 3 * 60000 / 16
    assert out.where("(k is null and r <> 0) or (k is not null and r <> 2 * k)").count() == 0


def test_attach_old_id(spark, plain_shuffles):
    stored = spark.range(500).select(F.col("id").alias("no"), F.concat(F.lit("ID-"), F.col("id")).alias("pk"))
    out = attach_old_id(target(spark), stored, {"k": "no"}, "pk")
    most, total = largest(out)
    assert total == 60000 and most < 3 * 60000 / 16
    assert out.where("(k is null) <> (OLD_ID is null)").count() == 0


def test_inserts_without_a_key(spark, plain_shuffles):
    """90 % inserts whose key the store makes."""
    stored = spark.range(6000).select(F.concat(F.lit("ID-"), F.col("id")).alias("pk"), F.col("id").cast("double").alias("val"), F.lit("n").alias("note"))
    changed = spark.range(60000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("ID-"), (F.col("id") / 10).cast("long"))).alias("OLD_ID"), F.lit(7.0).alias("v"))
    merged = merge_changes(stored, changed, {"v": "val"}, "pk")
    most, total = largest(merged)
    assert total == 6000 + 54000 and most < 3 * 60000 / 16
    assert merged.where("val <> 7").count() == 0 and merged.where("pk is null").count() == 54000


def test_a_null_row_in_the_stored_table_stays(spark):
    stored = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "pk string, val double")
    changed = spark.createDataFrame([("a", 5.0), ("gone", 6.0)], "OLD_ID string, v double")
    assert sorted(map(repr, map(tuple, merge_changes(stored, changed, {"v": "val"}, "pk").collect()))) == ["('a', 5.0)", "(None, 1.0)"]


@pytest.mark.parametrize("dtype, value", [
    ("long", 5), ("int", 5), ("smallint", 5), ("tinyint", 5), ("double", 5.5), ("float", 5.5), ("string", "x"), ("decimal(5,2)", Decimal("1.25")),
    ("decimal(2,2)", Decimal("0.25")), ("decimal(38,0)", Decimal(7)), ("date", datetime.date(2020, 1, 1)), ("timestamp", datetime.datetime(2020, 1, 1)), ("boolean", True), ("binary", b"x")])
def test_every_key_type_matches_itself_only(spark, dtype, value):
    left = spark.createDataFrame([(i, value if i % 2 else None) for i in range(50)], f"i int, k {dtype}")
    right = spark.createDataFrame([(value, 1), (None, 2)], f"kk {dtype}, n int")
    assert sorted((r.i, r.n) for r in join_matches(left, right, [("k", "kk")]).collect()) == [(i, 1 if i % 2 else None) for i in range(50)]


def test_two_part_keys(spark):
    left = spark.createDataFrame([(1, 1, "a"), (2, None, "a"), (3, 1, None), (4, None, None), (5, 1, "b")], "i int, k int, t string")
    right = spark.createDataFrame([(1, "a", 10), (None, "a", 20), (1, None, 30), (None, None, 40)], "kk int, tt string, n int")
    assert {r.i: r.n for r in join_matches(left, right, [("k", "kk"), ("t", "tt")]).collect()} == {1: 10, 2: None, 3: None, 4: None, 5: None}
