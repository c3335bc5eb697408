"""Partial rewrites and saves of several tables at once."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from apportion.plans.job import DataSet, Target, run
from apportion.sinks.stored_table import create_stored, read_stored, save_changes
from apportion.sinks.together import SaveConflict, _commit, manifests, read_saved, save_settled, save_together
from apportion.sources.load import NUMBER, STRING, Field
from apportion.specs import Formula, Item


def files(path):
    return {d.rsplit("=", 1)[1]: sorted(f for f in names if f.endswith(".parquet")) for d, _, names in os.walk(path) if "bucket=" in d}


def test_only_touched_folders_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    create_stored(spark.range(1000).select(F.col("id"), F.lit(1.0).alias("v"), F.lit("n").alias("note")), path, "id", 32)
    before = files(path)
    assert len(before) == 32 and all(len(f) == 1 for f in before.values())
    changed = spark.createDataFrame([(5, 2.0), (6, 3.0)], "OLD_ID long, x double")
    touched = save_changes(changed, path, {"x": "v"}, "id", 32)
    after = files(path)
    assert 1 <= len(touched) <= 2
    assert {b for b in before if before[b] != after[b]} == {str(t) for t in touched}
    got = read_stored(spark, path)
    assert got.count() == 1000 and {r.id: r.v for r in got.where("v <> 1").collect()} == {5: 2.0, 6: 3.0}
    assert got.where("note <> 'n'").count() == 0


def test_a_wider_change_keeps_the_stored_types(spark, tmp_path):
    path = str(tmp_path / "t")
    create_stored(spark.range(64).select(F.col("id"), F.lit(1).cast("decimal(9,2)").alias("v"), F.lit(1).alias("k")), path, "id", 16)
    changed = spark.range(9).select(F.col("id").alias("OLD_ID"), F.lit(2).cast("decimal(28,2)").alias("x"), F.lit(5).cast("bigint").alias("y"))
    save_changes(changed, path, {"x": "v", "y": "k"}, "id", 16)
    got = read_stored(spark, path)
    assert dict(got.dtypes) == {"id": "bigint", "v": "decimal(9,2)", "k": "int"}
    assert got.agg(F.sum("v"), F.sum("k")).first() == (Decimal("73.00"), 64 + 9 * 4)


def test_inserts_are_added_and_rewrite_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    create_stored(spark.range(100).select(F.col("id"), F.lit(1.0).alias("v")), path, "id", 8)
    before = files(path)
    changed = spark.range(400).select(F.lit(None).cast("long").alias("OLD_ID"), F.col("id").cast("double").alias("x"))
    assert save_changes(changed, path, {"x": "v"}, "id", 8) == []
    after = files(path)
    assert all(set(before[b]) < set(after[b]) for b in before)  # rows without a key are spread
    assert read_stored(spark, path).count() == 500 and read_stored(spark, path).where("id is null").count() == 400


def test_updates_and_inserts_again_and_again(spark, tmp_path):
    """Against a dict, with text keys, unmapped columns, several updates of one row, an empty table and empty changes."""
    path, expected = str(tmp_path / "t"), {}
    schema = spark.createDataFrame([], "pk string, v decimal(9,2), note string").schema
    create_stored(spark.createDataFrame([], schema), path, "pk", 4)
    for k in range(3):
        rows = [(f"k{i}" if i % 2 else f"n{k}-{i}", f"k{i}" if f"k{i}" in expected and i % 2 else None, Decimal(i + k)) for i in range(10)]
        changed = spark.createDataFrame(rows, "key string, OLD_ID string, x decimal(9,2)")
        save_changes(changed, path, {"key": "pk", "x": "v"}, "pk", 4, schema=schema)
        expected.update({key: x for key, _, x in rows})
        assert {r.pk: r.v for r in read_stored(spark, path, schema).collect()} == expected
    assert save_changes(changed.where("false"), path, {"key": "pk", "x": "v"}, "pk", 4) == []
    with pytest.raises(Exception, match="several changes"):
        save_changes(spark.createDataFrame([("k1", Decimal(1)), ("k1", Decimal(2))], "OLD_ID string, x decimal(9,2)"), path, {"x": "v"}, "pk", 4)
    assert {r.pk: r.v for r in read_stored(spark, path).collect()} == expected  # a failed job leaves the table
    with pytest.raises(ValueError, match="taken"):
        create_stored(spark.range(3).withColumn("bucket", F.lit(1)), str(tmp_path / "u"), "id", 2)


def test_all_tables_or_none(spark, tmp_path):
    root = str(tmp_path / "r")
    assert read_saved(spark, root, "a") is None
    one, two = spark.range(3), spark.range(5)
    assert save_together({"a": one, "b": two}, root, "job-1") == 1
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        save_together({"a": two, "b": bad}, root, "job-2")
    assert read_saved(spark, root, "a").count() == 3 and read_saved(spark, root, "b").count() == 5
    assert save_together({"a": read_saved(spark, root, "a").union(one)}, root, "job-2") == 2  # reads what it replaces
    assert read_saved(spark, root, "a").count() == 6 and read_saved(spark, root, "b").count() == 5
    assert read_saved(spark, root, "a", version=1).count() == 3


def test_a_job_that_runs_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "r")
    save_together({"a": spark.range(3)}, root, "job-1")
    save_together({"a": spark.range(4)}, root, "job-2")
    assert save_together({"a": spark.range(9)}, root, "job-1") == 1
    assert [m["job"] for m in manifests(spark, root)] == ["job-1", "job-2"] and read_saved(spark, root, "a").count() == 4
    assert sorted(os.listdir(f"{root}/a")) == sorted(m["tables"]["a"].split("/")[1] for m in manifests(spark, root))


def test_two_saves_at_once(spark, tmp_path):
    root = str(tmp_path / "r")
    save_together({"a": spark.range(3)}, root, "job-1")
    with pytest.raises(SaveConflict):
        _commit(spark, root, {"version": 1, "job": "other", "tables": {}})
    assert len(manifests(spark, root)) == 1 and [f for f in os.listdir(f"{root}/_manifests") if f.endswith("json")] == ["00000001.json"]


def test_settlement_saved_as_one(spark, tmp_path):
    root = str(tmp_path / "r")
    tables = {"src": spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")}
    sets = [DataSet(n, "SELECT k, v, NULL AS r FROM {src}", (Field("k", "k", STRING, True), Field("v", "v", NUMBER), Field("r", "r", NUMBER)),
                    Target(f"T_{n}", "ID", {"k": "ID", "r": "R"})) for n in ("x", "y")]
    formulas = [Formula.of("fx", "x", [Item("r", "v * 10")]), Formula.of("fy", "y", [Item("r", "v * 100")])]
    assert save_settled(run(spark, sets, formulas, {}, tables), sets, root, "one") == 1
    tables["src"] = spark.createDataFrame([("b", 5.0), ("c", 6.0)], "k string, v double")
    result = run(spark, sets, formulas, {}, tables, read_stored=lambda t: read_saved(spark, root, t))
    assert save_settled(result, sets, root, "two") == 2
    assert {r.ID: r.R for r in read_saved(spark, root, "T_x").collect()} == {"a": 10.0, "b": 50.0, "c": 60.0}
    assert {r.ID: r.R for r in read_saved(spark, root, "T_y").collect()} == {"a": 100.0, "b": 500.0, "c": 600.0}
    with pytest.raises(ValueError, match="stored ids"):
        save_settled(run(spark, sets, formulas, {}, tables), sets, root, "three")
