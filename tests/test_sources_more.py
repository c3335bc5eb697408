"""Pages, bucketed tables, variants, one MERGE, wide hash predicates."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from apportion.operators.formula import add_result_columns, settle
from apportion.operators.pages import paged_list
from apportion.plans.job import Target
from apportion.sinks.writers import jdbc_merge_writer, merge_statement, write_jdbc
from apportion.sources.bucketed import save_bucketed
from apportion.sources.jdbc import hash_predicates, read_query
from apportion.sources.load import attach_old_id
from apportion.sources.semi import split_malformed, variant_field, variant_schema, with_variant
from apportion.specs import Formula, Item, list_of, sum_of


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(k, o, rng.randint(0, 9) or None, f"t{o}") for o, k in enumerate(["hot"] * 700 + [None] * 60 + [f"k{i % 40}" for i in range(200)])]


def test_pages_give_the_whole_list(spark, rows):
    df = spark.createDataFrame(rows, "k string, o long, v int, t string").repartition(5)
    got = paged_list(df, "k", [F.desc("o")], ["v", "t"], 64, partitions=9).collect()
    assert max(len(r["items"]) for r in got) == 64 and all(r.n == len(r["items"]) for r in got)
    lists = {}
    for r in sorted(got, key=lambda r: r.page):
        lists.setdefault(r.k, []).extend(tuple(x) for x in r["items"])
    expected = {}
    for k, _, v, t in sorted(rows, key=lambda r: -r[1]):
        expected.setdefault(k, []).append((v, t))
    assert lists == expected
    one = [r["items"] for r in paged_list(df, "k", ["o"], ["v"], 1000, partitions=9).where("k = 'hot'").collect()]
    assert one == [[v for k, _, v, _ in rows if k == "hot"]]


def test_pages_equal_the_list_input(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[0]], "k string, o long, v int, t string")
    keys = add_result_columns(df.select("k").distinct(), {"whole": "string"})
    whole = settle({"keys": keys, "rows": df}, [Formula.of("f", "keys", [Item("whole", "$l", (list_of("l", "rows", "v", on="k", fn="text", order_by=["o"]),))])])["keys"]
    pages = paged_list(df, "k", ["o"], ["v"], 50, form="text", out="part", partitions=7).collect()
    joined = {}
    for r in sorted(pages, key=lambda r: r.page):
        joined.setdefault(r.k, []).append(r.part)
    assert {k: ",".join(p for p in v if p) for k, v in joined.items()} == {r.k: r.whole for r in whole.collect()}


def test_json_pages_and_wrong_arguments(spark, rows):
    df = spark.createDataFrame(rows, "k string, o long, v int, t string")
    got = paged_list(df, "k", ["o"], ["t", "v"], 100, form="json", partitions=4).where("k = 'hot' and page = 6").first()
    assert [x["t"] for x in json.loads(got["items"])] == [r[3] for r in rows[600:700]]
    for wrong in ({"size": 0}, {"size": 5, "form": "csv"}, {"size": 5, "form": "text"}, {"size": 5, "out": "k"}):
        with pytest.raises(ValueError):
            paged_list(df, "k", ["o"], ["t", "v"], **wrong)
    assert paged_list(df.where("false"), "k", ["o"], ["t"], 5).collect() == []


def test_a_bucketed_table_does_not_move(spark, tmp_path):
    stored = spark.range(5000).select(F.col("id").alias("no"), F.concat(F.lit("ID-"), F.col("id")).alias("pk"), F.lit(2.0).alias("x"))
    table = save_bucketed(stored, f"t_{uuid.uuid4().hex}", ["no"], 8, str(tmp_path / "b"))
    src = spark.range(20000).select((F.col("id") % 6000).alias("no"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = attach_old_id(src, table, ["no"], "pk")
        plan = out._jdf.queryExecution().executedPlan().toString()
        f = Formula.of("f", "t", [Item("r", "$s", (sum_of("s", "stored", "x", on="no"),))])
        formula = settle({"t": add_result_columns(src, {"r": "double"}), "stored": table}, [f])["t"]
        second = formula._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for text in (plan, second):
        assert text.count("Exchange ") == 1 and "Bucketed: true" in text, text  # the source side alone
    assert out.where("OLD_ID is null").count() == sum(1 for i in range(20000) if i % 6000 >= 5000)


def test_variants_and_malformed_texts(spark):
    texts = [(1, '{"a": 5, "b": {"c": [1, "x"]}}'), (2, '{"a": "text"}'), (3, "{broken"), (4, None), (5, "[1, 2]"), (6, '{"a": null}'), (7, "")]
    df = spark.createDataFrame(texts, "i int, t string")
    read = with_variant(df, "t")
    assert {r.i for r in read.where("malformed").collect()} == {3, 7}
    assert {r.i: r.a for r in read.select("i", variant_field("variant", "$.a", "int").alias("a")).collect()} == {1: 5, 2: None, 3: None, 4: None, 5: None, 6: None, 7: None}
    assert {r.i: r.c for r in read.select("i", variant_field("variant", "$.b.c[1]", "string").alias("c")).where("c is not null").collect()} == {1: "x"}
    good, bad = split_malformed(df, "t")
    assert sorted(r.i for r in good.collect()) == [1, 2, 4, 5, 6] and bad.columns == ["i", "t"] and sorted(r.i for r in bad.collect()) == [3, 7]
    assert "a" in variant_schema(good.where("i = 1"), "variant")


URL, DERBY = "jdbc:derby:memory:apportion_merge;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_one_merge_applies_updates_and_inserts(spark):
    run = []

    def execute(sql):
        run.append(sql)
        connection = spark._jvm.java.sql.DriverManager.getConnection(URL)
        try:
            connection.createStatement().execute(sql)
        finally:
            connection.close()

    types = {"ID": "VARCHAR(64)"}
    write_jdbc(spark.createDataFrame([("a", 1.0, "n"), ("b", 2.0, "n")], "ID string, VAL double, NOTE string"), URL, "KEPT",
               DERBY | {"createTableColumnTypes": "ID VARCHAR(64)"}, mode="overwrite")
    write = jdbc_merge_writer(URL, execute, DERBY, types=types)
    target = Target("KEPT", "ID", {"k": "ID", "v": "VAL"})
    inserts = spark.createDataFrame([("c", 7.0)], "ID string, VAL double")
    updates = spark.createDataFrame([("a", 5.0), ("gone", 6.0)], "ID string, VAL double")
    write(target, inserts, updates)
    assert len(run) == 1  # all changes of a data set in one statement
    got = {r.ID: (r.VAL, r.NOTE) for r in read_query(spark, URL, "SELECT * FROM KEPT", DERBY).collect()}
    assert got == {"a": (5.0, "n"), "b": (2.0, "n"), "c": (7.0, None)}
    write(target, inserts.where("false").drop("ID"), updates.where("false"))
    write(target, inserts.drop("ID"), updates.where("false"))  # the store makes the key
    assert read_query(spark, URL, "SELECT * FROM KEPT", DERBY).count() == 4
    assert merge_statement("T", "S", [], ["A"], "ID", "WHERE").endswith("INSERT (A) VALUES (s.A) WHERE s.STAGED_NEW = 1")


def test_hash_predicates_cover_the_smallest_numbers(spark):
    numbers = [(-(2**63),), (2**63 - 1,), (-1,), (0,), (7,), (None,)]
    write_jdbc(spark.createDataFrame(numbers, "N long"), URL, "NUMBERS", DERBY, mode="overwrite")
    parts = [read_query(spark, URL, f"SELECT * FROM NUMBERS WHERE {p}", DERBY).collect() for p in hash_predicates("N", 3, "derby")]
    assert sorted(map(repr, (tuple(r) for p in parts for r in p))) == sorted(map(repr, numbers))
    assert all("BIGINT" in p for p in hash_predicates("c", 3, "postgres"))
