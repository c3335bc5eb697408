"""Sources and sinks: JDBC (embedded in-memory Derby, no port), text, JSON,
parameterised scripts, normalisation, stored ids, upserts, saves, checkpoints."""

import datetime

import pytest
from pyspark.sql import functions as F

from apportion.sinks.upsert import merge_frame, split_changes
from apportion.sinks.writers import save, save_changed, write_jdbc
from apportion.sources.jdbc import hash_predicates, read_query, read_range, read_split
from apportion.sources.load import DATE, NUMBER, STRING, Field, assert_unique, attach_old_id, normalise, run_script
from apportion.sources.readers import read_format, read_json, read_table, read_text, scratch_path

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
SF = "/root/testdata/sf0.001"


def test_jdbc_roundtrip_and_splits(spark):
    url = "jdbc:derby:memory:apportion_t1;create=true"
    cust = read_table(spark, SF, "customer", ["c_custkey", "c_name", "c_acctbal"])
    write_jdbc(cust, url, "CUST", DERBY, mode="overwrite", batch_size=2000, partitions=3)
    n = cust.count()
    q = read_query(spark, url, 'SELECT "c_custkey", "c_acctbal" FROM CUST WHERE "c_acctbal" > 0', DERBY)
    assert q.count() == cust.where("c_acctbal > 0").count()
    preds = hash_predicates('"c_custkey"', 4, dialect="derby")
    split = read_split(spark, url, "CUST", preds, DERBY)
    assert split.rdd.getNumPartitions() == 4 and split.count() == n
    ranged = read_range(spark, url, "CUST", "c_custkey", 0, n, 5, DERBY)
    assert ranged.rdd.getNumPartitions() == 5 and ranged.count() == n
    # a predicate on the DataFrame reaches the database query
    plan = split.where(F.col("c_custkey") < 10)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "c_custkey" in plan


def test_hash_predicates_bounds():
    assert len(hash_predicates("ID", 50)) == 50
    assert hash_predicates("ID", 2) == ["(MOD(ORA_HASH(ID, 10000), 2) = 0 OR ID IS NULL)", "MOD(ORA_HASH(ID, 10000), 2) = 1"]
    assert len(hash_predicates("ID", 20000, "mysql")) == 20000
    for n, dialect in ((10000, "oracle"), (0, "mysql")):
        with pytest.raises(ValueError):
            hash_predicates("ID", n, dialect)


def test_split_reads_null_keys(spark):
    url = "jdbc:derby:memory:apportion_t3;create=true"
    rows = spark.createDataFrame([(k, k) for k in range(10)] + [(None, -1), (None, -2)], "k int, v int")
    write_jdbc(rows, url, "SPLIT", DERBY, mode="overwrite")
    assert read_split(spark, url, "SPLIT", hash_predicates('"k"', 3, "derby"), DERBY).count() == 12


def test_text_and_json_sources(spark):
    base = scratch_path(spark, "io")
    ev = read_table(spark, SF, "events")
    ev.select("props").write.text(base + "/text")
    assert read_text(spark, base + "/text").count() == ev.count()
    ev.write.json(base + "/json")
    back = read_json(spark, base + "/json", "event_id long, value double")
    assert back.count() == ev.count()
    assert back.agg(F.sum("value")).first()[0] == pytest.approx(ev.agg(F.sum("value")).first()[0])


def test_scan_with_columns_and_predicate_pushes_down(spark):
    df = read_format(spark, "parquet", f"{SF}/lineitem.parquet", columns=["l_orderkey", "l_quantity"],
                     where="l_returnflag = 'R'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in plan


def test_run_script_parameters_are_bound(spark):
    orders = read_table(spark, SF, "orders")
    got = run_script(spark, "SELECT count(*) AS n FROM {o} WHERE o_orderstatus = :s", {"s": "F' OR '1'='1"},
                     o=orders).first()["n"]
    assert got == 0  # the value is bound, not spliced into the text
    with pytest.raises(ValueError):
        run_script(spark, "SELECT 1", None)
    cols = run_script(spark, "SELECT {c} FROM {o} LIMIT 1", {}, raw={"c": "o_orderkey"},
                      allowed_raw={"o_orderkey"}, o=orders).columns
    assert cols == ["o_orderkey"]
    with pytest.raises(ValueError, match="allow-list"):
        run_script(spark, "SELECT {c} FROM {o}", {}, raw={"c": "1; DROP TABLE x"}, o=orders)
    with pytest.raises(Exception):
        run_script(spark, "SELECT * FROM {o} WHERE o_orderstatus = :missing", {}, o=orders).collect()
    rng = run_script(spark, "SELECT count(*) AS n FROM {o} WHERE o_orderdate BETWEEN :a AND :b",
                     {"a": datetime.date(1995, 1, 1), "b": datetime.date(1995, 12, 31)}, o=orders).first()["n"]
    assert rng == orders.where("o_orderdate >= '1995-01-01' AND o_orderdate < '1996-01-01'").count()


def test_normalise_rules(spark):
    df = spark.createDataFrame(
        [("1", "2.5", None, datetime.datetime(2020, 1, 2, 3, 4, 5), bytearray(b"\x01\xff")),
         ("2", None, 3.0, None, None)],
        "id string, txt string, num double, ts timestamp_ntz, raw binary")
    out = normalise(df, [Field("id", "ID", STRING, is_key=True), Field("txt", "T", NUMBER),
                         Field("num", "N", NUMBER), Field("ts", "D", DATE), Field("raw", "R", STRING),
                         Field("missing", "M", NUMBER)]).orderBy("ID").collect()
    assert out[0]["T"] == 2.5 and out[0]["N"] == 0.0 and out[0]["D"] == "20200102030405" and out[0]["R"] == "01FF"
    assert out[1]["T"] == 0.0 and out[1]["D"] is None and out[1]["R"] is None and out[1]["M"] == 0.0
    assert out[0]["row_id"] != out[1]["row_id"] and len(out[0]["row_id"]) == 64
    for text in ("oops", "12,5", ""):
        bad = spark.createDataFrame([(text,)], "txt string")
        with pytest.raises(Exception, match="not a number"):
            normalise(bad, [Field("txt", "T", NUMBER)]).collect()


def test_attach_old_id_and_uniqueness_guard(spark):
    src = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    tgt = spark.createDataFrame([("a", "ID-A"), ("c", "ID-C")], "k string, pk string")
    out = dict((r["k"], r["OLD_ID"]) for r in attach_old_id(src, tgt, ["k"], "pk").collect())
    assert out == {"a": "ID-A", "b": None, "c": "ID-C"}
    assert_unique(tgt, ["k"], src)
    dup = tgt.unionByName(spark.createDataFrame([("c", "ID-C2")], "k string, pk string"))
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(dup, ["k"], src)
    # duplicates on keys the source does not have are ignored
    assert_unique(dup, ["k"], src.where("k <> 'c'"))
    assert attach_old_id(src.where("k <> 'c'"), dup, ["k"], "pk").count() == 2
    with pytest.raises(Exception, match="not unique"):
        attach_old_id(src, dup, ["k"], "pk").collect()
    nulls = tgt.unionByName(spark.createDataFrame([(None, "N1"), (None, "N2")], "k string, pk string"))
    odd = src.unionByName(spark.createDataFrame([(None, 4)], "k string, v int"))
    assert {r["v"]: r["OLD_ID"] for r in attach_old_id(odd, nulls, ["k"], "pk").collect()} == {1: "ID-A", 2: None, 3: "ID-C", 4: None}


def test_split_and_merge(spark):
    changed = spark.createDataFrame(
        [("a", 10.0, "20200101000000", "ID-A"), ("b", 20.0, "20200202000000", None)],
        "k string, v double, d string, OLD_ID string")
    ins, upd = split_changes(changed, {"k": "pk", "v": "val", "d": "day"}, pk="pk", dates=["d"])
    assert ins.columns == ["pk", "val", "day"] and ins.first()["day"] == datetime.datetime(2020, 2, 2)
    assert upd.columns == ["pk", "val", "day"] and upd.first()["pk"] == "ID-A"
    stored = spark.createDataFrame([("ID-A", 1.0, None, "keep"), ("ID-Z", 2.0, None, "z")],
                                   "pk string, val double, day timestamp_ntz, note string")
    merged = {r["pk"]: r for r in merge_frame(stored, ins, upd, "pk").collect()}
    assert merged["ID-A"]["val"] == 10.0 and merged["ID-A"]["note"] == "keep"
    assert merged["ID-Z"]["val"] == 2.0 and merged["b"]["val"] == 20.0 and merged["b"]["note"] is None


def test_jdbc_upsert_through_staging(spark):
    url = "jdbc:derby:memory:apportion_t2;create=true"
    stored = spark.createDataFrame([("ID-A", 1.0), ("ID-Z", 2.0)], "pk string, val double")
    write_jdbc(stored, url, "TARGET", DERBY, mode="overwrite")
    ins = spark.createDataFrame([("b", 20.0)], "pk string, val double")
    upd = spark.createDataFrame([("ID-A", 10.0)], "pk string, val double")
    current = read_query(spark, url, "SELECT * FROM TARGET", DERBY)
    new = merge_frame(current, ins, upd, "pk")
    staged = new.checkpoint(eager=True)  # reliable copy before the target is replaced
    write_jdbc(staged, url, "TARGET", DERBY, mode="overwrite")
    got = dict((r["pk"], r["val"]) for r in read_query(spark, url, "SELECT * FROM TARGET", DERBY).collect())
    assert got == {"ID-A": 10.0, "ID-Z": 2.0, "b": 20.0}


def test_save_overwrite_and_changed_order(spark):
    base = scratch_path(spark, "save")
    df = read_table(spark, SF, "region")
    save(df, base + "/r")
    save(df.where("r_regionkey < 2"), base + "/r")
    assert spark.read.parquet(base + "/r").count() == 2
    seen = []
    save_changed({"a": df, "b": df}, ["b", "a"], lambda name, d: seen.append(name))
    assert seen == ["b", "a"]


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    from apportion import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_appended_files_are_read(spark):
    base = scratch_path(spark, "append")
    spark.range(10).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(base + "/t.parquet")
    assert read_table(spark, base, "t").count() == 10
    spark.range(5).withColumn("p", F.lit(1)).write.mode("append").partitionBy("p").parquet(base + "/t.parquet")
    assert read_table(spark, base, "t").count() == 15


def test_checkpoint_dir_from_session(spark):
    d = spark.sparkContext.getCheckpointDir()
    assert d
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))


def test_tag_and_merge_in_one_pass(spark):
    from apportion.sinks.upsert import merge_changes, tag_changes

    changed = spark.createDataFrame(
        [("a", 10.0, "20200101000000", "ID-A"), ("b", 20.0, "20200202000000", None)],
        "k string, v double, d string, OLD_ID string")
    mapping = {"k": "pk", "v": "val", "d": "day"}
    tagged = {r["action"]: r for r in tag_changes(changed, mapping, pk="pk", dates=["d"]).collect()}
    assert tagged["update"]["pk"] == "ID-A" and tagged["insert"]["pk"] == "b"
    assert tagged["insert"]["day"] == datetime.datetime(2020, 2, 2)
    stored = spark.createDataFrame([("ID-A", 1.0, None, "keep"), ("ID-Z", 2.0, None, "z")],
                                   "pk string, val double, day timestamp_ntz, note string")
    merged = {r["pk"]: r for r in merge_changes(stored, changed, mapping, "pk", dates=["d"]).collect()}
    assert merged["ID-A"]["val"] == 10.0 and merged["ID-A"]["note"] == "keep"
    assert merged["ID-A"]["day"] == datetime.datetime(2020, 1, 1)
    assert merged["ID-Z"]["val"] == 2.0 and merged["b"]["val"] == 20.0 and merged["b"]["note"] is None
    plan = merge_changes(stored, changed, mapping, "pk")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.count("Aggregate") == 1  # inserts are neither joined nor grouped
    twice = changed.unionByName(changed)
    with pytest.raises(Exception, match="several changes"):
        merge_changes(stored, twice, mapping, "pk", dates=["d"]).collect()
    inserts = twice.where("OLD_ID is null")  # rows without a stored id are appended, each
    assert merge_changes(stored, inserts, mapping, "pk", dates=["d"]).count() == 4


def test_run_script_binds_identifiers(spark):
    orders = read_table(spark, SF, "orders")
    orders.createOrReplaceTempView("apportion_orders_v")
    n = run_script(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE o_orderstatus = :s",
                   {"t": "apportion_orders_v", "s": "F"}).first()["n"]
    assert n == orders.where("o_orderstatus = 'F'").count()
