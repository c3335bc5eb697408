"""The whole job: data set SQL with parameters -> stored ids -> formulas -> insert/update save (Derby)."""

import datetime

import pytest
from pyspark.sql import functions as F

from apportion.plans.job import DataSet, Target, load, run, save
from apportion.sinks.writers import jdbc_merge_writer, write_jdbc
from apportion.sources.jdbc import read_query
from apportion.sources.load import DATE, NUMBER, STRING, Field
from apportion.sources.readers import read_table
from apportion.specs import Formula, Item, sum_of

SF = "/root/testdata/sf0.001"
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
URL = "jdbc:derby:memory:apportion_job;create=true"

ORDERS = DataSet(
    "orders",
    "SELECT o_orderkey, o_totalprice, o_orderdate, NULL AS billed FROM {orders} "
    "WHERE o_orderdate BETWEEN :start AND :end",
    (Field("o_orderkey", "ORDER_NO", STRING, is_key=True), Field("o_totalprice", "price", NUMBER),
     Field("o_orderdate", "order_time", DATE), Field("billed", "billed", NUMBER)),
    Target("SETTLED", "ID", {"ORDER_NO": "ORDER_NO", "billed": "BILLED", "order_time": "ORDER_TIME"}),
)
LINES = DataSet("lines", "SELECT l_orderkey, l_extendedprice FROM {lineitem}",
                (Field("l_orderkey", "ORDER_NO", STRING), Field("l_extendedprice", "price", NUMBER)))
FORMULAS = [Formula.of("billed", "orders", [
    Item("billed", "round($s, 2)", (sum_of("s", "lines", "price", on="ORDER_NO"),))])]
PARAMS = {"start": datetime.date(1995, 1, 1), "end": datetime.date(1996, 12, 31)}


def test_spec_validation():
    with pytest.raises(ValueError, match="key fields"):
        DataSet("x", "SELECT 1", (Field("a", "A", NUMBER),), Target("T", "ID", {"A": "A"}))
    with pytest.raises(ValueError, match="unknown fields"):
        DataSet("x", "SELECT 1", (Field("a", "A", STRING, is_key=True),), Target("T", "ID", {"A": "A", "B": "B"}))


def derby(spark, sql):
    """Run one statement in the in-memory database; it has quoted lower-case names for staging tables' columns."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(URL)
    try:
        connection.createStatement().execute(sql)
    finally:
        connection.close()


def test_settlement_end_to_end(spark):
    tables = {"orders": read_table(spark, SF, "orders"), "lineitem": read_table(spark, SF, "lineitem")}
    in_range = tables["orders"].where("o_orderdate BETWEEN DATE'1995-01-01' AND DATE'1996-12-31'")
    stored0 = in_range.where("o_orderstatus = 'F'").select(
        F.concat(F.lit("S-"), F.col("o_orderkey").cast("string")).alias("ID"),
        F.col("o_orderkey").cast("string").alias("ORDER_NO"), F.lit(-1.0).alias("BILLED"),
        F.lit(None).cast("timestamp_ntz").alias("ORDER_TIME"))
    types = {"ID": "VARCHAR(64)", "ORDER_NO": "VARCHAR(64)"}
    write_jdbc(stored0, URL, "SETTLED", DERBY | {"createTableColumnTypes": ", ".join(map(" ".join, types.items()))},
               mode="overwrite")

    def read_stored(table):
        return read_query(spark, URL, f"SELECT * FROM {table}", DERBY)

    res = run(spark, [ORDERS, LINES], FORMULAS, PARAMS, tables, read_stored=read_stored)
    assert res.changed == ["orders"]
    written = []
    merge_into_db = jdbc_merge_writer(URL, lambda sql: derby(spark, sql), DERBY, types=types)

    def write(target, inserts, updates):
        written.append((target.table, inserts.count(), updates.count()))
        merge_into_db(target, inserts, updates)

    assert save(res, [ORDERS, LINES], write) == ["orders"]
    n_all, n_f = in_range.count(), stored0.count()
    assert written == [("SETTLED", n_all - n_f, n_f)]
    final = read_stored("SETTLED")
    assert final.count() == n_all
    want = {r[0]: r[1] for r in tables["lineitem"].groupBy(F.col("l_orderkey").cast("string"))
            .agg(F.round(F.sum("l_extendedprice"), 2)).collect()}
    got = {r["ORDER_NO"]: (r["ID"], r["BILLED"], r["ORDER_TIME"]) for r in final.collect()}
    for order_no, (pk, billed, ts) in got.items():
        assert billed == pytest.approx(want.get(order_no, 0.0))
        assert ts is not None
    kept_ids = {r["ID"] for r in stored0.collect()}
    assert {pk for pk, _, _ in got.values() if pk is not None} == kept_ids


def test_duplicate_stored_keys_stop_the_load(spark):
    tables = {"orders": read_table(spark, SF, "orders")}
    key = str(tables["orders"].where("o_orderdate BETWEEN DATE'1995-01-01' AND DATE'1996-12-31'")
              .agg(F.min("o_orderkey")).first()[0])
    dup = spark.createDataFrame([("A", key), ("B", key)], "ID string, ORDER_NO string")
    with pytest.raises(Exception, match="not unique"):
        load(spark, ORDERS, PARAMS, tables, dup).collect()
