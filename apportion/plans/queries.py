"""Registered queries: each reads the given tables from ``sf_dir`` and runs one
operator family of the library over the whole tables.

Money columns are read as ``decimal(18,2)`` where a result is summed or
multiplied, so results are exact and do not depend on summation order; they
are returned as double.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.functions.scalar import before_last, hash_bucket, json_map, row_map, text_bucket, text_to_ts, ts_to_text
from apportion.functions.udfs import GEOMETRIC_MEAN, adler32, group_reduce
from apportion.operators.allocate import cogroup_running, waterfall
from apportion.operators.formula import add_result_columns, changed_datasets, settle
from apportion.operators.keys import first_per_key
from apportion.operators.scan import keyed_prefix_scan
from apportion.sinks.upsert import merge_changes, tag_changes
from apportion.sinks.writers import save, save_changed
from apportion.sources.load import DATE, NUMBER, STRING, Field, attach_old_id, duplicate_keys, normalise, run_script
from apportion.sources.readers import read_format, read_json, read_table, read_text, scratch_path
from apportion.specs import Formula, Item, avg_of, list_of, lookup, sum_of

Query = Callable[[SparkSession, str], DataFrame]

# (l_orderkey, l_linenumber) is not unique in lineitem; this column list is.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def dec2(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def with_dec(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: dec2(c) for c in cols})


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# --------------------------------------------------------------------- formulas

def q_sum_of(spark: SparkSession, d: str) -> DataFrame:
    """Each order's billed amount = sum of its line prices (aggregate, then left join)."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]),
                                {"billed": "double"})
    lineitem = with_dec(read_table(spark, d, "lineitem", ["l_orderkey", "l_extendedprice"]), "l_extendedprice")
    f = Formula.of("billed", "orders", [
        Item("billed", "$s", (sum_of("s", "lineitem", "l_extendedprice", on={"o_orderkey": "l_orderkey"}),))])
    return settle({"orders": orders, "lineitem": lineitem}, [f])["orders"]


def q_sum_of_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Sum over the returned ('R') line items only; the input filter reaches the scan."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey", "o_custkey"]), {"billed_r": "double"})
    lineitem = with_dec(read_table(spark, d, "lineitem", ["l_orderkey", "l_extendedprice", "l_returnflag"]),
                        "l_extendedprice")
    f = Formula.of("billed_r", "orders", [
        Item("billed_r", "$s", (sum_of("s", "lineitem", "l_extendedprice", on={"o_orderkey": "l_orderkey"},
                                       filter={"l_returnflag": "R"}),))])
    return settle({"orders": orders, "lineitem": lineitem}, [f])["orders"]


def q_avg_of(spark: SparkSession, d: str) -> DataFrame:
    """Each order's average line quantity."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey", "o_custkey"]), {"avg_qty": "double"})
    lineitem = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity"])
    f = Formula.of("avg_qty", "orders", [
        Item("avg_qty", "round($a, 6)", (avg_of("a", "lineitem", "l_quantity", on={"o_orderkey": "l_orderkey"}),))])
    return settle({"orders": orders, "lineitem": lineitem}, [f])["orders"]


def q_lookup_one(spark: SparkSession, d: str) -> DataFrame:
    """Each line item looks up its part's retail price (one-to-one, duplicates raise)."""
    li = add_result_columns(read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey",
                                                                "l_suppkey", "l_quantity"]),
                            {"list_value": "double"})
    part = read_table(spark, d, "part", ["p_partkey", "p_retailprice"])
    f = Formula.of("list_value", "lineitem", [
        Item("list_value", "CAST($p AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(18,2))",
             (lookup("p", "part", "p_retailprice", on={"l_partkey": "p_partkey"}),))])
    return settle({"lineitem": li, "part": part}, [f])["lineitem"].drop("l_quantity")


def q_lookup_multi_key(spark: SparkSession, d: str) -> DataFrame:
    """Share of an order in its customer's total for the same status: a sum matched on two columns."""
    orders = with_dec(read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]),
                      "o_totalprice")
    f = Formula.of("share", "orders", [
        Item("share", "round(o_totalprice / $t, 6)",
             (sum_of("t", "totals", "o_totalprice", on=["o_custkey", "o_orderstatus"]),))])
    frames = {"orders": add_result_columns(orders, {"share": "double"}), "totals": orders}
    return settle(frames, [f])["orders"].drop("o_totalprice")


def q_sum_global(spark: SparkSession, d: str) -> DataFrame:
    """An input without match columns: every region gets the sum over all customers."""
    region = add_result_columns(read_table(spark, d, "region"), {"total_bal": "double"})
    customer = with_dec(read_table(spark, d, "customer", ["c_acctbal"]), "c_acctbal")
    f = Formula.of("total_bal", "region", [Item("total_bal", "$s", (sum_of("s", "customer", "c_acctbal"),))])
    return settle({"region": region, "customer": customer}, [f])["region"]


def q_avg_global(spark: SparkSession, d: str) -> DataFrame:
    """A keyless average: every region gets the average balance of all customers."""
    region = add_result_columns(read_table(spark, d, "region"), {"avg_bal": "double"})
    customer = with_dec(read_table(spark, d, "customer", ["c_acctbal"]), "c_acctbal")
    f = Formula.of("avg_bal", "region", [Item("avg_bal", "round($a, 6)", (avg_of("a", "customer", "c_acctbal"),))])
    return settle({"region": region, "customer": customer}, [f])["region"]


def q_lookup_global(spark: SparkSession, d: str) -> DataFrame:
    """A keyless lookup: every customer's balance beside the one region named ASIA (its key)."""
    customer = add_result_columns(read_table(spark, d, "customer", ["c_custkey", "c_nationkey"]), {"asia": "bigint"})
    f = Formula.of("asia", "customer", [
        Item("asia", "$r", (lookup("r", "region", "r_regionkey", filter={"r_name": "ASIA"}),))])
    return settle({"customer": customer, "region": read_table(spark, d, "region")}, [f])["customer"]


def q_lookup_filtered_dup(spark: SparkSession, d: str) -> DataFrame:
    """Orders with status F look up the one priciest line; keys that match several rows
    belong to other orders, so the guard stays silent."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]), {"x": "double"})
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_extendedprice"])
    best = (li.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("price"))
            .join(read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus"]),
                  F.col("l_orderkey") == F.col("o_orderkey"))
            .select("l_orderkey", "price", F.explode(F.sequence(F.lit(1), F.when(
                F.col("o_orderstatus") == "F", 1).otherwise(2))).alias("copy")))
    f = Formula.of("x", "orders", [
        Item("x", "$p + $p * 2", (lookup("p", "best", "price", on={"o_orderkey": "l_orderkey"}),))],
        filter={"o_orderstatus": "F"})
    return settle({"orders": orders, "best": best}, [f])["orders"]


def q_filter_fractional(spark: SparkSession, d: str) -> DataFrame:
    """Numbers compare by value: 3.7 equals no integer, 3.0 and its text equal 3."""
    customer = add_result_columns(read_table(spark, d, "customer", ["c_custkey", "c_nationkey"]),
                                  {"a": "int", "b": "int", "c": "int"})
    fs = [Formula.of(n, "customer", [Item(n, "1")], filter={"c_nationkey": v})
          for n, v in (("a", 3.7), ("b", 3.0), ("c", "3.0"))]
    return settle({"customer": customer}, fs)["customer"]


def q_list_of(spark: SparkSession, d: str) -> DataFrame:
    """Each order's line numbers as text, in line order."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey", "o_custkey"]), {"lines": "string"})
    lineitem = read_table(spark, d, "lineitem", ["l_orderkey"] + LINE_ORDER)
    f = Formula.of("lines", "orders", [
        Item("lines", "$ls", (list_of("ls", "lineitem", "l_linenumber", on={"o_orderkey": "l_orderkey"},
                                      fn="text", order_by=LINE_ORDER),))])
    return settle({"orders": orders, "lineitem": lineitem}, [f])["orders"]


def q_list_fn(spark: SparkSession, d: str) -> DataFrame:
    """List functions: max, min and count as aggregates, and a fold over the list."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey"]),
                                {"max_qty": "double", "min_price": "double", "n_lines": "bigint",
                                 "sumsq_qty": "double"})
    lineitem = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity"] + LINE_ORDER)
    on = {"o_orderkey": "l_orderkey"}
    f = Formula.of("list_fns", "orders", [
        Item("max_qty", "$m", (list_of("m", "lineitem", "l_quantity", on=on, fn="max"),)),
        Item("min_price", "$m", (list_of("m", "lineitem", "l_extendedprice", on=on, fn="min"),)),
        Item("n_lines", "$n", (list_of("n", "lineitem", "l_quantity", on=on, fn="count"),)),
        Item("sumsq_qty", "$q", (list_of("q", "lineitem", "l_quantity", on=on, fn="sum_squares"),)),
    ])
    return settle({"orders": orders, "lineitem": lineitem}, [f])["orders"]


def q_list_as_objects(spark: SparkSession, d: str) -> DataFrame:
    """Each order's lines as maps (row -> map of text) with their positions in the order."""
    orders = read_table(spark, d, "orders", ["o_orderkey"])
    lineitem = read_table(spark, d, "lineitem", ["l_orderkey"] + LINE_ORDER)
    # the exploded form needs no list: a position in the key, from the scan that splits hot keys
    rows = keyed_prefix_scan(lineitem.withColumn("one", F.lit(1)), ["l_orderkey"], LINE_ORDER, "one")
    m = row_map(["l_linenumber", "l_partkey"])
    rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left_semi")
    return rows.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("scan_N") - 1).cast("int").alias("pos"),
                       m["l_linenumber"].alias("line"), m["l_partkey"].alias("part"))


def _line_frame(spark: SparkSession, d: str) -> DataFrame:
    return add_result_columns(
        read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_extendedprice", "l_discount", "l_tax"]),
        {"net": "decimal(20,4)", "gross": "decimal(24,6)"})


NET = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"
GROSS = "$n * (1 + CAST(l_tax AS DECIMAL(18,2)))"


def _line_formula() -> Formula:
    return Formula.of("line_amounts", "lineitem", [
        Item("net", NET),
        Item("gross", GROSS, (lookup("n", "lineitem", "net"),)),  # self lookup: item 1's result
    ])


def q_self_chain(spark: SparkSession, d: str) -> DataFrame:
    """Item 2 reads item 1's result on the same row."""
    out = settle({"lineitem": _line_frame(spark, d)}, [_line_formula()])["lineitem"]
    return as_double(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "net", "gross"),
                     "net", "gross")


def q_multi_input(spark: SparkSession, d: str) -> DataFrame:
    """One expression over a lookup, a sum and an average; sum and average share one join."""
    orders = add_result_columns(read_table(spark, d, "orders", ["o_orderkey", "o_custkey"]), {"score": "double"})
    customer = with_dec(read_table(spark, d, "customer", ["c_custkey", "c_acctbal"]), "c_acctbal")
    lineitem = with_dec(read_table(spark, d, "lineitem", ["l_orderkey", "l_extendedprice", "l_quantity"]),
                        "l_extendedprice")
    on = {"o_orderkey": "l_orderkey"}
    f = Formula.of("score", "orders", [
        Item("score", "$bal - $sp + $aq", (
            lookup("bal", "customer", "c_acctbal", on={"o_custkey": "c_custkey"}),
            sum_of("sp", "lineitem", "l_extendedprice", on=on),
            avg_of("aq", "lineitem", "l_quantity", on=on),
        ))])
    return settle({"orders": orders, "customer": customer, "lineitem": lineitem}, [f])["orders"]


def formula_chain_frames(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    orders = add_result_columns(
        read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]),
        {"billed": "decimal(24,4)", "gap": "decimal(24,4)"})
    customer = add_result_columns(read_table(spark, d, "customer", ["c_custkey"]),
                                  {"exposure": "decimal(28,4)", "avg_gap": "double"})
    return {"lineitem": _line_frame(spark, d), "orders": orders, "customer": customer}


def formula_chain_formulas() -> list[Formula]:
    return [
        _line_formula(),
        Formula.of("order_gap", "orders", [
            Item("billed", "$b", (sum_of("b", "lineitem", "net", on={"o_orderkey": "l_orderkey"}),)),
            Item("gap", "CAST(o_totalprice AS DECIMAL(18,2)) - billed"),
        ], filter={"o_orderstatus": "F"}),
        Formula.of("customer_exposure", "customer", [
            Item("exposure", "$e", (sum_of("e", "orders", "gap", on={"c_custkey": "o_custkey"}),)),
            Item("avg_gap", "CAST($a AS DOUBLE)", (avg_of("a", "orders", "gap", on={"c_custkey": "o_custkey"}),)),
        ]),
    ]


def q_formula_chain(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: lineitem -> orders -> customer, three ordered formulas over one lazy plan."""
    out = settle(formula_chain_frames(spark, d), formula_chain_formulas())["customer"]
    return as_double(out, "exposure")


def q_formula_chain_checkpointed(spark: SparkSession, d: str) -> DataFrame:
    """The flagship chain with its lineage cut after every formula by a reliable
    checkpoint into ``spark.checkpoint.dir`` (what a long chain does)."""
    out = settle(formula_chain_frames(spark, d), formula_chain_formulas(), checkpoint_every=1)["customer"]
    return as_double(out, "exposure")


def q_formula_filter(spark: SparkSession, d: str) -> DataFrame:
    """Conditional update: only BUILDING customers change; no orders (null result) keeps the old value."""
    out = _filtered_customers(spark, d)
    return as_double(out.select("c_custkey", "c_mktsegment", "c_acctbal"), "c_acctbal")


def _filtered_customers(spark: SparkSession, d: str) -> DataFrame:
    customer = with_dec(read_table(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]),
                        "c_acctbal")
    orders = with_dec(read_table(spark, d, "orders", ["o_custkey", "o_totalprice"]), "o_totalprice")
    f = Formula.of("bonus", "customer", [
        Item("c_acctbal", "c_acctbal + $s * 0.001",
             (sum_of("s", "orders", "o_totalprice", on={"c_custkey": "o_custkey"}),))],
        filter={"c_mktsegment": "BUILDING"})
    return settle({"customer": customer, "orders": orders}, [f])["customer"]


def q_constant_formula(spark: SparkSession, d: str) -> DataFrame:
    """A formula without inputs; the filter value is text, compared as a number."""
    customer = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    f = Formula.of("fixed", "customer", [Item("c_acctbal", "100.00")], filter={"c_nationkey": "3"})
    return settle({"customer": customer}, [f])["customer"]


# ----------------------------------------------------------------- allocation

def _alloc_inputs(spark: SparkSession, d: str, signed: bool) -> tuple[DataFrame, DataFrame]:
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    amt = dec2("o_totalprice") - F.lit(250000) if signed else dec2("o_totalprice")
    items = orders.select("o_orderkey", "o_custkey", "o_orderdate", amt.cast("decimal(18,2)").alias("amt"))
    # customers in debt have no total
    customer = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"], where=None if signed else F.col("c_acctbal") >= 0)
    bal = dec2("c_acctbal")
    totals = customer.select(F.col("c_custkey").alias("o_custkey"),
                             (bal * F.lit(500)).cast("decimal(18,2)").alias("total"))
    return items, totals


def _alloc(items: DataFrame, totals: DataFrame) -> DataFrame:
    out = waterfall(items, totals, "o_custkey", "amt", [F.desc("o_orderdate"), F.desc("o_orderkey")], "total",
                    with_position=True)
    return as_double(out.select("o_orderkey", "o_custkey", "allocated", "allocated_position",
                                "allocated_is_last"), "allocated")


def q_waterfall(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's total spread over its orders, newest first; the last order takes the rest."""
    return _alloc(*_alloc_inputs(spark, d, signed=False))


def q_cogroup_pair(spark: SparkSession, d: str) -> DataFrame:
    """Orders co-grouped with their customer's total in one range shuffle: per order the
    key's total, the sum of the newer orders, its position and whether it is the oldest."""
    items, totals = _alloc_inputs(spark, d, signed=False)
    out = cogroup_running(items, totals, "o_custkey", "amt", [F.desc("o_orderdate"), F.desc("o_orderkey")], "total")
    return as_double(out.select("o_orderkey", "o_custkey", "cg_total", "cg_before", "cg_position", "cg_is_last"),
                     "cg_total", "cg_before")


def q_waterfall_fold(spark: SparkSession, d: str) -> DataFrame:
    """The sequential rule with signed amounts and totals (negative amounts refill)."""
    return _alloc(*_alloc_inputs(spark, d, signed=True))


def _events_json(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "events-json")
    read_table(spark, d, "events").write.mode("overwrite").json(path)
    return path


EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def q_json_scan_sum(spark: SparkSession, d: str) -> DataFrame:
    """Events written as JSON lines and scanned back with a schema; sums per event type."""
    ev = read_json(spark, _events_json(spark, d), EVENTS_SCHEMA)
    k = json_map("props")["k"].cast("bigint")
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("sum_k"),
                                        F.sum(dec2("value")).cast("double").alias("sum_value"))


def q_waterfall_json(spark: SparkSession, d: str) -> DataFrame:
    """Allocation over JSON input: event amounts per user, events in descending text order."""
    ev = read_json(spark, _events_json(spark, d), EVENTS_SCHEMA)
    items = ev.select(F.col("user_id").cast("string").alias("user_id"),
                      F.col("event_id").cast("string").alias("event_id"),
                      json_map("props")["k"].cast("bigint").alias("amount"))
    totals = ev.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.floor(F.sum(dec2("value"))).cast("bigint").alias("total"))
    out = waterfall(items, totals, "user_id", "amount", [F.desc("event_id")], "total", out="allocated")
    return out.select("user_id", "event_id", "allocated")


def q_save_allocation(spark: SparkSession, d: str) -> DataFrame:
    """Settle, allocate over the settled frame, save both while they are kept, read the allocation back."""
    frames = formula_chain_frames(spark, d)
    orders = settle(frames, formula_chain_formulas()[:2])["orders"].select(
        "o_orderkey", "o_custkey", F.col("gap").cast("decimal(18,2)").alias("amt")).persist()
    totals = read_table(spark, d, "customer", ["c_custkey", "c_acctbal"]).select(
        F.col("c_custkey").alias("o_custkey"), (dec2("c_acctbal") * F.lit(100)).cast("decimal(18,2)").alias("total"))
    alloc = waterfall(orders, totals, "o_custkey", "amt", [F.desc("o_orderkey")], "total")
    path = scratch_path(spark, "save-allocation")
    save_changed({"orders": orders, "alloc": alloc}, ["orders", "alloc"], lambda name, df: save(df, f"{path}/{name}"))
    orders.unpersist()
    return as_double(spark.read.parquet(f"{path}/alloc"), "amt", "allocated")


def q_save_changed_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """All changed frames of the chain saved once, in order of last change, and the last one read back."""
    formulas = formula_chain_formulas()
    frames = settle(formula_chain_frames(spark, d), formulas)
    path = scratch_path(spark, "save-changed")
    done = save_changed(frames, changed_datasets(formulas), lambda name, df: save(df, f"{path}/{name}"))
    return as_double(spark.read.parquet(f"{path}/{done[-1]}"), "exposure")


def q_save_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A save in three parts that replaces an earlier one, dumped again by status, read back."""
    path = scratch_path(spark, "save-overwrite")
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    save(orders.select("o_orderkey"), f"{path}/a", partitions=2)
    save(orders, f"{path}/a", partitions=3)
    save(spark.read.parquet(f"{path}/a"), f"{path}/b", partition_by=["o_orderstatus"])
    return spark.read.parquet(f"{path}/b").select("o_orderkey", "o_custkey", F.col("o_orderstatus").cast("string").alias("o_orderstatus"))


# ------------------------------------------------------------------ loading

def q_scan_project(spark: SparkSession, d: str) -> DataFrame:
    """Scan with a column list and a pushed predicate, aliases and a constant column."""
    li = read_format(spark, "parquet", f"{d}/lineitem.parquet",
                     columns=["l_orderkey", "l_partkey", "l_quantity"], where="l_returnflag = 'A'")
    return li.selectExpr("l_orderkey AS id", "l_partkey", "l_quantity AS eng", "CAST(2.0 AS DOUBLE) AS const_eng")


def q_param_script(spark: SparkSession, d: str) -> DataFrame:
    """A data set script with bound parameters and a date range."""
    orders = read_table(spark, d, "orders")
    sql = ("SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} "
           "WHERE o_orderdate BETWEEN :start AND :end AND o_orderstatus = :status")
    return run_script(spark, sql, {"start": datetime.date(1995, 1, 1), "end": datetime.date(1996, 12, 31),
                                   "status": "F"}, orders=orders)


def q_normalise_types(spark: SparkSession, d: str) -> DataFrame:
    """Load rules: text number -> double, decimal -> double, date -> text, empty number -> 0.0, key id."""
    src = read_table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("cust_txt"), dec2("o_totalprice").alias("price_dec"),
        "o_orderdate", "o_orderstatus", F.lit(None).cast("double").alias("settled"))
    fields = [Field("o_orderkey", "order_id", STRING, is_key=True), Field("cust_txt", "cust_no", NUMBER),
              Field("price_dec", "price", NUMBER), Field("o_orderdate", "order_time", DATE),
              Field("o_orderstatus", "status", STRING), Field("settled", "settled", NUMBER)]
    return normalise(src, fields)


def q_normalise_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Load rules on nulls: empty numbers (as number, decimal or text) are 0.0, empty dates and texts stay null."""
    n = lambda c, v: F.nullif(F.col(c), F.lit(v))
    src = read_table(spark, d, "orders").select(
        "o_orderkey", F.nullif((F.col("o_orderkey") % 3).cast("string"), F.lit("0")).alias("num_txt"),
        F.when(F.col("o_orderstatus") != "F", dec2("o_totalprice")).alias("price_dec"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("day"), n("o_orderstatus", "P").alias("status"))
    fields = [Field("o_orderkey", "order_id", STRING, is_key=True), Field("num_txt", "num", NUMBER),
              Field("price_dec", "price", NUMBER), Field("day", "day", DATE), Field("status", "status", STRING)]
    return normalise(src, fields, row_id=None)


def _stored_customers(spark: SparkSession, d: str) -> DataFrame:
    """The stored rows: customers with an order (the others are new)."""
    return read_table(spark, d, "customer").join(
        read_table(spark, d, "orders", ["o_custkey"]), F.col("c_custkey") == F.col("o_custkey"), "left_semi")


def q_attach_old_id(spark: SparkSession, d: str) -> DataFrame:
    """Source rows get the stored row's key (null = new) by a left join on the natural key."""
    src = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    stored = _stored_customers(spark, d).select(
        F.col("c_custkey").alias("cust_no"), F.col("c_nationkey").alias("nation"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("row_key"))
    return attach_old_id(src, stored, {"c_custkey": "cust_no", "c_nationkey": "nation"}, "row_key", out="old_id")


def q_dup_keys(spark: SparkSession, d: str) -> DataFrame:
    """Key groups with more than one row."""
    return duplicate_keys(read_table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_in_list_join(spark: SparkSession, d: str) -> DataFrame:
    """Rows joined with their definitions, restricted to a name list: customers of the
    nations whose region is in the list."""
    nation = read_table(spark, d, "nation")
    region = read_table(spark, d, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    defs = nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select("n_nationkey", "n_name", "r_name")
    customer = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    return customer.join(defs, customer.c_nationkey == defs.n_nationkey, "inner").select(
        "c_custkey", "n_name", "r_name")


def q_nested_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Left join onto an inner join of two filtered tables, aggregated per key."""
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"],
                       where=F.col("l_returnflag") == "R")
    per_cust = (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "inner")
                .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")))
    customer = read_table(spark, d, "customer", ["c_custkey"])
    j = customer.join(per_cust, customer.c_custkey == per_cust.o_custkey, "left")
    return j.select("c_custkey", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                    F.coalesce("qty", F.lit(0.0)).alias("qty"))


# --------------------------------------------------------------------- demos

def q_three_way_join(spark: SparkSession, d: str) -> DataFrame:
    """Three scans joined in SQL; Catalyst/AQE choose the join order and strategy."""
    return spark.sql(
        "SELECT l.l_orderkey, l.l_linenumber, c.c_name, o.o_orderstatus, l.l_extendedprice "
        "FROM {li} l JOIN {o} o ON l.l_orderkey = o.o_orderkey JOIN {c} c ON o.o_custkey = c.c_custkey",
        li=read_table(spark, d, "lineitem"), o=read_table(spark, d, "orders"), c=read_table(spark, d, "customer"))


def q_distinct_expr(spark: SparkSession, d: str) -> DataFrame:
    """Distinct keys from an expression, then generated rows with a schema."""
    fam = read_table(spark, d, "part", ["p_name"]).select(before_last("p_name", " ").alias("family")).distinct()
    return fam.select("family", F.concat("family", F.lit("_G")).alias("guid"), F.lit(0).cast("bigint").alias("eng"))


def q_first_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Earliest event per user (fixed order: time, then id)."""
    ev = read_table(spark, d, "events", ["user_id", "ts", "event_id", "event_type", "value"])
    return first_per_key(ev, ["user_id"], ["ts", "event_id"], ["event_type", "value"])


def q_text_scan(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as '|'-separated text lines and scanned back as text; count and sum per status."""
    path = scratch_path(spark, "orders-text")
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
    orders.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus",
                              dec2("o_totalprice").cast("string")).alias("value")).write.text(path)
    parts = F.split(F.col("value"), r"\|")
    lines = read_text(spark, path).select(parts[1].alias("status"), parts[2].cast("decimal(18,2)").alias("price"))
    return lines.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("total"))


def q_json_map(spark: SparkSession, d: str) -> DataFrame:
    """JSON object text -> map -> value."""
    ev = read_table(spark, d, "events", ["event_id", "props"])
    return ev.select("event_id", json_map("props")["k"].cast("bigint").alias("k"))


def q_string_fns(spark: SparkSession, d: str) -> DataFrame:
    part = read_table(spark, d, "part", ["p_partkey", "p_name", "p_brand"])
    return part.select(
        "p_partkey", before_last("p_name", " ").alias("family"),
        F.concat("p_brand", F.lit("1")).alias("brand1"),
        before_last(F.concat_ws("_", "p_brand", F.col("p_partkey").cast("string")), "_").alias("brand_back"))


def q_date_fns(spark: SparkSession, d: str) -> DataFrame:
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    t = orders.select("o_orderkey", "o_orderdate", ts_to_text("o_orderdate").alias("ts_text"),
                      F.date_format("o_orderdate", "yyyyMM").alias("ym"),
                      F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("sec_text"))
    return t.select(
        "o_orderkey", "ts_text", "ym",
        (text_to_ts("ts_text") == F.col("o_orderdate")).alias("roundtrip"),
        F.datediff(F.to_date(text_to_ts("ym", "yyyyMM")), F.lit(datetime.date(1970, 1, 1))).alias("month_days"),
        (text_to_ts("sec_text", "yyyy-MM-dd HH:mm:ss") == F.col("o_orderdate")).alias("sec_roundtrip"))


def q_hash_bucket(spark: SparkSession, d: str) -> DataFrame:
    """Spark's hash deals every order key into one of 50 buckets: all rows, all buckets in range."""
    orders = read_table(spark, d, "orders", ["o_orderkey"])
    per = orders.groupBy(hash_bucket(["o_orderkey"], 50).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.bool_and((F.col("bucket") >= 0) & (F.col("bucket") < 50)).alias("in_range"))


def q_hash_bucket_portable(spark: SparkSession, d: str) -> DataFrame:
    """Rows per MD5-based bucket of the order key (the same buckets in any engine)."""
    orders = read_table(spark, d, "orders", ["o_orderkey"])
    return orders.groupBy(text_bucket(["o_orderkey"], 50).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def q_udf_scalar(spark: SparkSession, d: str) -> DataFrame:
    """A vectorised pandas UDF (a checksum that Spark has no function for)."""
    return read_table(spark, d, "part", ["p_partkey", "p_name"]).select("p_partkey", adler32("p_name").alias("checksum"))


def q_udaf_group(spark: SparkSession, d: str) -> DataFrame:
    """A user aggregate without a built-in form (geometric mean) per order, merged from partial states."""
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity"])
    out = group_reduce(li, ["l_orderkey"], "l_quantity", GEOMETRIC_MEAN, "qty_mean")
    return out.select("l_orderkey", F.round("qty_mean", 6).alias("qty_mean"))


# --------------------------------------------------------------------- sinks

CUSTOMER_TARGET = {"c_custkey": "cust_id", "c_name": "name", "c_acctbal": "balance"}


def _changes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    changed = _filtered_customers(spark, d)
    stored = _stored_customers(spark, d).select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("name"),
        dec2("c_acctbal").alias("balance"))
    return stored, attach_old_id(changed, stored, {"c_custkey": "cust_id"}, "cust_id")


def q_upsert_split(spark: SparkSession, d: str) -> DataFrame:
    """Changed rows tagged as inserts (no stored id) or updates (by stored key), in one pass."""
    _, with_id = _changes(spark, d)
    return as_double(tag_changes(with_id, CUSTOMER_TARGET, pk="cust_id"), "balance")


def q_upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    """The stored table after the inserts and updates (one full outer join on the key)."""
    stored, with_id = _changes(spark, d)
    return as_double(merge_changes(stored, with_id, CUSTOMER_TARGET, pk="cust_id"), "balance")


def q_upsert_dates(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose date travelled as text merged into the stored orders (status F), with one new column value."""
    src = normalise(read_table(spark, d, "orders"), [
        Field("o_orderkey", "order_no", STRING, is_key=True), Field("o_orderdate", "order_time", DATE),
        Field("o_totalprice", "price", NUMBER)], row_id=None)
    stored = read_table(spark, d, "orders", where=F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderkey").cast("string").alias("order_no"), F.lit(None).cast("timestamp_ntz").alias("day"),
        F.lit(0.0).alias("price"), F.col("o_custkey"))
    changed = attach_old_id(src, stored, ["order_no"], "id")
    mapping = {"order_no": "order_no", "order_time": "day", "price": "price"}
    return merge_changes(stored, changed, mapping, pk="id", dates=["order_time"])


def q_ordered_topk(spark: SparkSession, d: str) -> DataFrame:
    """Top 10 line items by price (a fixed tie-break makes the cut repeatable)."""
    li = read_table(spark, d, "lineitem")
    return (li.orderBy(F.desc("l_extendedprice"), "l_orderkey", *LINE_ORDER)
            .limit(10).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"))


QUERIES: dict[str, Query] = {
    "sum_of": q_sum_of,
    "sum_of_filtered": q_sum_of_filtered,
    "avg_of": q_avg_of,
    "lookup_one": q_lookup_one,
    "lookup_multi_key": q_lookup_multi_key,
    "sum_global": q_sum_global,
    "avg_global": q_avg_global,
    "lookup_global": q_lookup_global,
    "lookup_filtered_dup": q_lookup_filtered_dup,
    "filter_fractional": q_filter_fractional,
    "list_of": q_list_of,
    "list_fn": q_list_fn,
    "list_as_objects": q_list_as_objects,
    "self_chain": q_self_chain,
    "multi_input": q_multi_input,
    "formula_chain": q_formula_chain,
    "formula_chain_checkpointed": q_formula_chain_checkpointed,
    "formula_filter": q_formula_filter,
    "constant_formula": q_constant_formula,
    "waterfall": q_waterfall,
    "waterfall_fold": q_waterfall_fold,
    "cogroup_pair": q_cogroup_pair,
    "json_scan_sum": q_json_scan_sum,
    "waterfall_json": q_waterfall_json,
    "scan_project": q_scan_project,
    "param_script": q_param_script,
    "normalise_types": q_normalise_types,
    "normalise_nulls": q_normalise_nulls,
    "attach_old_id": q_attach_old_id,
    "dup_keys": q_dup_keys,
    "in_list_join": q_in_list_join,
    "nested_left_join": q_nested_left_join,
    "three_way_join": q_three_way_join,
    "distinct_expr": q_distinct_expr,
    "first_per_key": q_first_per_key,
    "json_map": q_json_map,
    "text_scan": q_text_scan,
    "string_fns": q_string_fns,
    "date_fns": q_date_fns,
    "hash_bucket": q_hash_bucket,
    "hash_bucket_portable": q_hash_bucket_portable,
    "udf_scalar": q_udf_scalar,
    "udaf_group": q_udaf_group,
    "upsert_split": q_upsert_split,
    "upsert_merge": q_upsert_merge,
    "upsert_dates": q_upsert_dates,
    "save_allocation": q_save_allocation,
    "save_changed_roundtrip": q_save_changed_roundtrip,
    "save_overwrite": q_save_overwrite,
    "ordered_topk": q_ordered_topk,
}
