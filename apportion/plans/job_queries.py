"""Registered queries of whole jobs and stored tables, with their DuckDB SQL (see :mod:`apportion.plans.queries`)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.operators.formula import add_result_columns, settle
from apportion.operators.pages import paged_list
from apportion.operators.quantiles import keyed_quantiles
from apportion.operators.running import running_balance
from apportion.plans.catalog import run_catalog
from apportion.plans.formula_text import formula_from_text
from apportion.plans.oracle import ORACLE_SQL as _CORE_SQL
from apportion.plans.queries import LINE_ORDER, as_double, dec2, formula_chain_formulas, formula_chain_frames, with_dec
from apportion.sinks.stored_table import create_stored, read_stored, save_changes
from apportion.sinks.together import read_saved, save_together
from apportion.sources.bucketed import save_bucketed
from apportion.sources.load import attach_old_id
from apportion.sources.readers import read_table, scratch_path
from apportion.sources.semi import variant_field, with_variant
from apportion.specs import Formula, Item, list_of, sum_of

# ------------------------------------------------------------------ formulas as text

#: The flagship chain as text: (formula, data set, filter, [(field, text)]).
CHAIN_TEXT = [
    ("line_net", "lineitem", None, [
        ("net", "return #dataset[value(lineitem.l_extendedprice)] * (1 - #dataset[value(lineitem.l_discount)]);")]),
    ("order_gap", "orders", {"o_orderstatus": "F"}, [
        ("billed", "return $.sum(#dataset[value(lineitem.net), where(o_orderkey=l_orderkey)]);"),
        ("gap", "var price = #dataset[value(orders.o_totalprice)]; return price - #dataset[value(orders.billed)];")]),
    ("customer_exposure", "customer", None, [
        ("exposure", "return $.sum(#dataset[value(orders.gap), where(c_custkey=o_custkey)]);"),
        ("avg_gap", "return $.average(#dataset[value(orders.gap), where(c_custkey=o_custkey)]);")]),
]


def q_formula_text(spark: SparkSession, d: str) -> DataFrame:
    """The flagship chain written as formula text alone."""
    frames = formula_chain_frames(spark, d)
    frames["orders"] = with_dec(frames["orders"], "o_totalprice")
    formulas = [formula_from_text(name, dataset, items, filter=flt) for name, dataset, flt, items in CHAIN_TEXT]
    return as_double(settle(frames, formulas)["customer"], "exposure")


def q_formula_text_rules(spark: SparkSession, d: str) -> DataFrame:
    """Script rules in text: null counts as 0, division by zero, conditions, text comparison, list functions, no value."""
    orders = add_result_columns(with_dec(read_table(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"]), "o_totalprice"),
                                {"share": "double", "grade": "double", "kept": "double"})
    lineitem = read_table(spark, d, "lineitem", ["l_orderkey", "l_quantity", "l_returnflag"])
    returned = "#dataset[value(lineitem.l_quantity), where(o_orderkey=l_orderkey), filter(l_returnflag=R)]"
    every = "#dataset[value(lineitem.l_quantity), where(o_orderkey=l_orderkey)]"
    formula = formula_from_text("rules", "orders", [
        ("share", f"return $.sum({returned}) / $.sum({every});"),  # 0 / 0 without lines
        ("grade", f"""
            var n = $.count({every});
            if (#dataset[value(orders.o_orderstatus)] == 'F' && n > 3) return Math.max(n, $.max({every})) + 0.5;
            else if (n == null) {{ return -1; }}
            return n % 3 == 0 ? n / 3 : 100 * n;"""),
        ("kept", f"if ($.sum({returned}) > 20) return 7;"),  # else no value: 0 stays
    ])
    out = settle({"orders": orders, "lineitem": lineitem}, [formula])["orders"]
    # NaN as null: engines order and print it differently
    return out.select("o_orderkey", F.nanvl("share", F.lit(None).cast("double")).alias("share"), "grade", "kept")


def shared_chain(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], list[Formula]]:
    """Six formulas: formulas of one target take from one data set by one match, with others between them."""
    frames = formula_chain_frames(spark, d)
    frames["orders"] = add_result_columns(frames["orders"].drop("gap"), {"top": "decimal(24,4)"})
    frames["customer"] = add_result_columns(frames["customer"].drop("avg_gap"), {"n": "double", "tops": "decimal(28,4)"})
    lines, orders = {"o_orderkey": "l_orderkey"}, {"c_custkey": "o_custkey"}
    return frames, [
        formula_chain_formulas()[0],
        Formula.of("billed", "orders", [Item("billed", "$b", (sum_of("b", "lineitem", "net", on=lines),))], filter={"o_orderstatus": "F"}),
        Formula.of("orders_of", "customer", [Item("n", "$n", (list_of("n", "orders", "o_orderkey", on=orders, fn="count"),))]),
        Formula.of("top_line", "orders", [Item("top", "$t", (list_of("t", "lineitem", "net", on=lines, fn="max"),))], filter={"o_orderstatus": "O"}),
        # unchanged since the count: its join serves both
        Formula.of("exposure", "customer", [Item("exposure", "$e", (sum_of("e", "orders", "billed", on=orders),))]),
        # written since the count: joined anew
        Formula.of("tops", "customer", [Item("tops", "$t", (sum_of("t", "orders", "top", on=orders),))]),
    ]


def q_shared_chain(spark: SparkSession, d: str) -> DataFrame:
    """A chain whose formulas share joins across formulas until a column that they read is written."""
    frames, formulas = shared_chain(spark, d)
    return as_double(settle(frames, formulas)["customer"], "exposure", "tops")


# ---------------------------------------------------------------- a job from catalog tables

def settlement_catalog(spark: SparkSession) -> dict[str, DataFrame]:
    """The flagship chain as catalog rows, amid rows that must stay out: deleted, of another market, of other versions."""
    line = "SELECT l_orderkey, CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents, CAST(ROUND(l_discount * 100) AS BIGINT) AS pct FROM {lineitem}"
    order = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(ROUND(o_totalprice * 100) AS BIGINT) * 100 AS price FROM {orders} WHERE o_orderkey >= ${least}"
    rows = {
        "data_sets": ("id string, name string, market string, deleted int", [
            ("line", "lines", "north", 0), ("order", "orders", "north", 0), ("customer", "customers", "north", 0),
            ("gone", "removed", "north", 1), ("far", "foreign", "south", 0)]),
        "scripts": ("dataset_id string, version string, sql string", [
            ("line", "1", line), ("line", "0", "SELECT 1 AS l_orderkey"), ("order", "1", order), ("customer", "1", "SELECT c_custkey FROM {customer}"),
            ("gone", "1", "SELECT nothing"), ("far", "1", "SELECT nothing")]),
        "fields": ("dataset_id string, origin string, name string, type int, is_key int", [
            ("line", "l_orderkey", "orderkey", 1, None), ("line", "cents", "cents", 2, 0), ("line", "pct", "pct", 2, 0), ("line", "net", "net", 2, 0),
            ("order", "o_orderkey", "orderkey", 1, 1), ("order", "o_custkey", "custkey", 1, 0), ("order", "o_orderstatus", "status", 1, 0),
            ("order", "price", "price", 2, 0), ("order", "billed", "billed", 2, 0), ("order", "gap", "gap", 2, 0),
            ("customer", "c_custkey", "custkey", 1, 1), ("customer", "exposure", "exposure", 2, 0), ("customer", "avg_gap", "avg_gap", 2, 0),
            ("far", "x", "x", 1, 0)]),
        "results": ("id string, dataset_id string, version string, table_name string, primary_key string", [
            ("r1", "customer", "1", "SETTLED", "ID"), ("r2", "customer", "2", "OLD", "ID")]),
        "mappings": ("result_id string, field string, column_name string", [
            ("r1", "custkey", "CUSTOMER_NO"), ("r1", "exposure", "EXPOSURE"), ("r2", "exposure", "OTHER")]),
        "formulas": ("id string, name string, dataset_id string, filter string, market string, deleted int, position int", [
            ("f3", "exposure", "customer", None, "north", 0, 30), ("f1", "net", "line", "", "north", 0, 10),
            ("f2", "gap", "order", '{"status": "F"}', "north", 0, 20), ("f4", "removed", "customer", None, "north", 1, 40),
            ("f5", "foreign", "customer", None, "south", 0, 50), ("f6", "not asked for", "customer", None, "north", 0, 60)]),
        "items": ("id string, formula_id string, field string, content string, position int", [
            ("i3", "f2", "gap", "return #dataset[value(order.price)] - #dataset[value(order.billed)];", 2),
            ("i2", "f2", "billed", "return $.sum(#dataset[value(line.net), where(orderkey)]);", 1),
            ("i1", "f1", "net", "return #dataset[value(line.cents)] * (100 - #dataset[value(line.pct)]);", 1),
            ("i4", "f3", "exposure", "return $.sum(#dataset[value(order.gap), where(custkey)]) / 10000;", 1),
            ("i5", "f3", "avg_gap", "return $.average(#dataset[value(order.gap), where(custkey)]) / 10000;", 2),
            ("i6", "f4", "exposure", "return 1;", 1), ("i7", "f5", "exposure", "return 2;", 1), ("i8", "f6", "exposure", "return 3;", 1)]),
    }
    return {name: spark.createDataFrame(values, schema) for name, (schema, values) in rows.items()}


def q_catalog_job(spark: SparkSession, d: str) -> DataFrame:
    """The flagship chain compiled from catalog tables (whole units of a ten-thousandth: sums of doubles are exact)."""
    tables = {t: read_table(spark, d, t) for t in ("lineitem", "orders", "customer")}
    asked = ["f3", "f2", "f1", "f4", "f5"]
    result, _ = run_catalog(spark, settlement_catalog(spark), "north", asked, "1", "1", {"least": 0}, tables)
    customer = result.frames["customer"]
    return customer.select(F.col("custkey").cast("bigint").alias("c_custkey"), "exposure", F.round("avg_gap", 8).alias("avg_gap"))


# ------------------------------------------------------------------- running rules

def _running(spark: SparkSession, d: str, key: str) -> DataFrame:
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    items = orders.select("o_orderkey", F.expr(key).alias("k"), "o_orderdate",
                          (F.lit(150000) - F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("change"))
    done = running_balance(items, "k", ["o_orderdate", "o_orderkey"], "change", floor=0, cap=400000)
    return as_double(done.select("o_orderkey", "k", "balance"), "balance")


def q_running_balance(spark: SparkSession, d: str) -> DataFrame:
    """A customer's allowance: 150,000 an order less its price, carried over between 0 and 400,000."""
    return _running(spark, d, "o_custkey")


def q_running_balance_hot(spark: SparkSession, d: str) -> DataFrame:
    """The same rule over five books, each of which lies in many ranges."""
    return _running(spark, d, "o_custkey % 5")


def q_list_quantile(spark: SparkSession, d: str) -> DataFrame:
    """Exact quantiles of the line prices of each return flag (one holds half of all rows)."""
    lineitem = read_table(spark, d, "lineitem", ["l_returnflag", "l_extendedprice"])
    shares = {"q10": "0.1", "q25": "0.25", "median": "0.5", "q90": "0.9", "q999": "0.999"}
    return keyed_quantiles(lineitem, "l_returnflag", "l_extendedprice", shares)


def q_list_pages(spark: SparkSession, d: str) -> DataFrame:
    """The order keys of each return flag's lines, in order, as text in pages of 500."""
    lineitem = read_table(spark, d, "lineitem", ["l_returnflag", "l_orderkey", *LINE_ORDER])
    return paged_list(lineitem, "l_returnflag", ["l_orderkey", *LINE_ORDER], ["l_orderkey"], 500, form="text")


# ---------------------------------------------------------------------- sources

def q_attach_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Stored ids for all line items' orders from a stored table bucketed by the natural key: only the line items move."""
    stored = read_table(spark, d, "orders", where="o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("order_no"), F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("id"))
    name = f"stored_orders_{uuid.uuid4().hex}"
    bucketed = save_bucketed(stored, name, ["order_no"], 8, scratch_path(spark, "bucketed"))
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    return attach_old_id(lines, bucketed, {"l_orderkey": "order_no"}, "id")


def q_variant_props(spark: SparkSession, d: str) -> DataFrame:
    """Event properties read without a schema, per event type; texts cut short (every seventeenth) are counted apart."""
    events = read_table(spark, d, "events", ["event_id", "event_type", "props"])
    cut = F.when(F.col("event_id") % 17 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    read = with_variant(events.withColumn("props", cut), "props")
    k = variant_field("variant", "$.k", "bigint")
    return read.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("malformed").alias("n_malformed"), F.sum(k).alias("sum_k"), F.max(k).alias("max_k"))


# ------------------------------------------------------------------- stored tables

def q_rewrite_changed(spark: SparkSession, d: str) -> DataFrame:
    """Nine tenths of the orders stored in 64 folders; some customers' orders change, orders not yet stored are inserted."""
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    path = scratch_path(spark, "orders-stored")
    rows = orders.select(F.col("o_orderkey").alias("id"), dec2("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    create_stored(rows.where("id % 10 <> 0"), path, "id", 64)
    changes = orders.where("o_custkey % 97 = 5 OR o_orderkey % 10 = 0").select("o_orderkey", (dec2("o_totalprice") + 1).alias("price"))
    changed = attach_old_id(changes, read_stored(spark, path), {"o_orderkey": "id"}, "id")
    save_changes(changed, path, {"o_orderkey": "id", "price": "price"}, "id", 64)
    return as_double(read_stored(spark, path), "price")


def q_save_together(spark: SparkSession, d: str) -> DataFrame:
    """Orders and customers of the flagship chain saved as one version over an earlier one, and read back."""
    root = scratch_path(spark, "together")
    frames = formula_chain_frames(spark, d)
    save_together({n: frames[n] for n in ("orders", "customer")}, root, "before")
    settled = settle({n: read_saved(spark, root, n) if n != "lineitem" else frames[n] for n in frames}, formula_chain_formulas())
    for _ in range(2):  # the second run of the job changes nothing
        save_together({n: settled[n] for n in ("orders", "customer")}, root, "after")
    order = read_saved(spark, root, "orders").select(F.lit("orders").alias("saved"), F.col("o_orderkey").alias("id"), F.col("gap").alias("value"))
    customer = read_saved(spark, root, "customer").select(F.lit("customer").alias("saved"), F.col("c_custkey").alias("id"), F.col("exposure").alias("value"))
    return as_double(order.unionByName(customer), "value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "formula_text": q_formula_text,
    "formula_text_rules": q_formula_text_rules,
    "catalog_job": q_catalog_job,
    "list_quantile": q_list_quantile,
    "list_pages": q_list_pages,
    "attach_bucketed": q_attach_bucketed,
    "variant_props": q_variant_props,
    "rewrite_changed": q_rewrite_changed,
    "save_together": q_save_together,
    "running_balance": q_running_balance,
    "running_balance_hot": q_running_balance_hot,
    "shared_chain": q_shared_chain,
}



def _running_sql(key: str) -> str:
    return f"""
        WITH RECURSIVE n AS (
            SELECT o_orderkey, {key} AS k, 15000000 - CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
                   row_number() OVER (PARTITION BY {key} ORDER BY o_orderdate, o_orderkey) AS i FROM orders
        ), r AS (
            SELECT o_orderkey, k, i, least(greatest(cents, 0), 40000000) AS b FROM n WHERE i = 1
            UNION ALL
            SELECT n.o_orderkey, n.k, n.i, least(greatest(r.b + n.cents, 0), 40000000) FROM r JOIN n ON n.k = r.k AND n.i = r.i + 1
        )
        SELECT o_orderkey, k, b / 100 AS balance FROM r"""


ORACLE_SQL: dict[str, str] = {
    "list_pages": f"""
        WITH n AS (
            SELECT l_returnflag, l_orderkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, {', '.join(LINE_ORDER)}) - 1 AS i FROM lineitem
        )
        SELECT l_returnflag, i // 500 AS page, count(*) AS n, string_agg(CAST(l_orderkey AS VARCHAR), ',' ORDER BY i) AS items
        FROM n GROUP BY l_returnflag, i // 500""",
    "attach_bucketed": """
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderkey IS NOT NULL THEN 'S' || o_orderkey END AS OLD_ID
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'""",
    "variant_props": """
        WITH e AS (
            SELECT event_type, TRY_CAST(CASE WHEN event_id % 17 = 0 THEN left(props, length(props) - 1) ELSE props END AS JSON) AS j FROM events
        )
        SELECT event_type, count(*) AS n, count(*) FILTER (j IS NULL) AS n_malformed,
               CAST(sum(CAST(j->>'$.k' AS BIGINT)) AS BIGINT) AS sum_k, max(CAST(j->>'$.k' AS BIGINT)) AS max_k
        FROM e GROUP BY event_type""",
    "rewrite_changed": """
        SELECT o_orderkey AS id, CAST(CASE WHEN o_custkey % 97 = 5 OR o_orderkey % 10 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1
                                           ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS price,
               CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS status
        FROM orders""",
    "save_together": """
        WITH b AS (
            SELECT l_orderkey, SUM(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(20,4))) AS billed
            FROM lineitem GROUP BY l_orderkey
        ), o AS (
            SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F'
                   THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) - COALESCE(billed, 0) AS DECIMAL(24,4)) ELSE 0 END AS gap
            FROM orders LEFT JOIN b ON o_orderkey = l_orderkey
        )
        SELECT 'orders' AS saved, o_orderkey AS id, CAST(gap AS DOUBLE) AS value FROM o
        UNION ALL
        SELECT 'customer', c_custkey, CAST(COALESCE(SUM(gap), 0) AS DOUBLE) FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_custkey""",
    "list_quantile": """
        SELECT l_returnflag, count(*) AS n, quantile_disc(l_extendedprice, 0.1) AS q10, quantile_disc(l_extendedprice, 0.25) AS q25,
               quantile_disc(l_extendedprice, 0.5) AS median, quantile_disc(l_extendedprice, 0.9) AS q90,
               quantile_disc(l_extendedprice, 0.999) AS q999
        FROM lineitem GROUP BY l_returnflag""",
    "shared_chain": """
        WITH l AS (
            SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(20,4)) AS net FROM lineitem
        ), o AS (
            SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN coalesce(sum(net), 0) ELSE 0 END AS billed,
                   CASE WHEN o_orderstatus = 'O' THEN coalesce(max(net), 0) ELSE 0 END AS top
            FROM orders LEFT JOIN l ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_custkey, o_orderstatus
        )
        SELECT c_custkey, CAST(coalesce(sum(billed), 0) AS DOUBLE) AS exposure, CAST(count(o_orderkey) AS DOUBLE) AS n,
               CAST(coalesce(sum(top), 0) AS DOUBLE) AS tops
        FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_custkey""",
    "running_balance": _running_sql("o_custkey"),
    "running_balance_hot": _running_sql("o_custkey % 5"),
    "formula_text": _CORE_SQL["formula_chain"],
    "catalog_job": _CORE_SQL["formula_chain"],
    "formula_text_rules": """
        WITH l AS (
            SELECT l_orderkey, sum(l_quantity) AS total, sum(l_quantity) FILTER (l_returnflag = 'R') AS returned,
                   count(*) AS n, max(l_quantity) AS most FROM lineitem GROUP BY l_orderkey
        )
        SELECT o_orderkey, CASE WHEN total <> 0 THEN coalesce(returned, 0) / total END AS share,
               CAST(CASE WHEN o_orderstatus = 'F' AND coalesce(n, 0) > 3 THEN greatest(n, most) + 0.5
                         WHEN n IS NULL THEN -1 WHEN n % 3 = 0 THEN n / 3 ELSE 100 * n END AS DOUBLE) AS grade,
               CAST(CASE WHEN returned > 20 THEN 7 ELSE 0 END AS DOUBLE) AS kept
        FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""",
}
