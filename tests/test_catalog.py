import pytest

from apportion.plans.catalog import read_data_sets, read_formulas, run_catalog, script_text, used_data_sets
from apportion.plans.job import save
from apportion.plans.job_queries import settlement_catalog
from apportion.sources.load import NUMBER, STRING, Field

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def catalog(spark):
    return settlement_catalog(spark)


def test_formulas_in_order_without_deleted_and_foreign_rows(catalog):
    found = read_formulas(catalog, "north", ["f3", "f2", "f1", "f4", "f5", "unknown"])
    assert [f.name for f in found] == ["net", "gap", "exposure"]
    assert [i.field for i in found[1].items] == ["billed", "gap"] and found[1].filter == (("status", "F"),)
    assert [f.name for f in read_formulas(catalog, "south", ["f1", "f5"])] == ["foreign"]
    assert read_formulas(catalog, "north", []) == []
    assert used_data_sets(found) == ["line", "order", "customer"]


def test_data_sets_with_script_version_and_target(catalog):
    line, customer = read_data_sets(catalog, "north", ["line", "customer"], "1", "1")
    assert "lineitem" in line.sql and line.target is None
    assert set(line.fields) == {Field("l_orderkey", "orderkey", STRING), Field("cents", "cents", NUMBER), Field("pct", "pct", NUMBER), Field("net", "net", NUMBER)}
    assert customer.target.table == "SETTLED" and customer.target.columns == {"custkey": "CUSTOMER_NO", "exposure": "EXPOSURE"}
    assert read_data_sets(catalog, "north", ["line"], "0", "1")[0].sql == "SELECT 1 AS l_orderkey"
    for ids, market in ((["gone"], "north"), (["far"], "north"), (["line"], "south"), (["nothing"], "north")):
        with pytest.raises(ValueError, match="not in the catalog"):
            read_data_sets(catalog, market, ids, "1", "1")
    with pytest.raises(ValueError, match="key fields"):  # version 2 stores no key
        read_data_sets(catalog, "north", ["customer"], "1", "2")


def test_script_parameters():
    assert script_text("SELECT ${a}, #{ b } FROM {t} WHERE x = ${ c }") == "SELECT :a, {b} FROM {t} WHERE x = :c"


def test_bad_filter_and_formula_without_items(spark, catalog):
    rows = [("g1", "bad", "line", "[1]", "north", 0, 1), ("g2", "empty", "line", "{}", "north", 0, 2)]
    own = {**catalog, "formulas": spark.createDataFrame(rows, catalog["formulas"].schema)}
    with pytest.raises(Exception, match="no JSON object"):
        read_formulas(own, "north", ["g1"])
    found = read_formulas(own, "north", ["g2"])
    assert found[0].items == () and found[0].filter == ()


def test_job_saves_inserts_and_updates(spark, catalog):
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders", "customer")}
    stored = spark.createDataFrame([(77, "1"), (78, "2")], "ID long, CUSTOMER_NO string")
    asked = ["f1", "f2", "f3"]
    result, datasets = run_catalog(spark, catalog, "north", asked, "1", "1", {"least": 0}, tables, read_stored=lambda table: stored)
    written = {}
    save(result, datasets, lambda target, inserts, updates: written.update({target.table: (inserts.collect(), updates.collect())}))
    inserts, updates = written["SETTLED"]
    assert sorted(r.ID for r in updates) == [77, 78] and len(inserts) == tables["customer"].count() - 2
    assert set(inserts[0].asDict()) == {"CUSTOMER_NO", "EXPOSURE"}


def test_parameter_is_bound_and_needed(spark, catalog):
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("lineitem", "orders", "customer")}
    few, _ = run_catalog(spark, catalog, "north", ["f2"], "1", "1", {"least": 1000}, tables)
    assert few.frames["order"].count() == tables["orders"].where("o_orderkey >= 1000").count()
    with pytest.raises(Exception, match="least|UNBOUND"):
        run_catalog(spark, catalog, "north", ["f2"], "1", "1", {}, tables)
