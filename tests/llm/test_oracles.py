import duckdb
import pytest

from apportion.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = con.sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, rows))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_returns_its_contract(spark, name):
    """The columns that the query must have, and rows for the whole table."""
    columns = {
        "op3": "doc_id chunk n_pieces score ids_crc32 n_bytes text_crc32",
        "op4": "query_id rank vec_id score",
        "op5": "doc_id held_out score predicted",
        "op6": "doc_id size text_crc32 law shard slot grown_shard",
        "op9": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        "op10": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op13": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        "op12": "vec_id component n deviation whitened explained identity_error",
    }[name.split("_")[0]].split()
    df = QUERIES[name](spark, SF)
    assert df.columns[: len(columns)] == columns
    if columns[0] == "doc_id":
        assert df.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
