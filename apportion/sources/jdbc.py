"""JDBC sources: a SQL text as one scan, or split into parallel scans.

Splitting needs no driver-side reading: either numeric bounds
(``partitionColumn``) or one hash predicate per partition, each evaluated by
the database. Predicates given to the resulting DataFrame are pushed into
the database query by Spark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Hash-predicate templates per database dialect; {col}, {n}, {i} are filled in.
HASH_PREDICATES = {
    "oracle": "MOD(ORA_HASH({col}, 10000), {n}) = {i}",
    "postgres": "MOD(ABS(CAST(HASHTEXT(CAST({col} AS TEXT)) AS BIGINT)), {n}) = {i}",
    "mysql": "MOD(CRC32({col}), {n}) = {i}",
    "derby": "MOD(MOD({col}, {n}) + {n}, {n}) = {i}",
}


def hash_predicates(column: str, n: int, dialect: str = "oracle") -> list[str]:
    """``n`` disjoint predicates that cover all rows (the first one also takes the null values)."""
    if n < 1 or dialect == "oracle" and n > 9999:  # that dialect hashes into 10,001 values
        raise ValueError("n must be in 1..9999" if dialect == "oracle" else "n must be positive")
    tpl = HASH_PREDICATES[dialect]
    first = f"({tpl.format(col=column, n=n, i=0)} OR {column} IS NULL)"
    return [first] + [tpl.format(col=column, n=n, i=i) for i in range(1, n)]


def read_query(spark: SparkSession, url: str, query: str, props: Mapping[str, str] | None = None) -> DataFrame:
    """One data set script as a JDBC scan."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**(props or {})).load()


def read_split(spark: SparkSession, url: str, table: str, predicates: list[str],
               props: Mapping[str, str] | None = None) -> DataFrame:
    """One partition per predicate (``table`` may be ``(subquery) alias``)."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(props or {}))


def read_range(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
               n: int, props: Mapping[str, str] | None = None) -> DataFrame:
    """Numeric-key split: ``n`` strides of ``column`` between ``lower`` and ``upper``."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=n, properties=dict(props or {}))
