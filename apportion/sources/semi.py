"""Semi-structured texts without a schema: JSON as variants, malformed rows kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, column: str, out: str = "variant", malformed: str = "malformed") -> DataFrame:
    """``df`` with the JSON text of ``column`` as a variant and whether it is malformed (null text: null, not malformed)."""
    parsed = F.try_parse_json(F.col(column))
    return df.withColumn(out, parsed).withColumn(malformed, F.col(column).isNotNull() & F.col(out).isNull())


def split_malformed(df: DataFrame, column: str, out: str = "variant") -> tuple[DataFrame, DataFrame]:
    """(rows with ``out``, rows of ``df`` whose text is malformed); both lazy."""
    both = with_variant(df, column, out, "__malformed")
    return both.where(~F.col("__malformed")).drop("__malformed"), both.where("__malformed").drop("__malformed", out)


def variant_field(variant: Column | str, path: str, kind: str) -> Column:
    """The value at ``path`` (``$.a.b[0]``) as ``kind``; null where it is absent or of another type."""
    return F.try_variant_get(F.col(variant) if isinstance(variant, str) else variant, path, kind)


def variant_schema(df: DataFrame, variant: str) -> str:
    """The schema that holds all variants of a column, in one distributed pass."""
    return df.agg(F.schema_of_variant_agg(variant)).first()[0]
