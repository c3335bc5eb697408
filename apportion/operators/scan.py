"""Keyed ordered prefix scan that splits hot keys.

Per key, in a given order, every row gets

* ``E``   – sum of the values of the earlier rows (exclusive prefix),
* ``M``   – the largest inclusive prefix sum among the earlier rows (null if none),
* ``R``   – the key's seed value (from a seed row that sorts before the key's rows),
* ``N``   – the row's 1-based position in its key,
* ``last``– whether it is the key's last row.

A ``Window.partitionBy(key)`` would put all rows of a key into one task. Here
the rows are range-partitioned on (key, order) once and *stored* in the
shared folder together with the number of their range, so a row's range is
data: every later step reads the same number, whatever plan, cache or
recomputation it runs under. Then

1. windows over (range, key) compute the values inside a range — a key that
   holds a third of all rows is spread over a third of the ranges;
2. the keys that cross a range border (fewer than there are ranges) are
   summed per range, and windows over these few rows (at most two per range)
   give what earlier ranges add;
3. a broadcast join of that table (its size bounded by the number of ranges,
   not by the data) adds it.

Integers and decimals are summed as decimals of up to 38 digits, so no sum of
64-bit values overflows and results are exact. Double sums depend on where
the range borders lie in their last digits; use decimals where that matters.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apportion.sources.readers import stored

RANGE, ROW, KIND, VAL, SEED = "__range", "__row", "__kind", "__v", "__s"


def _number(dtype: T.DataType) -> T.DataType:
    """The type values are read in; sums of it get ten digits more (38 at most)."""
    if isinstance(dtype, T.DecimalType):
        return dtype
    if isinstance(dtype, T.IntegralType):
        return T.DecimalType(20, 0)
    return T.DoubleType()


def sum_type(dtype: T.DataType) -> T.DataType:
    """The type of the scan's sums for values of ``dtype``."""
    num = _number(dtype)
    return T.DecimalType(38, num.scale) if isinstance(num, T.DecimalType) else num


def keyed_prefix_scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                      value: str, seed: str | None = None, kind: str | None = None,
                      partitions: int | None = None) -> DataFrame:
    """Add the scan columns (see module docstring) to ``df``.

    Rows that ``order`` leaves tied keep one fixed, arbitrary order. With
    ``kind`` given, rows with ``kind = 0`` are seed rows (they carry ``seed``)
    and only rows with ``kind = 1`` count as values. Null keys form a key of
    their own; a null value counts as 0. Output columns: ``scan_E``,
    ``scan_M``, ``scan_R`` (in :func:`sum_type`), ``scan_N``, ``scan_last``.
    ``partitions`` is the number of ranges (default: the session's shuffle
    partitions; size it so that a range sorts comfortably in one task).
    """
    num, wide = _number(df.schema[value].dataType), sum_type(df.schema[value].dataType)
    zero = F.lit(0).cast(wide)
    own = [F.col(o) if isinstance(o, str) else o for o in order]
    base = df.select(
        "*", (F.col(kind) if kind else F.lit(1)).cast("int").alias(KIND),
        F.coalesce(F.col(value).cast(num), F.lit(0).cast(num)).alias(VAL),
        (F.col(seed).cast(wide) if seed else F.lit(None).cast(wide)).alias(SEED))
    base = base.withColumn(VAL, F.when(F.col(KIND) == 1, F.col(VAL)).otherwise(F.lit(0).cast(num)))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = base.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys], F.col(KIND).asc(), *own)
    rows = stored(ranged.withColumn(RANGE, F.spark_partition_id()).withColumn(ROW, F.monotonically_increasing_id()),
                  "scan")

    here = Window.partitionBy(RANGE, *keys).orderBy(KIND, *own, ROW)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def inside(frame: DataFrame) -> DataFrame:
        """Prefix sums inside a range and key: ``__E`` before the row, ``__I`` with it (values only)."""
        e = F.coalesce(F.sum(VAL).over(before).cast(wide), zero)
        return (frame.withColumn("__E", e)
                .withColumn("__I", F.when(F.col(KIND) == 1, (F.col("__E") + F.col(VAL)).cast(wide))))

    # keys that cross a range border, and what each of their ranges holds
    crossing = (rows.groupBy(*keys).agg(F.min(RANGE).alias("__lo"), F.max(RANGE).alias("__hi"))
                .where("__lo < __hi").select(*[F.col(k).alias(f"__c_{k}") for k in keys], "__hi"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in keys])
    held = inside(rows.join(F.broadcast(crossing), same)).groupBy(RANGE, *[f"__c_{k}" for k in keys], "__hi").agg(
        F.sum(VAL).cast(wide).alias("__S"), F.sum(KIND).alias("__Nend"), F.max(SEED).cast(wide).alias("__Rend"),
        F.max("__I").alias("__Mend"))
    earlier = (Window.partitionBy(*[f"__c_{k}" for k in keys]).orderBy(RANGE)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = (held.withColumn("__cE", F.coalesce(F.sum("__S").over(earlier).cast(wide), zero))
             .withColumn("__cM", F.max((F.col("__cE") + F.col("__Mend")).cast(wide)).over(earlier))
             .withColumn("__cR", F.max("__Rend").over(earlier))
             .withColumn("__cN", F.sum("__Nend").over(earlier))
             .select(F.col(RANGE).alias("__c_range"), *[f"__c_{k}" for k in keys], "__hi", "__cE", "__cM", "__cR", "__cN"))

    scanned = (inside(rows)
               .withColumn("__M", F.max("__I").over(before))
               .withColumn("__R", F.first(SEED, ignorenulls=True).over(upto).cast(wide))
               .withColumn("__N", F.sum(KIND).over(upto))
               .withColumn("__last", F.lead(F.lit(1)).over(here).isNull()))
    out = scanned.join(F.broadcast(carry), (F.col(RANGE) == F.col("__c_range")) & same, "left")
    c = F.coalesce(F.col("__cE"), zero)
    return out.select(
        *[F.col(x) for x in df.columns],
        (c + F.col("__E")).cast(wide).alias("scan_E"),
        F.greatest(F.col("__cM"), (c + F.col("__M")).cast(wide)).alias("scan_M"),
        F.coalesce("__R", "__cR").alias("scan_R"),
        (F.coalesce(F.col("__cN"), F.lit(0)) + F.col("__N")).alias("scan_N"),
        (F.col("__last") & (F.coalesce(F.col("__hi"), F.col(RANGE)) == F.col(RANGE))).alias("scan_last"))
