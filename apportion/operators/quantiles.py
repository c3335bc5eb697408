"""Exact order statistics per key without a list.

The rows are counted per (key, value), the counts are laid out by
(key, value) over stored ranges (:mod:`apportion.operators.scan`), and the running count before
a value says which ranks it holds. The key's total count travels as the
seed row of the scan, so nothing is joined by key: a key with a third of all
rows, or with all values different, lies over many ranges. At most one row per key and
statistic leaves the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.operators.scan import keyed_prefix_scan


def keyed_quantiles(df: DataFrame, keys: Sequence[str] | str, value: str, quantiles: Mapping[str, float | str],
                    partitions: int | None = None) -> DataFrame:
    """One row per key with each named quantile of ``value`` and ``n``, the count of values.

    ``quantiles`` maps column names to shares from 0 to 1 (read as decimals,
    so 0.1 is a tenth). A quantile is a value that occurs: the smallest whose rank is at
    least share * n (discrete quantiles). Nulls and keys without values
    are left out; null keys form a key of their own; NaN sorts last. Stores the counts in the shared folder
    when it is called.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    shares = {name: Decimal(str(q)) for name, q in quantiles.items()}
    if not shares or any(not 0 <= q <= 1 for q in shares.values()):
        raise ValueError("quantiles are shares from 0 to 1")
    taken = {"n", *keys} & set(shares)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    kept = df.where(F.col(value).isNotNull()).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(value).alias("__value"))
    names = [f"__k{i}" for i in range(len(keys))]
    counts = kept.groupBy(*names, "__value").agg(F.count("*").alias("__count")).withColumn("__is", F.lit(1))
    totals = kept.groupBy(*names).agg(F.count("*").alias("__total")).withColumn("__is", F.lit(0))
    scanned = keyed_prefix_scan(counts.unionByName(totals, allowMissingColumns=True), names, ["__value"], "__count",
                                seed="__total", kind="__is", partitions=partitions).where("__is = 1")
    before, n = F.col("scan_E").cast("long"), F.col("scan_R").cast("long")
    upto = before + F.col("__count")
    picks = []
    for name, q in shares.items():
        scale = max(0, -q.as_tuple().exponent)
        part = int((q * 10**scale).to_integral_value(ROUND_CEILING))
        # the rank share * n, rounded up, in whole numbers; at least the first
        exact = F.ceil(n.cast("decimal(20,0)") * F.lit(part).cast("decimal(18,0)") / F.lit(10**scale).cast("decimal(18,0)")).cast("long")
        rank = F.greatest(F.lit(1).cast("long"), exact)
        picks.append(F.max(F.when((before < rank) & (rank <= upto), F.struct(F.col("__value").alias("v")))).alias(name))
    # partial aggregation leaves one row per key and range before the shuffle
    found = scanned.groupBy(*names).agg(F.max(n).alias("n"), *picks)
    return found.select(*[F.col(a).alias(k) for a, k in zip(names, keys)], "n", *[F.col(name)["v"].alias(name) for name in shares])
