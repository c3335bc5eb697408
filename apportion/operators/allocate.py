"""Waterfall allocation of a per-key total over ordered items.

Rule (per key, items in the given order; ``remaining`` starts at the key's
total, 0 when the key has none):

* a non-last item takes ``remaining`` when its amount is at least
  ``remaining`` (and ``remaining`` becomes 0), otherwise its own amount
  (and ``remaining`` drops by it — a negative amount raises it again);
* the last item takes all that remains, even above its own amount.

The sequential rule has a closed form: with ``E`` the sum of the earlier
amounts and ``M`` the largest running sum among the earlier items,
``remaining = max(total, M) - E``. So the allocation is a keyed prefix scan
(:mod:`apportion.operators.scan`), which splits a hot key over many tasks,
instead of a per-key loop. Totals join the items inside the scan's range
shuffle as seed rows, so no join of the items by key is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.operators.scan import keyed_prefix_scan, sum_type


def pick_total(totals: DataFrame, keys: Sequence[str], total: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One total per key: the first by ``order_by``, else the smallest (a fixed
    choice). Totals with a null key match no item (as in a join)."""
    if order_by:
        agg = F.min_by(F.col(total), F.struct(*[F.col(c) for c in order_by]))
    else:
        agg = F.min(total)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    return totals.where(not_null).groupBy(*keys).agg(agg.alias(total))


def waterfall(items: DataFrame, totals: DataFrame, keys: Sequence[str] | str, amount: str,
              order_by: Sequence[Column | str], total: str, out: str = "allocated",
              with_position: bool = False, total_order_by: Sequence[str] = (),
              partitions: int | None = None) -> DataFrame:
    """Allocate ``totals[total]`` over ``items`` per key (see module docstring).

    ``order_by`` orders the items of a key (Columns may be ``F.desc``); end it
    with a unique column so the order is total. ``totals`` may hold several
    rows per key; one is picked with :func:`pick_total`. Keys of ``totals``
    without items produce nothing. Returns ``items`` plus ``out`` (same type
    as ``amount``) and, with ``with_position``, the 1-based position and a
    last-item flag.

    ``partitions`` is the number of ranges of the scan (default:
    ``spark.sql.shuffle.partitions``); size it so one range's rows sort
    comfortably in one task (about 128-512 MB of items each). The scan stores
    its rows in the shared folder when this function is called.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    atype = items.schema[amount].dataType
    scanned = _scanned(items, totals, keys, amount, order_by, total, total_order_by, partitions)
    wide = sum_type(atype)
    zero = F.lit(0).cast(wide)
    remaining = (F.greatest(F.coalesce("scan_R", zero), "scan_M") - F.col("scan_E")).cast(wide)
    own = F.coalesce(F.col(amount).cast(wide), zero)
    take = F.when(F.col("scan_last"), remaining).otherwise(F.least(own, remaining))
    cols = [F.col(c) for c in items.columns] + [take.cast(atype).alias(out)]
    if with_position:
        cols += [F.col("scan_N").alias(f"{out}_position"), F.col("scan_last").alias(f"{out}_is_last")]
    return scanned.select(*cols)


def _scanned(items: DataFrame, totals: DataFrame, keys: Sequence[str], amount: str, order_by: Sequence[Column | str],
             total: str, total_order_by: Sequence[str], partitions: int | None) -> DataFrame:
    """The items after the prefix scan, with the totals as seed rows (in the type of the sums)."""
    t = pick_total(totals, keys, total, total_order_by)
    wide = sum_type(items.schema[amount].dataType)
    seeds = t.select(*keys, F.col(total).cast(wide).alias("__seed"), F.lit(0).alias("__wk"))
    both = items.withColumn("__wk", F.lit(1)).unionByName(seeds, allowMissingColumns=True)
    scanned = keyed_prefix_scan(both, keys, order_by, value=amount, seed="__seed", kind="__wk", partitions=partitions)
    return scanned.where(F.col("__wk") == 1)


def cogroup_running(items: DataFrame, totals: DataFrame, keys: Sequence[str] | str, amount: str,
                    order_by: Sequence[Column | str], total: str, prefix: str = "cg",
                    total_order_by: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """The co-grouped view a per-key allocation works on, without gathering a key.

    Items and totals meet per key in the same single range shuffle as in
    :func:`waterfall` (totals as seed rows). Each item gets its key's total
    (``<prefix>_total``, null when the key has none), the sum of the earlier
    items' amounts (``<prefix>_before``), its 1-based position and a
    last-item flag. Keys with a total but no items produce nothing.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    atype = items.schema[amount].dataType
    scanned = _scanned(items, totals, keys, amount, order_by, total, total_order_by, partitions)
    return scanned.select(
        *[F.col(c) for c in items.columns],
        F.col("scan_R").cast(atype).alias(f"{prefix}_total"),
        F.col("scan_E").cast(sum_type(atype) if atype.typeName() != "double" else atype).alias(f"{prefix}_before"),
        F.col("scan_N").alias(f"{prefix}_position"), F.col("scan_last").alias(f"{prefix}_is_last"))
