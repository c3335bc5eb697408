"""Lists of bounded size: a key's rows as numbered pages.

A list in one value holds all rows of a key. Here a row's position in its key
comes from stored ranges (:mod:`apportion.operators.scan`), rows of one page meet by
(key, page), and no value holds more rows than a page has, however many rows a
key has. Pages in order give the whole list again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apportion.operators.scan import keyed_prefix_scan

FORMS = ("array", "text", "json")


def paged_list(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column | str], fields: Sequence[str], size: int,
               form: str = "array", out: str = "items", partitions: int | None = None) -> DataFrame:
    """(keys, page, n, ``out``): pages from 0, each with the ``fields`` of up to ``size`` rows in order.

    ``form`` is ``array`` (structs; of a single field its values), ``text``
    (values as text joined by commas, nulls left out; one field) or ``json`` (an array of objects).
    Null values stay in arrays. Null keys form a key of their own. Stores the rows in the shared folder when it
    is called.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if size < 1 or form not in FORMS or (form == "text" and len(fields) != 1):
        raise ValueError(f"a page has a size of 1 or more and a form of {FORMS}; text has one field")
    taken = {"page", "n", out} & set(keys)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken")
    placed = keyed_prefix_scan(df.withColumn("__one", F.lit(1)), keys, order, "__one", partitions=partitions)
    place = F.col("scan_N") - 1
    row = F.struct(place.alias("at"), *[F.col(f).alias(f"v{i}") for i, f in enumerate(fields)])
    page = F.floor(place / size).cast("long")
    grouped = placed.select(*keys, page.alias("page"), row.alias("__row")).groupBy(*keys, "page").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list("__row")).alias("__rows"))
    if len(fields) == 1 and form != "json":
        values = F.transform("__rows", lambda r: r["v0"])
    else:
        values = F.transform("__rows", lambda r: F.struct(*[r[f"v{i}"].alias(f) for i, f in enumerate(fields)]))
    if form == "text":
        values = F.array_join(F.transform(values, lambda v: v.cast("string")), ",")
    elif form == "json":
        values = F.to_json(values)
    return grouped.select(*keys, "page", "n", values.alias(out))
