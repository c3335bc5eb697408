"""Scalar Column functions used by formulas, loaders and demos (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text formats dates travel in.
TEXT_TIMESTAMP = "yyyyMMddHHmmss"      # DATE values travel as this text
TEXT_MONTH = "yyyyMM"
TEXT_SECONDS = "yyyy-MM-dd HH:mm:ss"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def before_last(s: Column | str, sep: str = "_") -> Column:
    """Text before the last ``sep``; text without ``sep`` is returned unchanged, null stays null."""
    s = _c(s)
    pos = F.locate(sep[::-1], F.reverse(s))  # 1-based position of the reversed separator, 0 if absent
    cut = F.length(s) - pos - F.lit(len(sep) - 1)
    return F.when(pos == 0, s).otherwise(F.substring(s, F.lit(1), cut))


def ts_to_text(c: Column | str) -> Column:
    """Timestamp -> ``yyyyMMddHHmmss`` text (the DATE load rule)."""
    return F.date_format(_c(c), TEXT_TIMESTAMP)


def text_to_ts(c: Column | str, fmt: str = TEXT_TIMESTAMP) -> Column:
    """Text in ``fmt`` -> timestamp without time zone (the DATE save rule)."""
    return F.to_timestamp_ntz(_c(c), F.lit(fmt))


def js_div(a: Column | str, b: Column | str) -> Column:
    """Division with script-language rules: x/0 = ±Infinity, 0/0 = NaN (no ANSI error)."""
    a, b = _c(a).cast("double"), _c(b).cast("double")
    return (F.when(b == 0, F.when((a == 0) | F.isnan(a), F.lit(float("nan")))
                   .when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
            .otherwise(a / b))


def hash_bucket(cols: list[Column | str], n: int) -> Column:
    """Stable bucket in [0, n) from a 64-bit hash of the key columns."""
    return F.pmod(F.xxhash64(*[_c(c) for c in cols]), F.lit(n)).cast("int")


def text_bucket(cols: list[Column | str], n: int) -> Column:
    """Bucket in [0, n) from the MD5 of the key text: slower than
    :func:`hash_bucket`, but any engine with MD5 computes the same bucket
    (e.g. a database computing split predicates, or an SQL check)."""
    text = F.concat_ws("|", *[_c(c).cast("string") for c in cols])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def natural_key_id(cols: list[str]) -> Column:
    """Deterministic row id from the natural key (replaces random per-load ids)."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def random_id() -> Column:
    """A random id per row (``uuid()``), for callers that want the load-time
    random ids. It is non-deterministic: a recomputed partition gets new ids,
    so write or checkpoint the frame before anything joins on them; prefer
    :func:`natural_key_id`."""
    return F.expr("uuid()")


def json_map(c: Column | str) -> Column:
    """JSON object text -> map<string,string>."""
    return F.from_json(_c(c), "map<string,string>")


def row_map(cols: list[str]) -> Column:
    """The named columns of a row as map<string,string>."""
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])
