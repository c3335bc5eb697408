"""Per-key row picks and left joins on keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """For each key, ``cols`` of the row that is first by ``order`` (end it with a
    unique column). ``min_by`` is a partial aggregate: a hot key is reduced in
    every map task before the shuffle, never gathered into one task."""
    picked = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(picked.alias("__first")).select(*keys, *[F.col("__first")[c].alias(c) for c in cols])


#: Types whose values a column can be hashed from, and that a stand-in for null can be made of.
_ATOMIC = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)


def _stand_in(number: Column, dtype: T.DataType) -> Column | None:
    """``number`` (a hash) as a value of ``dtype``; None for types that get no stand-in."""
    if isinstance(dtype, T.LongType):
        return number
    if isinstance(dtype, T.IntegralType):
        top = {"int": 2**31 - 1, "smallint": 2**15 - 1}.get(dtype.simpleString(), 2**7 - 1)
        return F.pmod(number, F.lit(top).cast("long")).cast(dtype)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.StringType)):
        return number.cast(dtype)
    if isinstance(dtype, T.DecimalType) and dtype.precision > dtype.scale:
        return F.pmod(number, F.lit(10 ** min(dtype.precision - dtype.scale, 18)).cast("long")).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(number, F.lit(100_000).cast("long")).cast("int"))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_seconds(F.pmod(number, F.lit(4_000_000_000)))
    return None


def join_matches(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], spread_by: Sequence[str] = ()) -> DataFrame:
    """Left join on ``left.a = right.b`` for each (a, b) of ``pairs``; null keys match nothing.

    Spark deals all rows with a null key to one task. Here a null key is
    replaced, in the join key alone, by a value made of a hash of the row's
    ``spread_by`` columns (default: the first one), and a second condition
    keeps it from matching. So such rows spread over the tasks as far as these
    columns differ, at no further shuffle: ``right`` keeps its partitioning.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    names = [c for c in dict.fromkeys(spread_by or left.columns[:1]) if isinstance(types.get(c), _ATOMIC)]
    number = F.xxhash64(*[F.col(c) for c in names]) if names else None
    conditions = []
    for a, b in pairs:
        instead = None if number is None else _stand_in(number, types[a])
        if instead is None:
            conditions.append(F.col(a) == F.col(b))
        else:
            conditions += [F.coalesce(F.col(a), instead) == F.col(b), F.col(a).isNotNull()]
    return left.join(right, reduce(and_, conditions), "left")
