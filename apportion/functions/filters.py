"""Equality filters (formula filter, input filter).

A pair ``column = value`` compares numbers by value: a literal that the
column's type cannot hold exactly (3.7 for an integer, 1.009 for two decimal
places) matches nothing, it is never rounded to match. Text compares as text.
A null cell never matches. The predicate is an ordinary Column with a literal
of the column's type, so Catalyst pushes it into the scan.
"""

from __future__ import annotations

from decimal import Decimal, InvalidOperation
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType, StringType


def equality(df: DataFrame, pairs: Any) -> Column | None:
    """AND of ``col == value`` for ``pairs`` (mapping or pairs); None if empty."""
    items = list(pairs.items()) if hasattr(pairs, "items") else list(pairs or ())
    if not items:
        return None
    types = {f.name: f.dataType for f in df.schema.fields}
    preds = []
    for name, value in items:
        if name not in types:
            raise KeyError(f"filter column {name!r} is not in the data set; columns: {sorted(types)}")
        dtype = types[name]
        if value is None:
            # "= null" matches nothing, as in SQL
            preds.append(F.lit(False))
            continue
        if isinstance(dtype, NumericType):
            exact = number_literal(value, dtype)
            preds.append(F.lit(False) if exact is None else F.col(name) == F.lit(exact).cast(dtype))
        else:
            lit = F.lit(str(value)) if isinstance(dtype, StringType) else F.lit(value).cast(dtype)
            preds.append(F.col(name) == lit)
    return reduce(and_, preds)


def number_literal(value: Any, dtype: NumericType) -> int | float | Decimal | None:
    """``value`` (a number or its text) as a value of ``dtype``; None if the type has no such value."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return float(value)
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        raise ValueError(f"filter value {value!r} is not a number") from None
    if not number.is_finite():
        return None
    if isinstance(dtype, DecimalType):
        digits = number.normalize().as_tuple()
        whole = len(digits.digits) + digits.exponent
        return number if -digits.exponent <= dtype.scale and whole <= dtype.precision - dtype.scale else None
    bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(dtype.simpleString(), 64)
    return int(number) if number == number.to_integral_value() and -(1 << bits - 1) <= number < 1 << bits - 1 else None
