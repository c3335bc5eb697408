"""Loading data sets: parameterised SQL, type normalisation, stored-row ids,
and the key-uniqueness guard."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from apportion.functions.scalar import natural_key_id, ts_to_text
from apportion.operators.keys import join_matches

# Type codes of data set fields.
STRING, NUMBER, DATE = 1, 2, 3


@dataclass(frozen=True)
class Field:
    """A data set field: source column, engine name, type code, natural-key flag."""

    source: str
    name: str | None = None
    type: int = STRING
    is_key: bool = False

    @property
    def out(self) -> str:
        return self.name or self.source


def run_script(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None,
               raw: Mapping[str, str] | None = None, allowed_raw: Iterable[str] = (),
               **frames: DataFrame) -> DataFrame:
    """Run a data set's SQL.

    * ``:name`` markers are bound from ``params`` as values (never spliced into
      the text; ``IDENTIFIER(:name)`` binds a table or column name). A marker
      without a value raises.
    * ``{name}`` placeholders take DataFrames from ``frames`` or raw text from
      ``raw``; raw text must be one of ``allowed_raw``.
    """
    if params is None:
        raise ValueError("script parameters are required (pass {} for none)")
    allowed = set(allowed_raw)
    for name, text in (raw or {}).items():
        if text not in allowed:
            raise ValueError(f"raw text for {{{name}}} is not in the allow-list: {text!r}")
    return spark.sql(sql, args=dict(params), **frames, **dict(raw or {}))


def _normalise_col(df: DataFrame, f: Field) -> Column:
    if f.source not in df.columns:
        # an empty result column: numbers load as 0.0, the rest as null
        base = F.lit(None)
        src_type: T.DataType = T.NullType()
    else:
        base = F.col(f.source)
        src_type = df.schema[f.source].dataType
    if f.type == NUMBER:
        if not isinstance(src_type, T.StringType):
            return F.coalesce(base.cast("double"), F.lit(0.0)).alias(f.out)
        num = base.try_cast("double")
        bad = F.raise_error(F.concat(F.lit(f"field {f.source}: not a number: "), base)).cast("double")
        return F.when(base.isNull(), F.lit(0.0)).when(num.isNull(), bad).otherwise(num).alias(f.out)
    if f.type == DATE:
        return ts_to_text(base).alias(f.out)
    if f.type == STRING:
        if isinstance(src_type, T.BinaryType):
            return F.hex(base).alias(f.out)
        return base.cast("string").alias(f.out)
    raise ValueError(f"unknown type code {f.type} for field {f.source!r}")


def normalise(df: DataFrame, fields: Sequence[Field], row_id: str | None = "row_id",
              extra: Sequence[str] = ()) -> DataFrame:
    """Rename and type every field in one projection (numbers: double with
    null -> 0.0, text that is no number raises; dates: ``yyyyMMddHHmmss`` text; binary: hex; rest: text),
    with a deterministic row id from the key fields first."""
    keys = [f.source for f in fields if f.is_key]
    cols = [_normalise_col(df, f) for f in fields]
    cols += [F.col(c) for c in extra]
    if row_id and keys:
        cols = [natural_key_id(keys).alias(row_id)] + cols
    return df.select(*cols)


def attach_old_id(src: DataFrame, target: DataFrame, keys: Sequence[str] | Mapping[str, str],
                  pk: str, out: str = "OLD_ID") -> DataFrame:
    """Add the stored row's primary key (null = new row) by a left join on the natural key.

    A source row whose key matches several stored rows raises when it is
    evaluated; duplicates among other keys do not matter.
    """
    pairs = list(keys.items()) if isinstance(keys, Mapping) else [(k, k) for k in keys]
    if not pairs:
        raise ValueError("attach_old_id needs at least one key field")
    tk = [f"__t{i}" for i in range(len(pairs))]
    named = [F.col(r).alias(t) for (_, r), t in zip(pairs, tk)]
    right = (target.where(reduce(and_, [F.col(r).isNotNull() for _, r in pairs])).groupBy(*named)
             .agg(F.count(F.lit(1)).alias("__n"), F.any_value(pk).alias("__pk")))
    several = F.raise_error(F.concat(F.lit(f"stored rows are not unique on {[r for _, r in pairs]}: "),
                                     F.to_json(F.struct(*tk))))
    guarded = F.when(F.col("__n") > 1, several).otherwise(F.col("__pk")).alias(out)
    joined = join_matches(src, right, [(left, t) for (left, _), t in zip(pairs, tk)], [*src.columns[:1], *(left for left, _ in pairs)])
    return joined.select(*[F.col(c) for c in src.columns], guarded)


def duplicate_keys(target: DataFrame, keys: Sequence[str], src: DataFrame | None = None,
                   src_keys: Sequence[str] | None = None, count_col: str = "n") -> DataFrame:
    """Key groups of ``target`` holding more than one row (restricted to keys
    present in ``src`` when given). Lazy; partial aggregation splits hot keys."""
    dup = target.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)
    if src is not None:
        sk = list(src_keys or keys)
        probe = src.select(*[F.col(s).alias(k) for s, k in zip(sk, keys)]).distinct()
        dup = dup.join(probe, list(keys), "left_semi")
    return dup


def assert_unique(target: DataFrame, keys: Sequence[str], src: DataFrame | None = None,
                  src_keys: Sequence[str] | None = None) -> None:
    """Raise when a stored key matches several rows (a one-row probe, not a full count)."""
    bad = duplicate_keys(target, keys, src, src_keys).take(1)
    if bad:
        raise ValueError(f"stored rows are not unique on {list(keys)}: e.g. {bad[0].asDict()}")
