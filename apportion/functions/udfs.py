"""User-function surfaces: Arrow-batched, never per-row Python.

Built-in functions come first (:mod:`apportion.functions.scalar`); these are
for user code that has no built-in form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Reductions that may be applied to partial results in any grouping.
ASSOCIATIVE = ("sum", "min", "max", "prod")


@F.pandas_udf(T.LongType())
def adler32(s: pd.Series) -> pd.Series:
    """Adler-32 checksum of a text's UTF-8 bytes (null stays null).

    Computed over the whole batch: both of its sums are differences of running
    sums over all bytes of the batch, at the borders of the texts.
    """
    parts = [b"" if x is None else x.encode() for x in s]
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    starts = ends - [len(p) for p in parts]
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    # a byte counts once in the first sum, and once for each place up to its text's end in the second
    weighted = data * (np.repeat(ends, ends - starts) - np.arange(len(data)))
    plain, weighted = (np.concatenate([[0], np.cumsum(x)]) for x in (data, weighted))
    low = (1 + plain[ends] - plain[starts]) % 65521
    high = (ends - starts + weighted[ends] - weighted[starts]) % 65521
    return pd.Series((high << 16) | low, dtype="Int64").where(s.notna().to_numpy(), pd.NA)


@dataclass(frozen=True)
class Reducer:
    """A user aggregate as partial states that merge in any grouping.

    ``start`` turns the values (nulls left out) into one column per state,
    ``merge`` names the reduction that merges each state (sum, min, max or
    prod) and ``finish`` turns the merged states into results.
    """

    start: Callable[[pd.Series], Mapping[str, pd.Series]]
    merge: Mapping[str, str]
    finish: Callable[[pd.DataFrame], pd.Series]

    def __post_init__(self) -> None:
        wrong = {k: v for k, v in self.merge.items() if v not in ASSOCIATIVE}
        if wrong or not self.merge:
            raise ValueError(f"states merge by one of {ASSOCIATIVE}, not {wrong}")


#: Geometric mean of positive values.
GEOMETRIC_MEAN = Reducer(
    start=lambda s: {"log": np.log(s), "n": pd.Series(1.0, s.index)}, merge={"log": "sum", "n": "sum"},
    finish=lambda p: np.exp(p["log"] / p["n"]))


def group_reduce(df: DataFrame, keys: Sequence[str], value: str, reducer: Reducer, out: str) -> DataFrame:
    """Per-key user aggregate. Keys without a value give null; null keys form a key.

    Every Arrow batch is reduced to one row of states per key (map-side
    combine), the rows are dealt by key and sorted, and each partition merges
    its runs of equal keys batch by batch, carrying the last key's states: no
    Python call sees more than one batch, however many rows a key has.
    """
    keys, states = list(keys), list(reducer.merge)
    fields = [df.schema[k] for k in keys]
    partial = T.StructType(fields + [T.StructField(f"__{s}", T.DoubleType()) for s in states])
    result = T.StructType(fields + [T.StructField(out, T.DoubleType())])
    merge = {f"__{s}": reducer.merge[s] for s in states}

    def start(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                some = pdf[value].dropna()
                parts = reducer.start(some)
                yield reduced(pdf[keys].assign(**{f"__{s}": parts[s].reindex(pdf.index) for s in states}))

    def reduced(pdf: pd.DataFrame) -> pd.DataFrame:
        groups = pdf.groupby(keys, dropna=False, sort=False)
        return pd.DataFrame({c: getattr(groups[c], how)(min_count=1) for c, how in merge.items()}).reset_index()[keys + list(merge)]

    def finish(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for pdf in batches:
            if not len(pdf):
                continue
            merged = reduced(pdf if held is None else pd.concat([held, pdf], ignore_index=True))
            held = merged.tail(1)
            if len(merged) > 1:
                yield finished(merged.iloc[:-1])
        if held is not None:
            yield finished(held)

    def finished(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[keys].assign(**{out: reducer.finish(pdf[list(merge)].rename(columns=lambda c: c[2:]))})

    rows = df.select(*keys, F.col(value).cast("double").alias(value)).mapInPandas(start, partial)
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(finish, result)
