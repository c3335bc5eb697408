"""A settlement job compiled from catalog tables.

The definitions of data sets and formulas live in seven tables (any source
that Spark reads; extra columns are ignored):

==============  =============================================================
``data_sets``   id, name, market, deleted (0: in use)
``scripts``     dataset_id, version, sql
``fields``      dataset_id, origin, name, type (1 text, 2 number, 3 date), is_key (1: natural key)
``results``     id, dataset_id, version, table_name, primary_key
``mappings``    result_id, field, column_name
``formulas``    id, name, dataset_id, filter (JSON object), market, deleted, position
``items``       id, formula_id, field, content (formula text), position
==============  =============================================================

:func:`read_formulas` takes the formulas of one market that are asked for, not
deleted, in order of position, with their items in order;
:func:`read_data_sets` the data sets these read or write, with the script of
the source version and the stored target of the target version. Selection,
joins, grouping and the JSON filter run in Spark; what reaches the driver is
one row per selected formula and data set. A formula's text is read by :mod:`apportion.plans.formula_text`.

In scripts ``${name}`` is a parameter, bound as a value and never spliced in,
``#{name}`` raw text (from an allow-list) and ``{table}`` a given table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apportion.plans.formula_text import formula_from_text
from apportion.plans.job import DataSet, SettlementResult, Target, run
from apportion.sources.load import Field
from apportion.specs import Formula

Catalog = Mapping[str, DataFrame]


def _in_use(rows: DataFrame, market: str, ids: Sequence[str]) -> DataFrame:
    """The rows of a market that are asked for and not deleted (no ids: none)."""
    return rows.where((F.col("market") == market) & (F.col("deleted") == 0) & F.col("id").isin(list(ids)))


def _grouped(rows: DataFrame, owner: str, order: Sequence[str], values: Sequence[str], out: str) -> DataFrame:
    """(owner, out): the rows of each owner as a list in ``order``."""
    entry = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *values)
    return rows.groupBy(owner).agg(F.array_sort(F.collect_list(entry)).alias(out))


def json_filter(column: Column) -> Column:
    """A JSON object as a map of texts; empty or null: no filter; other text raises."""
    text = F.nullif(F.trim(column), F.lit(""))
    pairs = F.from_json(text, "map<string,string>")
    wrong = F.raise_error(F.concat(F.lit("filter is no JSON object: "), text)).cast("map<string,string>")
    return F.when(text.isNull(), F.create_map().cast("map<string,string>")).when(pairs.isNull(), wrong).otherwise(pairs)


def read_formulas(catalog: Catalog, market: str, formula_ids: Sequence[str]) -> list[Formula]:
    """The formulas asked for, in order of position (ties by id), each with its items in order."""
    chosen = _in_use(catalog["formulas"], market, formula_ids).select("id", "name", "dataset_id", "position", json_filter(F.col("filter")).alias("filter"))
    items = catalog["items"].where(F.col("formula_id").isin(list(formula_ids)))
    listed = _grouped(items, "formula_id", ["position", "id"], ["field", "content"], "items")
    rows = chosen.join(listed, F.col("id") == F.col("formula_id"), "left").orderBy("position", "id").collect()
    return [formula_from_text(r.name or r.id, r.dataset_id, [(i.field, i.content) for i in r["items"] or []], filter=r["filter"]) for r in rows]


def used_data_sets(formulas: Iterable[Formula]) -> list[str]:
    """Ids of the data sets that formulas write or read, each once."""
    used: dict[str, None] = {}
    for f in formulas:
        used.setdefault(f.dataset)
        for item in f.items:
            for i in item.inputs:
                used.setdefault(i.dataset)
    return list(used)


def script_text(sql: str) -> str:
    """A script with its parameters as markers that :func:`apportion.sources.load.run_script` binds."""
    return re.sub(r"#\{\s*(\w+)\s*\}", r"{\1}", re.sub(r"\$\{\s*(\w+)\s*\}", r":\1", sql))


def read_data_sets(catalog: Catalog, market: str, dataset_ids: Sequence[str], source: str, target: str) -> list[DataSet]:
    """The data sets asked for with the script of version ``source`` and the stored target of version ``target``."""
    ids = list(dataset_ids)
    scripts = catalog["scripts"].where(F.col("version") == source).select(F.col("dataset_id").alias("id"), "sql")
    defined = _in_use(catalog["data_sets"], market, ids).select("id").join(scripts, "id")
    stored = (catalog["results"].where(F.col("version") == target).withColumnRenamed("id", "result_id")
              .join(catalog["mappings"].withColumnRenamed("field", "name"), "result_id")
              .select("dataset_id", "name", "table_name", "primary_key", "column_name"))
    fields = catalog["fields"].where(F.col("dataset_id").isin(ids)).select("dataset_id", "origin", "name", "type", "is_key")
    mapped = fields.join(stored, ["dataset_id", "name"], "left")
    listed = _grouped(mapped, "dataset_id", ["name"], ["origin", "name", "type", "is_key", "table_name", "primary_key", "column_name"], "fields")
    rows = {r.id: r for r in defined.join(listed, F.col("id") == F.col("dataset_id"), "left").collect()}
    missing = [i for i in ids if i not in rows]
    if missing:
        raise ValueError(f"data sets {missing} are not in the catalog of market {market!r} with a script of version {source!r}")
    out = []
    for i in ids:
        found = rows[i]["fields"] or []
        table = next(((f.table_name, f.primary_key) for f in found if f.table_name and f.primary_key), None)
        saved = Target(*table, {f.name: f.column_name for f in found if f.column_name}) if table else None
        out.append(DataSet(i, script_text(rows[i].sql), tuple(Field(f.origin, f.name, f.type, f.is_key == 1) for f in found), saved))
    return out


def run_catalog(spark: SparkSession, catalog: Catalog, market: str, formula_ids: Sequence[str], source: str, target: str,
                params: Mapping[str, Any], tables: Mapping[str, DataFrame], read_stored: Callable[[str], DataFrame] | None = None,
                raw: Mapping[str, str] | None = None, allowed_raw: Iterable[str] = (),
                checkpoint_every: int | None = None) -> tuple[SettlementResult, list[DataSet]]:
    """Compile the formulas asked for and their data sets and run the job (lazy until saved)."""
    formulas = read_formulas(catalog, market, formula_ids)
    datasets = read_data_sets(catalog, market, used_data_sets(formulas), source, target)
    return run(spark, datasets, formulas, params, tables, read_stored, checkpoint_every, raw, allowed_raw), datasets
