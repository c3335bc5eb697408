"""apportion — rule-driven settlement and allocation on Spark DataFrames.

Data sets are plain DataFrames; formulas are declarative specs that compile to
ordinary DataFrame plans (aggregate-then-join, conditional column updates),
so Catalyst and AQE optimise a whole settlement as one plan.
"""

from apportion.specs import Formula, Input, Item, avg_of, list_of, lookup, sum_of
from apportion.operators.formula import add_result_columns, apply_formula, apply_item, changed_datasets, settle
from apportion.operators.allocate import cogroup_running, waterfall
from apportion.operators.scan import keyed_prefix_scan

__all__ = [
    "Input", "Item", "Formula", "lookup", "sum_of", "avg_of", "list_of",
    "apply_item", "apply_formula", "settle", "changed_datasets", "add_result_columns",
    "waterfall", "cogroup_running", "keyed_prefix_scan",
]
