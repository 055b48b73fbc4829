"""The rule lists of the legacy quality jobs, held as data.

* ``raw_table_rules()``: six "non-empty" rules on the raw fuel-station table.
* ``processed_table_rules()``: six on the processed table; one column is
  checked twice, and both outcome rows are kept.
* The statistics job has no rules and asks for all statistics of all
  columns: ``run_checks(df, [], statistics=True)``.
"""

from __future__ import annotations

from raw2clean.operators.quality import QualityRule, non_empty

# The checked columns, in the jobs' order.
RAW_TABLE_COLUMNS = [
    "intersection directions", "plus4", "bd blends", "cng station sells renewable natural gas",
    "cng total compression capacity", "funding sources",
]
PROCESSED_TABLE_COLUMNS = [
    "intersection directions", "cng fill type code", "bd blends", "ev level2 evse num",
    "cng fill type code", "cng psi",
]


def raw_table_rules() -> list[QualityRule]:
    return [non_empty(c, 0) for c in RAW_TABLE_COLUMNS]


def processed_table_rules() -> list[QualityRule]:
    return [non_empty(c, 0) for c in PROCESSED_TABLE_COLUMNS]
