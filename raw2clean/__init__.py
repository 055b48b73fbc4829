"""raw2clean: clean wide raw CSV tables by column rules and measure their quality, on Spark.

Everything is built from DataFrame expressions; Spark plans and runs it.
"""

from raw2clean.functions.rules import (
    Rule, digits, integer_text, keep_and_relabel, keep_codes, numeric, passthrough,
    range_or_number, text_length, text_without_digits, tract_code,
)
from raw2clean.operators.dedup import dedup_by_key, distinct_rows, top_n_per_group
from raw2clean.operators.quality import (
    column_count, completeness, evaluate, non_empty, profile, run_checks,
)
from raw2clean.operators.shape import (
    blank_high_cardinality, distinct_counts, drop_empty_columns, drop_empty_rows,
    drop_null_columns, merge_by_name, null_counts, null_sentinels, value_counts,
)
from raw2clean.plans.jobs import clean, merge_folder, run_clean, run_clean_years, run_merge, run_quality
from raw2clean.plans.presets import preset, preset_for_year
from raw2clean.plans.ruleset import (
    RuleSet, cast_to_string, keep_one_column, non_negative, numeric_except, trim_strings,
)
from raw2clean.sources.io import (
    list_files, preview, promote_header, read_table, write_table, year_of_file,
)

__version__ = "0.1.0"
