"""Column rules (R1-R14) as Spark expressions."""

from raw2clean.functions.rules import (
    Rule,
    as_column,
    digits,
    integer_text,
    keep_and_relabel,
    keep_codes,
    number,
    numeric,
    passthrough,
    range_or_number,
    text,
    text_length,
    text_without_digits,
    tract_code,
)

__all__ = [
    "Rule", "as_column", "digits", "integer_text", "keep_and_relabel", "keep_codes",
    "number", "numeric", "passthrough", "range_or_number", "text", "text_length",
    "text_without_digits", "tract_code",
]
