from .coerce import (
    aging_bucket,
    at_least_zero,
    finite_or_zero,
    instant,
    number,
    ratio,
    sum_or_zero,
    week_start,
    whole_days,
)
from .keys import (
    canonical_document,
    canonical_item,
    canonical_key,
    folded_document,
    range_table,
    strip_space,
    text_key,
    whole_number,
)

__all__ = [
    "aging_bucket",
    "at_least_zero",
    "canonical_document",
    "canonical_item",
    "canonical_key",
    "finite_or_zero",
    "folded_document",
    "instant",
    "number",
    "range_table",
    "ratio",
    "strip_space",
    "sum_or_zero",
    "text_key",
    "week_start",
    "whole_days",
    "whole_number",
]
