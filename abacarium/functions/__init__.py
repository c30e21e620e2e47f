"""Column helpers shared by the operators."""

from .bands import GRADE_BANDS, band, grade_band
from .dates import (
    date_key, in_range, month_label, month_of, month_range, month_start, parse_or_null, quarter_label, year_range,
)
from .money import (
    amount, cents, from_cents, mean, percent, percentage, ratio, round_half_even, round_whole, rounded_ratio, sum_whole,
    to_double, whole_ratio,
)
from .text import contains_any_ci, text_or, trimmed_or

__all__ = [
    "GRADE_BANDS", "amount", "band", "cents", "contains_any_ci", "date_key", "from_cents", "grade_band", "in_range",
    "mean", "month_label", "month_of", "month_range", "month_start", "parse_or_null", "percent", "percentage",
    "quarter_label", "ratio", "round_half_even", "round_whole", "rounded_ratio", "sum_whole", "text_or", "to_double",
    "trimmed_or", "whole_ratio", "year_range",
]
