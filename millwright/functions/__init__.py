"""Column helpers used across plans."""

from millwright.functions.numeric import clip, fixed_avg, half_even, pearson, share, to_double
from millwright.functions.temporal import (
    at_or_before_zero,
    day_of,
    floor_div,
    hours_between,
    month_of,
    parse_timestamps,
)

__all__ = [
    "at_or_before_zero", "clip", "day_of", "fixed_avg", "floor_div", "half_even", "hours_between", "month_of",
    "parse_timestamps", "pearson", "share", "to_double",
]
