from .banding import age_band, hour_band, ratio_band
from .coding import (
    code_flag,
    conform_label,
    default_label,
    eligible_size,
    group_members,
    in_set,
    informality,
    major_group,
    plausible_value,
    signed_effect,
    simple_case,
    turnover_flags,
    year_lookup,
)
from .parsing import decimal_comma, decimal_point, integer, positive_or_null
from .periods import is_month, month_index, period_year, shift_months

__all__ = [
    "age_band", "code_flag", "conform_label", "decimal_comma", "decimal_point",
    "default_label", "eligible_size", "group_members", "hour_band", "in_set",
    "informality", "integer", "is_month", "major_group", "month_index", "period_year",
    "plausible_value", "positive_or_null", "ratio_band", "signed_effect",
    "shift_months", "simple_case", "turnover_flags", "year_lookup",
]
