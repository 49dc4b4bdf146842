"""Reusable column expressions (durations, codes, ratios, keys, labels)."""

from fareline.functions.expressions import (  # noqa: F401
    airport_label,
    any_true,
    clamp,
    false_if_null,
    fractional_minutes,
    hour_floor,
    is_near,
    key_text,
    minute_boundaries,
    minute_index,
    months_touched,
    payment_code,
    row_key,
    safe_ratio,
    sum_filled,
    year_month,
)
