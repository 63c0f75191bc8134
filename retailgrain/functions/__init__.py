from retailgrain.functions.dates import (
    iso_week,
    report_window,
    week_label,
    week_start,
    weekend_flag,
    weekend_label,
)
from retailgrain.functions.matching import bucket, city_group, first_substring, metric_condition, shop_condition
from retailgrain.functions.numbers import (
    amount_parts,
    exact_sum,
    half_even_int,
    null_default,
    safe_ratio,
    safe_ratio_pct,
    sum_or_zero,
    total_of_parts,
    trunc_int,
)
from retailgrain.functions.text import (
    clean_text,
    fix_address_spacing,
    join_nullable,
    normalize_barcode,
    row_digest,
    str_contains,
    str_normalize,
)

__all__ = [
    "amount_parts",
    "bucket",
    "city_group",
    "clean_text",
    "exact_sum",
    "first_substring",
    "fix_address_spacing",
    "half_even_int",
    "iso_week",
    "join_nullable",
    "metric_condition",
    "normalize_barcode",
    "null_default",
    "report_window",
    "row_digest",
    "safe_ratio",
    "safe_ratio_pct",
    "shop_condition",
    "str_contains",
    "str_normalize",
    "sum_or_zero",
    "total_of_parts",
    "trunc_int",
    "week_label",
    "week_start",
    "weekend_flag",
    "weekend_label",
]
