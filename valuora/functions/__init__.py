from valuora.functions.num import (  # noqa: F401
    INF,
    clean_inf,
    false_if_null,
    ieee_div,
    nan_to_null,
    null_if_zero,
    null_first_min,
    positive_or_null,
    round2,
    round_dp,
)
