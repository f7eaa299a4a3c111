from marketlens.functions.expr import (  # noqa: F401
    floor_days, mean, money, money_even, month_diff, month_label, month_label_diff,
    month_start, pct, safe_div, to_flag,
)
