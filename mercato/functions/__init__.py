from mercato.functions.scalars import (
    cents_to_currency,
    current_timestamp_utc,
    day_diff,
    from_micros,
    micros,
    ntz,
    safe_divide,
    sum_money,
    surrogate_key,
)

__all__ = [
    "cents_to_currency",
    "current_timestamp_utc",
    "day_diff",
    "from_micros",
    "micros",
    "ntz",
    "safe_divide",
    "sum_money",
    "surrogate_key",
]
