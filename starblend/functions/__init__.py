from starblend.functions.numbers import (
    clamp,
    dot,
    fix_width,
    pair_key,
    safe_float,
    safe_int,
    signed_power,
    three_decimals,
    winsorise,
)
from starblend.functions.profiles import (
    account_age,
    compliment_sum,
    compliments,
    elite_len,
    map_sum,
    norm_city,
    norm_state,
    open_flag,
    open_flags,
    parse_list,
    parse_price,
    parse_year,
)

__all__ = [
    "account_age",
    "clamp",
    "compliment_sum",
    "compliments",
    "dot",
    "elite_len",
    "fix_width",
    "map_sum",
    "norm_city",
    "norm_state",
    "open_flag",
    "open_flags",
    "pair_key",
    "parse_list",
    "parse_price",
    "parse_year",
    "safe_float",
    "safe_int",
    "signed_power",
    "three_decimals",
    "winsorise",
]
