"""Column expressions that clean user and business profile fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starblend.functions.numbers import _col, clamp, safe_int

# Fixed values.
PRICE_KEY = "RestaurantsPriceRange2"
REF_YEAR = 2025
COMPLIMENTS = [
    "compliment_hot",
    "compliment_more",
    "compliment_profile",
    "compliment_cute",
    "compliment_list",
    "compliment_note",
    "compliment_plain",
    "compliment_cool",
    "compliment_funny",
    "compliment_writer",
    "compliment_photos",
]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def parse_year(c) -> Column:
    """The whole number before the first ``-``; 0 where there is none."""
    head = strip(F.split_part(_col(c), F.lit("-"), F.lit(1)))
    return F.coalesce(head.try_cast("int"), F.lit(0))


def account_age(c, ref_year: int = REF_YEAR) -> Column:
    """Years since joining; a missing date counts from year 0."""
    return F.greatest(F.lit(0), F.lit(ref_year) - parse_year(c))


def parse_list(c) -> Column:
    """Comma-separated text to its trimmed, non-blank parts; NULL gives an empty array."""
    parts = F.transform(F.split(_col(c), ","), strip)
    return F.coalesce(F.filter(parts, lambda x: x != ""), F.array().cast("array<string>"))


def elite_len(c) -> Column:
    """Number of elite years; NULL and the text ``None`` count 0."""
    c = _col(c)
    return F.when(c.isNull() | (c == "None"), F.lit(0)).otherwise(F.size(parse_list(c)))


def parse_price(attributes) -> Column:
    """Price level 0..4 from an attribute map, 2 where it is missing or unreadable."""
    raw = F.try_element_at(_col(attributes), F.lit(PRICE_KEY))
    return clamp(safe_int(raw, 2), 0, 4).cast("bigint")


def norm_city(c) -> Column:
    return F.lower(strip(F.coalesce(_col(c), F.lit(""))))


def norm_state(c) -> Column:
    return F.upper(strip(F.coalesce(_col(c), F.lit(""))))


def open_flag(hours, day: str) -> Column:
    """1.0 where ``hours`` has an entry for ``day`` that is not blank and not ``None``."""
    value = F.try_element_at(_col(hours), F.lit(day))
    return F.when(value.isNull() | value.isin("", "None"), F.lit(0.0)).otherwise(F.lit(1.0))


def open_flags(hours) -> list[Column]:
    return [open_flag(hours, day).alias(f"b_open_{day[:3]}") for day in DAYS]


def map_sum(c) -> Column:
    """Sum of a map's values; a missing map counts 0."""
    values = F.coalesce(F.map_values(_col(c)), F.array().cast("array<bigint>"))
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(x, F.lit(0)))


def compliments() -> Column:
    """The eleven compliment counters as one array, in their fixed order."""
    return F.array(*[safe_int(name) for name in COMPLIMENTS])


def compliment_sum(vector) -> Column:
    return F.aggregate(_col(vector), F.lit(0).cast("bigint"), lambda acc, x: acc + x)
