"""Numeric column expressions; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c, low: float = 1.0, high: float = 5.0) -> Column:
    """Clip to [low, high]; NULL stays NULL."""
    c = _col(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def winsorise(c, cap: float) -> Column:
    return clamp(c, -cap, cap)


def signed_power(c, alpha: float) -> Column:
    c = _col(c)
    return F.signum(c) * F.pow(F.abs(c), F.lit(float(alpha)))


def pair_key(a, b) -> tuple[Column, Column]:
    """The two ids of an unordered pair, smaller first."""
    return F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b))


def safe_float(c, default: float = 0.0) -> Column:
    """Text to double, else ``default``; ``nan`` and ``inf`` are numbers and pass.

    Underscores between digits are allowed; Java's ``1d`` and ``1f`` forms are not numbers here.
    """
    c = _col(c).cast("string")
    plain = F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")
    number = F.when(~c.rlike(r"[0-9.][dDfF]\s*$"), plain.try_cast("double"))
    return F.coalesce(number, F.lit(float(default)))


def safe_int(c, default: int = 0) -> Column:
    """Text to bigint; fractions are cut towards zero; anything else gives ``default``.

    Plain whole numbers, nearly all of them, are settled by the first cast.
    """
    number = safe_float(c, float("nan")).try_cast("bigint")
    return F.coalesce(_col(c).try_cast("bigint"), number, F.lit(default).cast("bigint"))


def fix_width(c, width: int) -> Column:
    """An array of doubles cut or zero-padded to ``width``."""
    padded = F.concat(F.coalesce(_col(c), F.array().cast("array<double>")),
                      F.array_repeat(F.lit(0.0), width))
    return F.slice(padded, 1, width)


def dot(a, b) -> Column:
    """Inner product of two numeric arrays of the same length."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def three_decimals(c) -> Column:
    """Three-decimal text of a score in [0, 8), rounded on its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal form half up, which shifts some last digits.  A
    double below 8 times 2**52 is a whole number, so the rounding is done on integers here.
    """
    scaled = (_col(c) * F.lit(float(2**52))).cast("bigint") * F.lit(125)
    whole = F.shiftright(scaled, 49)
    rest = scaled.bitwiseAND(F.lit(2**49 - 1))
    half = F.lit(2**48)
    up = (rest > half) | ((rest == half) & (whole.bitwiseAND(F.lit(1)) == 1))
    thousandths = whole + F.when(up, 1).otherwise(0)
    return F.concat(
        F.floor(thousandths / 1000).cast("string"),
        F.lit("."),
        F.lpad((thousandths % 1000).cast("string"), 3, "0"),
    )
