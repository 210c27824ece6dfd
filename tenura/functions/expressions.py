"""Column expressions shared by the operators. Everything here stays inside the JVM."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

# The texts a delimited scan reads as missing (pandas' documented defaults).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)



def _poisson_one_cdf() -> tuple[float, ...]:
    """P(X <= k) of Poisson(1) for k = 0, 1, ... as long as a term still changes the sum."""
    total, term, table = 0.0, math.exp(-1.0), []
    while total + term > total:
        total += term
        table.append(total)
        term /= len(table)
    return tuple(table)


POISSON_ONE_CDF = _poisson_one_cdf()

# Coefficients of the Chebyshev fit of erfc (Numerical Recipes), constant term first.
ERFC_FIT = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TOKENS), text)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def decimal_comma(text: Column) -> Column:
    """Decimal-comma text to DOUBLE; text that is no number becomes NULL."""
    return nan_to_null(F.replace(text, F.lit(","), F.lit(".")).try_cast("double"))


def safe_div(numerator: Column, denominator: Column, default: float | None = 0.0) -> Column:
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if default is None else F.coalesce(quotient, F.lit(float(default)))


def clean_category(text: Column, missing: str | None = None) -> Column:
    """Trimmed upper-case category; NULL survives unless ``missing`` names a category for it."""
    cleaned = F.upper(F.trim(text.cast("string")))
    return cleaned if missing is None else F.coalesce(cleaned, F.lit(missing))


def upper_clip(value: Column, limit: float) -> Column:
    """Clip from above without turning NULL into the limit (``least`` would)."""
    return F.when(value > limit, F.lit(float(limit))).otherwise(value)


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0, relative error about 1e-7."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    inner = F.lit(ERFC_FIT[-1])
    for coefficient in reversed(ERFC_FIT[1:-1]):
        inner = F.lit(coefficient) + t * inner
    return t * F.exp(-x * x + F.lit(ERFC_FIT[0]) + t * inner)


def chi2_tail_1df(statistic: Column) -> Column:
    return erfc(F.sqrt(statistic / F.lit(2.0)))


def normal_two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), erfc(F.abs(z) / F.sqrt(F.lit(2.0))))


def hash32(*parts: Column | str) -> Column:
    """First eight hex digits of md5 over the ``:``-joined parts, as BIGINT in [0, 2^32)."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 8), 16, 10).cast("bigint")


def hash60(*parts: Column | str) -> Column:
    """First fifteen hex digits of md5 over the ``:``-joined parts, as BIGINT in [0, 2^60)."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *columns)), 1, 15), 16, 10).cast("bigint")


def count_edges(value: Column, edges: tuple[float, ...], *, inclusive: bool) -> Column:
    """How many of a few fixed edges lie below ``value`` (or at it, when inclusive)."""
    hits = [((value >= e) if inclusive else (value > e)).cast("int") for e in edges]
    return reduce(lambda a, b: a + b, hits)


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("ns")


def missing_severity(percent: Column) -> Column:
    return F.when(percent > 50, "drop").when(percent > 20, "flag").otherwise("keep")


def rate_side(rate: Column, reference: Column) -> Column:
    return F.when(rate > reference, "above").otherwise("below")


def discrimination_band(auc: Column) -> Column:
    return F.when(auc >= 0.78, "strong").when(auc >= 0.72, "good").otherwise("moderate")


def driver_direction(value: Column) -> Column:
    return F.when(value > 0, "increases_churn").otherwise("decreases_churn")


def overfit_flag(gap: Column) -> Column:
    return gap > 0.05


def calibration_note(ece: Column) -> Column:
    return F.when(ece > 0.05, "recalibrate on validation data").otherwise("calibration ok")


def signed_thousandths(value: Column) -> Column:
    """``+0.123`` text rounded on the exact binary value, as C and Python print it.

    Java rounds the shortest decimal text instead, which differs where the fourth digit is a 5.
    The product with 2000 is exact after splitting off the low bits, so the sign of its rounding
    error tells on which side of the tie the value lies.
    """
    size = F.abs(value)
    product = size * F.lit(2000.0)
    carried = size * F.lit(134217729.0)  # 2^27 + 1 splits a double into two halves
    high = carried - (carried - size)
    error = (high * F.lit(2000.0) - product) + (size - high) * F.lit(2000.0)
    below = F.floor(product / F.lit(2.0))
    up = F.when(error == 0, below % 2 == 1).otherwise(error > 0)
    at_tie = product % 2.0 == 1.0
    units = F.when(at_tie, below + up.cast("bigint")).otherwise(F.floor(size * F.lit(1000.0) + F.lit(0.5)))
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.format_string("%s%d.%03d", sign, F.floor(units / F.lit(1000.0)), units % 1000)


def driver_label(feature: Column, value: Column) -> Column:
    return F.concat(feature, F.lit(" ("), signed_thousandths(value), F.lit(")"))
