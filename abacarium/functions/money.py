"""Money is decimal while it is added up and double only where it leaves a report.

Float sums depend on the order of the rows, so two runs on a cluster can differ.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


# sum_whole adds up the bits above and below this one apart.
_LOW_BITS = 20


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def amount(value: Column | str, precision: int = 12) -> Column:
    """``value`` as money with two decimals."""
    return _col(value).cast(f"decimal({precision},2)")


def cents(value: Column | str) -> Column:
    """A double amount in whole cents.

    Casting a double to a decimal goes through its text; rounding to a whole
    number is several times as fast, and whole numbers add up without error.
    """
    return F.rint(_col(value) * 100).cast("long")


def from_cents(value: Column | str, precision: int = 12) -> Column:
    """Whole cents as money with two decimals."""
    return (_col(value).cast("decimal(20,0)") * _unit(2)).cast(f"decimal({precision},2)")


def sum_whole(value: Column | str, digits: int = 2) -> Column:
    """The exact sum of whole numbers that count units of ``10**-digits``, as a decimal.

    High and low bits are added up as longs, which stays fast and cannot overflow
    before 8 * 10**12 rows; a plain sum of longs could, on a table of that size.
    """
    value = _col(value)
    high = F.sum(F.shiftright(value, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(value.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(19,0)")
    total = high * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + low
    return (total * _unit(digits)).cast(f"decimal({26 + digits},{digits})")


def round_whole(value: Column | str, by: int) -> Column:
    """``value / by`` as a whole number, rounded half away from zero."""
    value = _col(value)
    up = F.call_function("div", value + by // 2, F.lit(by))
    down = F.call_function("div", value - by // 2, F.lit(by))
    return F.when(value >= 0, up).otherwise(down)


def _unit(digits: int) -> Column:
    return F.lit(Decimal(1).scaleb(-digits))


def to_double(value: Column | str, digits: int | None = 2) -> Column:
    """A decimal result for output, rounded half away from zero."""
    value = _col(value)
    return (value if digits is None else F.round(value, digits)).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """One IEEE division; NULL for a zero denominator instead of an ANSI error."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(numerator: Column | str, denominator: Column | str) -> Column:
    """``100 * numerator / denominator`` in that order of operations."""
    return F.try_divide(F.lit(100.0) * _col(numerator).cast("double"), _col(denominator).cast("double"))


def round_half_even(value: Column | str, digits: int = 2) -> Column:
    """Banker's rounding, as Python's ``round`` does it."""
    return F.bround(_col(value), digits)


def rounded_ratio(numerator: Column | str, denominator: Column | str, times: int = 1, digits: int = 2) -> Column:
    """``times * numerator / denominator`` rounded half away from zero, exactly.

    A decimal quotient is cut before it can be rounded, and a double quotient may
    fall on the wrong side of a tie; whole-number division does neither. The
    arguments may have up to four decimals. NULL for a zero denominator.
    """
    n = (_col(numerator).cast("decimal(30,4)") * 10_000).cast("decimal(34,0)")
    d = F.nullif((_col(denominator).cast("decimal(30,4)") * 10_000).cast("decimal(34,0)"), F.lit(0).cast("decimal(34,0)"))
    doubled = F.abs(n) * F.lit(2 * times * 10**digits) + F.abs(d)
    quotient = F.call_function("div", doubled, F.lit(2) * F.abs(d))
    signed = F.when((n < 0) != (d < 0), -quotient).otherwise(quotient)
    return signed.cast("decimal(20,0)") * _unit(digits)


def whole_ratio(numerator: Column | str, denominator: Column | str, times: int = 1, digits: int = 2) -> Column:
    """:func:`rounded_ratio` of two whole numbers below 10**13, without decimals in between."""
    n, d = _col(numerator), F.nullif(_col(denominator), F.lit(0).cast("long"))
    quotient = F.call_function("div", F.abs(n) * (2 * times * 10**digits) + F.abs(d), 2 * F.abs(d))
    return F.when((n < 0) != (d < 0), -quotient).otherwise(quotient).cast("decimal(20,0)") * _unit(digits)


def mean(total: Column | str, count: Column | str, digits: int = 2) -> Column:
    """``ROUND(AVG(x), digits)`` from the sum and the count."""
    return rounded_ratio(total, count, 1, digits)


def percentage(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """``ROUND(100 * a / b, digits)``."""
    return rounded_ratio(numerator, denominator, 100, digits)
