"""Exact elapsed-time arithmetic.

Elapsed time is kept as integer microseconds and divided once at the end, so
results do not depend on summation order or on floating Julian-day values.
Rounding of such ratios is done in integer arithmetic (half away from zero,
as SQLite's ``round``), never by rounding a double.
"""

from __future__ import annotations

from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def elapsed_micros(start: str | F.Column, end: str | F.Column) -> F.Column:
    """end - start in microseconds (timestamps without zone: no DST effects)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MICROSECOND", s, e)


def rounded_ratio(num: F.Column, den: int | F.Column, digits: int) -> F.Column:
    """round(num / den, digits) computed exactly on integers, as a double.

    ``num`` and ``den`` are integral (den > 0); half-way cases round away from zero.
    """
    scale = 10 ** digits
    d = den if isinstance(den, F.Column) else F.lit(int(den))
    n = num.cast("decimal(38,0)") * F.lit(scale)
    x, y = F.abs(n) * 2 + d, (d * 2).cast("decimal(38,0)")
    q = ((x - F.pmod(x, y)) / y).cast("decimal(38,0)")
    signed = F.when(n < 0, -q).otherwise(q)
    return (signed.cast("double") / F.lit(float(scale)))


def cents(amount: str | F.Column) -> F.Column:
    """Money amount to integer cents, rounded half away from zero (SQLite ``round``).

    Plain arithmetic (sign, floor, abs) keeps the expression inside generated
    code; ``round`` on a double goes through a BigDecimal per row.
    """
    x = (F.col(amount) if isinstance(amount, str) else amount) * F.lit(100.0)
    return (F.signum(x) * F.floor(F.abs(x) + F.lit(0.5))).cast("bigint")


def year_month(ts: str | F.Column) -> F.Column:
    """``yyyy-MM`` text of a date or timestamp (years 1000..9999), without a formatter."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.year(c).cast("string"), F.lit("-"), F.lpad(F.month(c).cast("string"), 2, "0"))


def hours(micros: F.Column) -> F.Column:
    """Exact hours as one double division."""
    return micros.cast("double") / F.lit(float(MICROS_PER_HOUR))


def days(micros: F.Column) -> F.Column:
    return micros.cast("double") / F.lit(float(MICROS_PER_DAY))
