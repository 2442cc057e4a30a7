"""Null-safe arithmetic and lenient number parsing, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def finite_or_null(c) -> Column:
    """NaN and +/-inf become null: the one missing-value model used downstream."""
    c = as_col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)  # NaN is above every number


def safe_div(numerator, denominator) -> Column:
    """``a / b`` that yields null (never inf, never an ANSI error) on a zero or null divisor."""
    return F.try_divide(as_col(numerator), as_col(denominator))


def ratio_minus_one(numerator, denominator) -> Column:
    """``a / b - 1`` with the null-on-zero rule of :func:`safe_div`."""
    return safe_div(numerator, denominator) - F.lit(1.0)


#: Decimal number text, a line break behind it; leaves out what a JVM also reads (``12d``, ``0x1p3``).
_NUMBER = r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)(?:\r\n|[\r\n])?\z"


def number_in(c) -> Column:
    """The number that :func:`clean_numeric` reads, infinite where the text's is too large.
    Every step uses the one before it once, so the text is gone through once for each row
    and the code of many columns stays small enough to be compiled."""
    text = as_col(c).cast("string")
    for old, new in ((",", "."), (" ", ""), ("\u00a0", "")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_extract(text, _NUMBER, 1).try_cast("double")  # other text: '', which is no number


def clean_numeric(c) -> Column:
    """Parse number text written with a decimal comma, blanks or no-break spaces.

    ``'1,5'`` and ``' 1.5 '`` give 1.5; text that is still not a number after
    the comma is read as a point (``'1.234,5'``), ``'nan'``, ``'None'``, type suffixes
    and the empty string give null; non-finite results give null.
    """
    return finite_or_null(number_in(c))


def half_even(c, digits: int) -> Column:
    """Banker's rounding as numpy/pandas ``round`` does it: ``rint(x * 10^d) / 10^d``
    (a negative value that rounds to zero keeps its sign, as ``rint`` does)."""
    scale = float(10 ** digits)
    y = as_col(c) * F.lit(scale)
    return F.signum(y) * F.bround(F.abs(y), 0) / F.lit(scale)
