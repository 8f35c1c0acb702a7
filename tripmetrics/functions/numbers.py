"""Number parsing and arithmetic as column expressions that never fail a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: ColumnOrName) -> Column:
    """Any value as double; text that is not a number becomes null."""
    return col(c).try_cast("double")


def text(c: ColumnOrName) -> Column:
    return col(c).cast("string")


_INFINITY = float("inf")


def present(c: ColumnOrName) -> Column:
    """A finite number. NaN sorts above infinity, so the bound leaves it out too."""
    return col(c).isNotNull() & (F.abs(col(c)) < F.lit(_INFINITY))


def number_or_null(c: ColumnOrName) -> Column:
    """The number itself, NaN and infinities as null."""
    return F.when(F.abs(col(c)) < F.lit(_INFINITY), col(c))


def positive(c: ColumnOrName) -> Column:
    """Above zero and finite; NaN, which sorts above infinity, is left out."""
    return (col(c) > F.lit(0.0)) & (col(c) < F.lit(_INFINITY))


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(col(a), col(b))


def ratio_or_zero(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b when b is above zero, else 0.0."""
    return F.when(positive(b), ratio(a, b)).otherwise(F.lit(0.0))


def minutes(seconds: ColumnOrName) -> Column:
    return col(seconds) / F.lit(60.0)


def rounded(c: ColumnOrName, digits: int) -> Column:
    """Half-up rounding for reports."""
    return F.round(col(c), digits)


def plain_number(c: ColumnOrName) -> Column:
    """A double as the shortest text with at least one decimal: 12345678.0, 0.0004, 2.3e-08, 1e+24.

    Plain digits from 1e-4 up to below 1e16, an exponent of at least two digits beyond.
    """
    c = col(c)
    digits = F.regexp_replace(c.try_cast("decimal(38,21)").cast("string"), r"0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    short = F.regexp_replace(c.cast("string"), r"\.0E", "E")
    signed = F.regexp_replace(F.regexp_replace(short, r"E(\d)", "E+$1"), r"E([+-])(\d)$", "E$10$2")
    size = F.abs(c)
    within = ((size >= F.lit(1e-4)) & (size < F.lit(1e16))) | (c == F.lit(0.0))
    return F.when(within, plain).otherwise(F.regexp_replace(signed, "E", "e"))
