"""Typed casts of delimited text, without inference and without ANSI failures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from corpusframe.functions.text import strip

_INFINITE = r"(?i)^[+-]?inf(inity)?$"
_NUMBER = r"^([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
_DECIMAL = r"^[+-]?(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?$"
_DIGITS = 19  # of the largest bigint


def _whole_digits(cell: Column) -> Column:
    """Sign and digits of a number that is whole, exact in any notation; null for fractions and other text.

    Works on the digits themselves: the exponent moves the point, and what is left behind it must be
    zeros. A whole number of too many digits keeps one digit too many, so its cast is null.
    """
    sign, before, after = (F.regexp_extract(cell, _NUMBER, i) for i in (1, 2, 3))
    # an exponent past the int range moves every digit to one side
    power = F.regexp_extract(cell, _NUMBER, 4)
    shift = F.when(power == "", 0).otherwise(F.coalesce(power.try_cast("int"), F.when(power.startswith("-"), -(1 << 30)).otherwise(1 << 30)))
    digits = F.concat(before, after)
    kept = F.length(before).cast("long") + shift  # digits before the moved point
    size = F.length(digits)
    behind = F.when(kept >= size, "").when(kept <= 0, digits).otherwise(F.substring(digits, kept.cast("int") + 1, size))
    padded = F.rpad(digits, F.least(kept, size + _DIGITS + 1).cast("int"), "0")
    front = F.ltrim(F.when(kept >= size, padded).when(kept <= 0, "0").otherwise(F.substring(digits, F.lit(1), kept.cast("int"))), F.lit("0"))
    number = F.concat(F.when(sign == "-", "-").otherwise(""), F.when(front == "", "0").otherwise(front))
    zero = F.when(F.rtrim(digits, F.lit("0")) == "", "0").otherwise(number)
    return F.when(cell.rlike(_DECIMAL) & (F.rtrim(behind, F.lit("0")) == ""), zero)


def to_int(text: Column) -> Column:
    """Whole numbers in any notation ('7', '7.0', '1e3', ' 6 '); anything else is null."""
    # plain digits, by far the most cells, take the first cast only
    return F.coalesce(text.try_cast("bigint"), _whole_digits(strip(text)).try_cast("bigint"))


def is_unfit_int(text: Column) -> Column:
    """Numbers that an int column can't hold: fractions, infinities and whole numbers out of range."""
    cell = strip(text)
    number = cell.rlike(_DECIMAL) | cell.rlike(_INFINITE)
    return F.when(text.isNull() | text.try_cast("bigint").isNotNull(), False).otherwise(number & to_int(text).isNull())


def to_float(text: Column) -> Column:
    """Decimal numbers and infinities; hexadecimal and typed literals of the JVM are no numbers here."""
    cell = strip(text)
    return F.when(cell.rlike(_DECIMAL) | cell.rlike(_INFINITE), cell.try_cast("double"))


def cast(text: Column, dtype: str) -> Column:
    """Every dtype other than int and float is text."""
    if dtype == "int":
        return to_int(text)
    if dtype == "float":
        return to_float(text)
    return text
