"""Parsing of numbers and exact rounding.

Table columns hold money as doubles. Sums, averages and ratios are taken over decimals and
rounded half up once, so the result does not depend on the order in which tasks add rows.
Amounts keep ten digits after the point. One that a row's decimal cannot hold (from 1e18) stays in
the table of typed rows and is rejected with a reason of its own, or added up as double where
nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,10)"
TOTAL = "decimal(38,10)"
RATE = "decimal(18,10)"


def parse_double(text: Column) -> Column:
    """Text to double; null for text that is no finite number."""
    number = text.try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def parse_int(text: Column) -> Column:
    """Text to int. A fraction is cut off ("3.0" and "3.7" give 3); other text gives null."""
    whole = F.regexp_extract(text, r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1)
    return whole.try_cast("int")


def parse(text: Column, kind: str) -> Column:
    """Text to one of the column types of ``schemas``; null where it does not parse."""
    if kind == "double":
        return parse_double(text)
    if kind == "int":
        return parse_int(text)
    if kind == "timestamp":
        return F.try_to_timestamp(text)
    if kind == "date":
        return text.try_cast("date")
    return text


def money(value: Column) -> Column:
    """An amount of a row to be added up; null where it is too large for that."""
    return value.try_cast(MONEY)


def total(value: Column) -> Column:
    """A sum of amounts to be added up again."""
    return value.try_cast(TOTAL)


def rate(value: Column) -> Column:
    return value.try_cast(RATE)


def too_large(value: Column, kind: str = MONEY) -> Column:
    """True for a number that the decimals of sums cannot hold, told without a cast: doubles next to the bound do not round to it."""
    size, digits = (int(part) for part in kind.removeprefix("decimal(").removesuffix(")").split(","))
    return F.coalesce(F.abs(value) >= F.lit(float(10 ** (size - digits))), F.lit(False))


def rounded(value: Column, digits: int) -> Column:
    """A decimal rounded half up, as double."""
    return F.round(value, digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as decimal, null when the denominator is null or 0.

    The numerator keeps 20 digits before the point, which leaves the quotient of a count at least 14 after
    it; the result types of sums would leave only 6, too few to round correctly afterwards. A larger
    numerator is divided as double.
    """
    narrow = numerator.try_cast("decimal(28,8)")
    wide = F.try_divide(numerator.cast("double"), denominator.cast("double")).try_cast("decimal(38,8)")
    return F.when(narrow.isNull(), wide).otherwise(F.try_divide(narrow, denominator))
