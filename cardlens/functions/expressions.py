"""Cleaning expressions. All are built-in column expressions with the same result under ANSI on and off."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the zip code of a branch that has none.
DEFAULT_ZIP = 99999


def fill_zip(zip_code: Column, default: int = DEFAULT_ZIP) -> Column:
    return F.coalesce(zip_code, F.lit(default))


def format_phone(phone: Column) -> Column:
    """``(123)456-7890``. Any length is cut at the same places; null stays null."""
    digits = phone.cast("string")
    return F.concat(
        F.lit("("), F.substring(digits, 1, 3),
        F.lit(")"), F.substring(digits, 4, 3),
        F.lit("-"), F.substr(digits, F.lit(7)),
    )


def date_key(year: Column, month: Column, day: Column) -> Column:
    """``yyyymmdd`` string from numbers or unpadded strings."""

    def padded(part: Column) -> Column:
        text = part.cast("string")
        return F.when(F.length(text) == 1, F.concat(F.lit("0"), text)).otherwise(text)

    return F.concat(year.cast("string"), padded(month), padded(day))


def cap_first(text: Column) -> Column:
    """First character in upper case, the rest as it is (``initcap`` would lower it)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def full_address(street: Column, apartment: Column) -> Column:
    """``street, apartment``; null if either is null, hence ``concat`` and not ``concat_ws``."""
    return F.concat(street, F.lit(", "), apartment.cast("string"))


def month_of(time_id: Column) -> Column:
    """Two-digit month of a ``yyyymmdd`` key."""
    return F.substring(time_id, 5, 2)


def month_name(month: Column) -> Column:
    """English month name; null for anything that is not a month."""
    number = month.try_cast("int")
    return F.when(
        number.between(1, 12), F.date_format(F.make_date(F.lit(2000), number, F.lit(1)), "MMMM")
    )
