"""Checks on user-given parameters, so that a typing slip fails here and not as an empty report."""

from __future__ import annotations


def _digits(value: int | str, what: str, least: int, most: int) -> str:
    text = str(value).strip()
    if not (text.isascii() and text.isdigit() and least <= len(text) <= most):
        raise ValueError(f"{what} must be {least} to {most} digits, not {value!r}")
    return text


def parse_zip(value: int | str) -> int:
    """Zip code as the integer the tables hold: ``"07501"`` and ``7501`` are the same."""
    return int(_digits(value, "zip code", 1, 9))


def parse_ssn(value: int | str) -> int:
    return int(_digits(value, "SSN", 1, 9))


def parse_month(year: int | str, month: int | str) -> str:
    """``yyyymm`` from a four-digit year and a month of one or two digits."""
    yyyy = _digits(year, "year", 4, 4)
    mm = _digits(month, "month", 1, 2).zfill(2)
    if not 1 <= int(mm) <= 12:
        raise ValueError(f"month must be between 1 and 12, not {month!r}")
    return yyyy + mm


def parse_date_bound(value: int | str) -> str:
    """A ``yyyymmdd`` key, or a shorter prefix of one."""
    return _digits(value, "date", 4, 8)


def parse_card(value: int | str) -> str:
    text = str(value).strip()
    if not text:
        raise ValueError("card number is empty")
    return text


def parse_top(k: int) -> int:
    if isinstance(k, bool) or not isinstance(k, int) or k < 1:
        raise ValueError(f"top-k needs a positive whole number, not {k!r}")
    return k
