"""Exact money totals over DOUBLE columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Values are split into millionths (below 1), and units in limbs of this many bits, so that 10^12 rows of a
# limb stay inside a long.
_BITS = 20
# Whole numbers from here on no longer fit three limbs.
_RANGE = 2.0**60
# The limbs, and what one of each is worth.
_WORTH = {"high": 1 << 2 * _BITS, "middle": 1 << _BITS, "low": 1, "millionths": Decimal("0.000001")}
# The columns of a stored partial total; see ``money_limbs``.
LIMBS = (*_WORTH, "odd")


def money_limbs(value: Column) -> dict[str, Column]:
    """Aggregates that together hold ``SUM(value)`` exactly, and can be added up again: see ``money_of_limbs``.

    ``odd`` is the sum of NaN and infinities, null without any. The value is tested once; its parts
    are cut from one whole number by shifts, the sign in the highest of them.
    """
    size = F.abs(value)
    finite = size < float("inf")  # false for NaN, which is larger than any number
    beyond = F.raise_error(F.concat(F.lit("money out of range: "), value.cast("string"))).cast("double")
    kept = F.when(size < _RANGE, value).when(finite, beyond)
    whole = F.floor(F.abs(kept))
    # Adding the half before cutting would change the units of a value that has no millionths left.
    millionths = F.floor((F.abs(kept) - whole) * 1e6 + 0.5)
    sign = F.when(kept < 0, -1).otherwise(1)
    units = sign * whole
    limbs = {
        "high": F.shiftright(units, 2 * _BITS),
        "middle": F.shiftright(units, _BITS).bitwiseAND((1 << _BITS) - 1),
        "low": units.bitwiseAND((1 << _BITS) - 1),
        "millionths": sign * millionths,
    }
    return {name: F.sum(limb) for name, limb in limbs.items()} | {"odd": F.sum(F.when(~finite, value))}


def merged_limbs(prefix: str = "") -> dict[str, Column]:
    """Aggregates that add up stored ``money_limbs``."""
    sums = {name: F.sum(F.col(prefix + name).cast("decimal(28,0)")) for name in _WORTH}
    return sums | {"odd": F.sum(prefix + "odd")}


def _total(limbs: dict[str, Column]) -> Column:
    worth = (
        (limbs[name].cast("decimal(38,0)") * F.lit(Decimal(one))).cast("decimal(38,6)") for name, one in _WORTH.items()
    )
    return sum(worth, F.lit(Decimal(0)).cast("decimal(38,6)")).cast("decimal(38,6)")


def money_of_limbs(limbs: dict[str, Column]) -> Column:
    """``ROUND(SUM(value), 2)`` as a DOUBLE from ``money_limbs`` or ``merged_limbs``."""
    return F.when(limbs["odd"].isNull(), F.round(_total(limbs), 2).cast("double")).otherwise(limbs["odd"])


def money_total(value: Column) -> Column:
    """``SUM(value)`` to the millionth as a DECIMAL(38,6), whatever the order of the rows.

    One rule holds for every finite value below 2^60 (about 1.15e18) in size: it counts to the nearest
    millionth, halves away from zero. Its parts are summed as longs, which stay inside generated code, and
    put together once per group; up to 10^12 rows a group no part can overflow. A finite value beyond that
    range is an error. Nulls, NaN and infinities are passed over here; see ``money_sum``.
    """
    return _total(money_limbs(value))


def money_sum(value: Column) -> Column:
    """``ROUND(SUM(value), 2)`` as a DOUBLE, exact to the cent before it becomes one; see ``money_total``.

    With a NaN, or infinities of both signs, the sum is NaN; with an infinity it is that infinity.
    """
    return money_of_limbs(money_limbs(value))
