"""Exact money arithmetic.

Money is carried as ``decimal(18,2)``; divisions that end in ``ROUND(x, n)`` are
done on integer cents so the result is the exact rational rounded half away
from zero (what a NUMERIC engine returns), independent of float order or of
intermediate decimal scales.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cents(x) -> Column:
    """Decimal (scale ≤ 2) → bigint cents, exact."""
    return F.round(_c(x) * 100, 0).cast("bigint")


def double_cents(x) -> Column:
    """A double holding a 2-place amount → bigint cents (x·100 is never a .5 tie)."""
    return F.rint(_c(x) * 100).cast("bigint")


def from_cents(c, scale: int = 2, wide: bool = False) -> Column:
    """bigint units of 10^-scale → decimal(18, scale).

    The default multiplies by the unit (cheaper than a decimal division) and
    is meant for row-level amounts below 10^(17-scale) units; ``wide=True``
    takes any bigint.
    """
    if wide:
        return (_c(c).cast("decimal(20,0)") / F.lit(10 ** scale)).cast(f"decimal(18,{scale})")
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (_c(c).cast(f"decimal({17 - scale},0)") * unit).cast(f"decimal(18,{scale})")


def sum_money(x) -> Column:
    """Σ of an amount as ``MONEY``, added up in cents: a group's partial sum is then one bigint to
    move, where a decimal sum is a wide decimal of several words."""
    return from_cents(F.sum(cents(x)), wide=True)


def div_round(num, den) -> Column:
    """round(num / den) half away from zero for integers; NULL when den = 0."""
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    q = idiv(F.abs(n) * 2 + F.abs(d), F.abs(d) * 2)  # operands non-negative
    neg = (n < 0) != (d < 0)
    return F.when(d == 0, F.lit(None).cast("bigint")).when(neg, -q).otherwise(q)


def idiv(a, b) -> Column:
    """Integer division truncating toward zero (SQL ``a div b``)."""
    return F.call_function("div", _c(a).cast("bigint"), _c(b).cast("bigint"))


def ratio(num_cents, den_cents, scale: int = 2, times: int = 1) -> Column:
    """round(num / den * times, scale) as decimal(18, scale); NULL when den = 0.

    ``num_cents`` and ``den_cents`` are integers in the same unit.
    """
    factor = times * 10 ** scale
    return from_cents(div_round(_c(num_cents).cast("bigint") * factor, den_cents), scale, wide=True)


def pct(num_cents, den_cents, scale: int = 2) -> Column:
    """round(num / den * 100, scale)."""
    return ratio(num_cents, den_cents, scale, times=100)
