"""Numeric scalar helpers (built-in expressions only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column, digits: int = 2) -> Column:
    """numpy ``around``: scale, round half to even, unscale.

    This is exactly what pandas ``Series.round(n)`` computes on doubles, and it
    is reproducible in SQL engines (``round_even(x * 10^n, 0) / 10^n``).
    """
    scale = float(10 ** digits)
    return F.rint(c * scale) / scale


def round_money(c: Column) -> Column:
    return round_half_even(c, 2)


def round_half_up(c: Column, digits: int = 2) -> Column:
    """Half away from zero on the scaled double (SQL ``round(x*10^n)/10^n``)."""
    scale = float(10 ** digits)
    return F.round(c * scale, 0) / scale


def clip(c: Column, lo: Column, hi: Column) -> Column:
    return F.least(F.greatest(c, lo), hi)


def money_sum(c: Column) -> Column:
    """Exact sum of 2-dp money: add as DECIMAL, hand back a double."""
    return F.sum(c.cast("decimal(18,2)")).cast("double")


def non_negative(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)
