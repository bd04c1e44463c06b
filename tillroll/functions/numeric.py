"""Rounding, guarded ratios and means with the exact semantics the result tables need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back: 0.125 -> 0.12 (NumPy's rule)."""
    if digits == 0:
        return F.rint(x)
    scale = float(10 ** digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def ratio_or(num: Column, den: Column, default: float) -> Column:
    """num/den where den is positive, otherwise ``default`` (also for a NULL den)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(default))


def mean(x: Column) -> Column:
    """Mean as one division of exact totals: decimals and integers give the same bits in any order."""
    return F.sum(x).cast("double") / F.count(x)


def cents(x: Column) -> Column:
    """A value already rounded to cents, as an exact decimal for order-free totals."""
    return x.cast("decimal(18,2)")


def hash_mod_sql(key: str, modulus: int, seed: int = 0) -> str:
    """SQL for a reproducible pseudo-random integer in [0, modulus) from key arithmetic.

    A seed changes the multiplier, so draws with different seeds are unrelated; the prime keeps all
    bits of the product in play, and the reduced key keeps the product within a BIGINT.
    """
    multiplier = (2654435761 + seed * 97003657) % 4294967296 | 1
    return f"(pmod({key}, 2147483648L) * {multiplier}L % 4294967291L % {modulus}L)"


def hash_mod(key: str, modulus: int, seed: int = 0) -> Column:
    return F.expr(hash_mod_sql(key, modulus, seed))
