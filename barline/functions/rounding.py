"""Rounding that agrees bit for bit across engines."""

from pyspark.sql import Column, functions as F


def round_half_up(x: Column, digits: int) -> Column:
    """Floor-based rounding in doubles.

    ``round`` goes through decimals and differs between engines on near ties;
    this form is plain IEEE arithmetic.
    """
    scale = float(10**digits)
    return F.floor(x.cast("double") * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def round_half_away(x: Column, digits: int) -> Column:
    """The same with ties away from zero, for signed values."""
    # Adding 0.0 turns a negative zero into zero.
    return F.signum(x) * round_half_up(F.abs(x), digits) + F.lit(0.0)
