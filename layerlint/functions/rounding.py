"""Rounding that looks at the exact binary value of a double, in plain JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up_2(value: Column) -> Column:
    """Nearest multiple of 0.01 to the exact value of the double; a true tie goes up.

    ``round`` works on the shortest decimal text, so 5.00499999... (which prints as 5.005) becomes 5.01 there and 5.0 here.
    The double is split into two halves whose products with 200 carry no rounding error, so comparing 200 * value with
    the odd numbers around it decides the case exactly. Good for magnitudes below 2**40.
    """
    shifted = value * F.lit(134217729.0)
    high = shifted - (shifted - value)
    low = value - high
    guess = F.floor(value * 100 + 0.5).cast("double")

    def above(odd: Column) -> Column:
        return (high * 200.0 - odd) + low * 200.0

    nearest = (
        F.when(above(guess * 2 - 1) < 0, guess - 1)
        .when(above(guess * 2 + 1) >= 0, guess + 1)
        .otherwise(guess)
    )
    return nearest / 100.0


def share_exceeds(count: Column, total: Column, limit_pct: float) -> Column:
    """Whether ``count`` is more than ``limit_pct`` percent of ``total``, at two decimals; never so for an empty total."""
    pct = round_half_up_2(count.cast("double") / F.nullif(total.cast("double"), F.lit(0.0)) * 100.0)
    return F.coalesce(pct > F.lit(float(limit_pct)), F.lit(False))


def progress_percentage(value: Column) -> Column:
    """Whole-number percentage, half up."""
    return F.round(value, 0).cast("int")
