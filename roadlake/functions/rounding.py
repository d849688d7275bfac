"""The two roundings in use: half up (device and geometry code) and half even (summaries)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(value: Column, digits: int = 3) -> Column:
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def half_even(value: Column, digits: int = 3) -> Column:
    """Round the exact binary value to decimals, ties to even, as IEEE-minded languages do.

    `bround` rounds the shortest decimal text of a double, so 4.45 counts as a tie there although its binary value
    lies above it. Here a tie of the scaled product is settled by the product's own rounding error, which splitting
    the factor into two halves makes exact."""
    scale = F.lit(float(10**digits))
    product = value * scale
    wide = value * F.lit(134_217_729.0)
    high = wide - (wide - value)
    error = (high * scale - product) + (value - high) * scale
    below = F.floor(product)
    part = product - below
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (below % 2 != 0))))
    return (below + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))) / scale
