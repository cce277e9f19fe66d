"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(num * 1.0 / den, digits)`` as a double, null when ``den`` is 0 or null.

    Scaling, rounding to an integer and scaling back rounds the double the way
    DuckDB's ``round(double, n)`` does; Spark's ``round(x, n)`` rounds the
    decimal expansion instead and differs on a few ties.
    """
    ratio = F.try_divide(num.cast("double"), den.cast("double"))
    scale = float(10 ** digits)
    return F.round(ratio * scale) / scale
