"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ROUND_DIGITS


def round2(c: Column) -> Column:
    """Half-up rounding to two decimals, as Spark's `round`."""
    return F.round(c, ROUND_DIGITS)


def nan_to_null(c: Column) -> Column:
    """NaN -> null (decision D5); other values pass through."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is 0 or null (no ANSI divide-by-zero)."""
    return F.try_divide(num, den.cast("double"))
