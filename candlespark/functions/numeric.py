"""Null-safe arithmetic under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    """Text to double, bad text to null."""
    return text.try_cast("double")


def safe_ln(x: Column) -> Column:
    """Natural logarithm; null where it is undefined."""
    return F.when(x > 0, F.ln(x))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)
