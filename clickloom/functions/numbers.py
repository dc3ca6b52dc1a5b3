"""Guarded arithmetic and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_or_zero(part: Column, whole: Column) -> Column:
    """``part`` per ``whole`` in percent, two decimals, 0 for an empty whole."""
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """NULL for an empty whole, as in SQL."""
    return part / F.nullif(whole, F.lit(0))


def settled(amount: Column) -> Column:
    """A sum of doubles freed from the trace its summation order leaves in the last bits.

    Rankings compare these, so equal amounts tie whatever the partitioning was.
    """
    return F.round(amount, 6)


def dollars(amount: Column, grouped: bool = False) -> Column:
    return F.format_string("$%,.2f" if grouped else "$%.2f", amount)


def percent_text(value: Column) -> Column:
    return F.format_string("%.2f%%", value)
