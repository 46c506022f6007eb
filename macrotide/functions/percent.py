"""The two percent rules. They differ on purpose and the full job applies both, in order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from macrotide.functions.parsing import nan_to_null


def normalize_percentage(value: Column, current_format: str = "auto") -> Column:
    """Feed rule. 'auto' divides when the magnitude is above 10, 'percentage' always,
    any other format never."""
    number = nan_to_null(value.try_cast("double"))
    if current_format == "auto":
        return F.when(F.abs(number) > 10, number / 100.0).otherwise(number)
    if current_format == "percentage":
        return number / 100.0
    return number


def load_time_rate(value: Column) -> Column:
    """Load rule: divide only what lies above 1, so negative values stay as they are."""
    return F.when(value > 1, value / 100.0).otherwise(value)
