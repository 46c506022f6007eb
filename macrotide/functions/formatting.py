"""Display texts. Keep the numeric column next to them: rounding here is half-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_text(value: Column, digits: int = 2) -> Column:
    number = value.cast("double") * 100
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f%%", number))


def money_text(value: Column, digits: int = 0, sign: str = "$") -> Column:
    return F.concat(F.lit(sign), F.format_number(value.cast("double"), digits))
