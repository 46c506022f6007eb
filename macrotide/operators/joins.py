"""Join to a side that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", spread: int = 1
) -> DataFrame:
    """Rows of ``left`` with the columns of ``right``, which is unique on the key.

    One key may hold a large share of ``left``. Adaptive execution splits its partition where
    both sides come straight from a shuffle, and broadcasts a small ``right``. Where another
    operator needs the rows by key right after the join, it cannot; ``spread`` above 1 then
    tells the rows of a key apart by a hash of their content and repeats ``right`` so often.
    """
    if spread == 1:
        return left.join(right, list(on), how)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(spread)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    salted = left.withColumn("__salt", salt).join(
        right.withColumn("__salt", copies), [*on, "__salt"], how
    )
    return salted.drop("__salt")
