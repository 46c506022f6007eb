"""Column selection by name, aliases, long to wide and wide to long."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_COLUMNS = ("Date", "date", "Month", "month", "Period", "period")


def select_typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, whatever their order in ``df``; absent ones are null.
    Text that does not fit the type becomes null."""
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])


def available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def unify_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give each target column the first of its source columns that has a value."""
    sources = {t: [n for n in names if n in df.columns] for t, names in aliases.items()}
    used = {n for names in sources.values() for n in names}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in used]
    unified = [
        F.coalesce(*[F.col(n) for n in names]).alias(target) for target, names in sources.items() if names
    ]
    return df.select(*kept, *unified)


def long_to_wide(
    df: DataFrame, keys: Sequence[str], names: str, mapping: Mapping[object, str],
    cell: Callable[[Column], Column], value: str,
) -> DataFrame:
    """One column per entry of ``mapping`` (value of ``names`` -> column name).

    Written as one conditional aggregation: a single shuffle on ``keys`` after map-side
    combining, where ``pivot`` would shuffle twice.
    """
    cells = [
        cell(F.when(F.col(names) == F.lit(source), F.col(value))).alias(target)
        for source, target in mapping.items()
    ]
    return df.groupBy(*keys).agg(*cells)


def date_column(df: DataFrame) -> str:
    return next((c for c in DATE_COLUMNS if c in df.columns), df.columns[0])


def union_feeds(feeds: Sequence[DataFrame | None], schema: T.StructType, spark) -> DataFrame:
    """All rows of the feeds that could be read; no feed gives an empty frame."""
    present = [f for f in feeds if f is not None]
    if not present:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)
