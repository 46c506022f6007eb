"""Integrity checks. Each returns a frame: offending rows, or one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.country import is_iso3_shaped
from macrotide.schemas import TABLES, Table


def orphans(child: DataFrame, parent: DataFrame, key: str = "country_code") -> DataFrame:
    """Child rows whose key (also a null one) is not in the parent."""
    return child.join(parent.select(key), key, "left_anti")


def orphan_counts(child: DataFrame, parent: DataFrame, key: str = "country_code") -> DataFrame:
    """Number of orphaned rows per key. Rows are counted before anything is compared, so only
    one row per key and task is shuffled."""
    return orphans(child.groupBy(key).agg(F.count("*").alias("orphaned_rows")), parent, key)


def cascade_delete(child: DataFrame, remaining: DataFrame, key: str = "country_code") -> DataFrame:
    """Child rows that stay when the parent is reduced to ``remaining``."""
    return child.join(remaining.select(key), key, "left_semi")


def cascade(tables: Mapping[str, DataFrame], table: str, keys: DataFrame, key: str = "country_code") -> dict[str, DataFrame]:
    """What stays of a table and of those that refer to it when the given keys are deleted."""
    gone = keys.select(key).distinct()
    return {name: tables[name].join(gone, key, "left_anti") for name in [table, *(n for n, s in TABLES.items() if s.parent == table)] if name in tables}


def range_check(rates: DataFrame, low: float = -0.5, high: float = 5.0) -> DataFrame:
    """Extremes of the rates and whether they lie in range; null when there is no rate."""
    return rates.agg(
        F.min("inflation_rate").alias("min_rate"), F.max("inflation_rate").alias("max_rate")
    ).select(
        "min_rate", "max_rate",
        ((F.col("min_rate") >= low) & (F.col("max_rate") <= high)).alias("passed"),
    )


def recency_check(indicators: DataFrame, since: int = 2020) -> DataFrame:
    return indicators.filter(F.col("year") >= since).agg(F.count("*").alias("recent_rows")).select(
        "recent_rows", (F.col("recent_rows") > 0).alias("passed")
    )


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. As with SQL UNIQUE, keys with a null never collide."""
    return (
        df.na.drop(subset=list(key)).groupBy(*key).agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def _count_by_column(df: DataFrame, conditions: Mapping[str, Column], into: str) -> DataFrame:
    """One row per column with the number of rows its condition holds for, in one pass."""
    if not conditions:
        return df.sparkSession.createDataFrame([], f"column string, {into} long")
    one_row = df.agg(*[F.count_if(condition).alias(c) for c, condition in conditions.items()])
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias(into)) for c in conditions
    ])))


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _count_by_column(df, {c: F.col(c).isNull() for c in columns}, "null_rows")


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return _count_by_column(
        df, {c: F.char_length(F.col(c)) > n for c, n in limits.items()}, "too_long_rows"
    )


def code_violations(df: DataFrame, column: str = "country_code") -> DataFrame:
    """Codes that do not look like alpha-3 codes, with their number of rows."""
    return (
        df.filter(F.col(column).isNotNull() & ~is_iso3_shaped(F.col(column)))
        .groupBy(column).agg(F.count("*").alias("rows"))
    )


def table_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], total: str | None = None
) -> DataFrame:
    """Row count per table; a table that is not there counts 0. ``total`` names a last row
    with the sum."""
    counts = [spark.createDataFrame([], "table string, rows long")] + [
        spark.createDataFrame([(name, 0)], "table string, rows long") if table is None
        else table.agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
        for name, table in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, counts)
    if total is None:
        return rows
    return rows.unionByName(rows.agg(F.lit(total).alias("table"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))


def validate(tables: Mapping[str, DataFrame], since: int = 2020) -> DataFrame:
    """The standard checks as (check, passed); null means there was nothing to check."""
    def no_orphans(child: str) -> DataFrame:
        counts = orphan_counts(tables[child], tables["countries"])
        return counts.agg((F.count("*") == 0).alias("passed"))

    checks = {
        "no_orphaned_inflation": no_orphans("inflation_rates"),
        "no_orphaned_wage": no_orphans("wage_index"),
        "reasonable_inflation_range": range_check(tables["inflation_rates"]),
        "has_recent_data": recency_check(tables["economic_indicators"], since),
    }
    return reduce(DataFrame.unionByName, [
        frame.select(F.lit(name).alias("check"), "passed") for name, frame in checks.items()
    ])


def constraint_report(df: DataFrame, table: str) -> DataFrame:
    """Violations of the declared constraints of a table as (constraint, subject, violations)."""
    spec: Table = TABLES[table]
    present = [c for c in spec.columns if c.name in df.columns]
    rules = {("not null", c.name): F.col(c.name).isNull() for c in present if c.required}
    rules |= {
        ("length", c.name): F.char_length(F.col(c.name)) > c.max_length for c in present if c.max_length
    }
    counts = df.agg(*[F.count_if(rule).alias(f"rule_{i}") for i, rule in enumerate(rules.values())])
    by_rule = counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(constraint).alias("constraint"), F.lit(column).alias("subject"),
            F.col(f"rule_{i}").alias("violations"),
        )
        for i, (constraint, column) in enumerate(rules)
    ])))
    repeated = key_violations(df, spec.key).agg(F.count("*").alias("violations")).select(
        F.lit("unique").alias("constraint"), F.lit(", ".join(spec.key)).alias("subject"), "violations"
    )
    return repeated.unionByName(by_rule)
