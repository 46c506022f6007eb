"""Standing views over the indicator table and the documented questions asked of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from macrotide.functions.bands import wage_inflation_relationship


def rank_latest(df: DataFrame, entity: str, order: str, into: str) -> DataFrame:
    """SQL ``rank()`` of each row within ``entity`` by ``order`` descending.

    A window over the rows would sort all rows of one entity in one task. Here rows are
    counted per (entity, order) first, the window runs over those counts, and the ranks are
    joined back, so a dominant entity is spread like any other.
    Rows without ``order`` come last, as in SQL.
    """
    counts = df.groupBy(entity, order).agg(F.count("*").alias("__n"))
    later = Window.partitionBy(entity).orderBy(F.desc(order)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = counts.select(
        F.col(entity).alias("__entity"),
        F.col(order).alias("__order"),
        (F.coalesce(F.sum("__n").over(later), F.lit(0)) + 1).alias(into),
    )
    same = F.col(entity).eqNullSafe(F.col("__entity")) & F.col(order).eqNullSafe(F.col("__order"))
    return df.join(ranks, same).select(*df.columns, into)


def latest_economic_data(
    indicators: DataFrame, since: int = 2020, latest_only: bool = False
) -> DataFrame:
    """Rows from ``since`` on with their recency rank per country, or only the first rank."""
    recent = indicators.filter(F.col("year") >= since).select(
        "country_code", "country_name", "year", "inflation_rate", "inflation_category",
        "avg_annual_wage", "real_wage_adjusted", "economic_health_score",
    )
    ranked = rank_latest(recent, "country_code", "year", "year_rank")
    return ranked.filter(F.col("year_rank") == 1) if latest_only else ranked


def high_inflation(indicators: DataFrame, above: float = 0.10) -> DataFrame:
    return (
        indicators.filter(F.col("inflation_rate") > above)
        .select("country_code", "country_name", "year", "inflation_rate", "inflation_category")
        .orderBy(F.desc("inflation_rate"))
    )


def top_inflation(indicators: DataFrame, n: int = 10, above: float = 0.10) -> DataFrame:
    """The n highest rates; equal rates by country name and year."""
    return (
        high_inflation(indicators, above)
        .select("country_name", "year", "inflation_rate")
        .orderBy(F.desc("inflation_rate"), "country_name", "year")
        .limit(n)
    )


def wage_inflation(indicators: DataFrame) -> DataFrame:
    """Rows with rate, wage and real wage, and which of the two grew faster."""
    return (
        indicators.filter(
            F.col("inflation_rate").isNotNull()
            & F.col("avg_annual_wage").isNotNull()
            & F.col("real_wage_adjusted").isNotNull()
        )
        .select(
            "country_code", "country_name", "year", "inflation_rate", "avg_annual_wage",
            "real_wage_adjusted",
            wage_inflation_relationship(
                F.col("real_wage_adjusted"), F.col("avg_annual_wage")
            ).alias("wage_inflation_relationship"),
        )
    )


def wage_inflation_by_country(indicators: DataFrame, since: int = 2010) -> DataFrame:
    return (
        wage_inflation(indicators)
        .filter(F.col("year") >= since)
        .groupBy("country_name")
        .agg(
            F.avg("inflation_rate").alias("avg_inflation"),
            F.avg("real_wage_adjusted").alias("avg_real_wage"),
        )
        .orderBy(F.desc("avg_inflation"))
    )


def avg_and_max_by_country(indicators: DataFrame, country: str = "country_code") -> DataFrame:
    return indicators.groupBy(country).agg(
        F.avg("inflation_rate").alias("avg_inflation"),
        F.max("commodity_price_index").alias("max_commodity_price"),
    )


def coverage(indicators: DataFrame) -> DataFrame:
    """Years covered per country, widest coverage first."""
    return (
        indicators.groupBy("country_code")
        .agg(
            F.countDistinct("year").alias("years_covered"),
            F.min("year").alias("earliest_year"),
            F.max("year").alias("latest_year"),
        )
        .orderBy(F.desc("years_covered"))
    )


def anomalies(rates: DataFrame, low: float = -0.5, high: float = 1.0) -> DataFrame:
    """Rates outside the normal range, largest magnitude first."""
    rate = F.col("inflation_rate")
    return (
        rates.filter((rate > high) | (rate < low))
        .select("country_code", "year", "inflation_rate")
        .orderBy(F.desc(F.abs(rate)))
    )
