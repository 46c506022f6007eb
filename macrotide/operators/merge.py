"""The merged indicator frame and its derived measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from macrotide.functions.bands import health_score, inflation_category, real_wage
from macrotide.operators.joins import join_unique
from macrotide.schemas import KEY_COMMODITIES


def commodity_index(
    annual_prices: DataFrame, basket: Sequence[str] = KEY_COMMODITIES
) -> DataFrame:
    """Unweighted mean of the basket's annual means, by year."""
    return (
        annual_prices.filter(F.col("commodity").isin(list(basket)))
        .groupBy("year")
        .agg(F.avg("avg_annual_price").alias("commodity_price_index"))
    )


def derived_features(df: DataFrame) -> DataFrame:
    for name in ("avg_annual_wage", "real_wage_index"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("double"))
    rate = F.col("inflation_rate")
    return df.withColumns({
        "real_wage_adjusted": real_wage(F.col("avg_annual_wage"), rate),
        "inflation_category": inflation_category(rate),
        "economic_health_score": health_score(rate, F.col("real_wage_index")),
    })


def merge_datasets(
    inflation: DataFrame, annual_prices: DataFrame, wages: DataFrame,
    basket: Sequence[str] = KEY_COMMODITIES, years: tuple[int, int] | None = None,
    indicator: str | None = None,
) -> DataFrame:
    """Inflation rows with wages of their country and year and the commodity index of their year.

    The grain stays (country, year, indicator); ``indicator`` keeps one of them. Both right
    sides are unique on their join key, so no row is multiplied.

    ``years`` states the window the inflation rows were cleaned to. The index then has at
    most one row per year of it and is broadcast. Without it, and for wages, whose number of
    countries is open, the join is one that a dominant key does not hold up.
    """
    if indicator is not None:
        inflation = inflation.filter(F.col("inflation_indicator") == indicator)
    index = commodity_index(annual_prices, basket)
    merged = join_unique(inflation, wages, ["country_code", "year"])
    if years is not None:
        index = F.broadcast(index.filter(F.col("year").between(*years)))
        merged = merged.join(index, ["year"], "left")
    else:
        merged = join_unique(merged, index, ["year"])
    return derived_features(merged)
