"""Derived measures and the labels put on them. Band edges are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFLATION_CATEGORIES = ("Deflation", "Low", "Moderate", "High", "Very High")


def inflation_category(rate: Column) -> Column:
    """Below 0, up to 2 %, up to 5 %, up to 10 %, above. A null rate lands in the last band."""
    deflation, low, moderate, high, very_high = INFLATION_CATEGORIES
    return (
        F.when(rate < 0, deflation)
        .when(rate <= 0.02, low)
        .when(rate <= 0.05, moderate)
        .when(rate <= 0.10, high)
        .otherwise(very_high)
    )


def real_wage(wage: Column, rate: Column) -> Column:
    """Wage deflated by the rate; null when either is null or the rate is -100 %."""
    return F.try_divide(wage, 1 + rate)


def health_score(rate: Column, real_wage_index: Column) -> Column:
    """1 (worst) to 5 (best). Branches are ordered: 0.01 scores 4, not 3."""
    return (
        F.when(rate.between(0.01, 0.03) & (real_wage_index > 100), 5)
        .when(rate.between(0.01, 0.05), 4)
        .when(rate.between(-0.01, 0.01), 3)
        .when(rate > 0.10, 1)
        .otherwise(2)
    )


def wage_inflation_relationship(real: Column, nominal: Column) -> Column:
    return (
        F.when(real > nominal, "Wage Growth Outpacing Inflation")
        .when(real < nominal, "Inflation Outpacing Wage Growth")
        .otherwise("Balanced")
    )


def correlation_strength(r: Column) -> Column:
    return F.when(F.abs(r) > 0.7, "Strong").when(F.abs(r) > 0.4, "Moderate").otherwise("Weak")


def inflation_delta(mean_rate: Column, target: float = 0.02) -> Column:
    """Distance above the target rate, null at or below it."""
    return F.when(mean_rate > target, mean_rate - target)
