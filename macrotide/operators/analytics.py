"""The dashboard's questions, answered in the query so only aggregated rows leave the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.functions.bands import correlation_strength, inflation_delta
from macrotide.functions.formatting import money_text, percent_text
from macrotide.operators.reshape import long_to_wide
from macrotide.operators.stats import (
    change_first_to_last, corr_matrix, group_mean, group_trend, pearson, spread, trend_line,
)
from macrotide.session import stored

# What the figures show when the selection is empty.
DEFAULT_AVG_WAGE = 48500.0
DEFAULT_AVG_INFLATION = 0.0245
DEFAULT_INFLATION_DELTA = 0.0045

DATA_TYPES = {
    "Inflation Rates": ("inflation_rates", "country_code"),
    "Wage Index": ("wage_index", "country_code"),
    "Commodity Prices": ("commodity_prices", "commodity"),
}


def select_rows(
    df: DataFrame, entities: Sequence[str] | None = None, years: tuple[int, int] | None = None,
    entity: str = "country_code", indicator: str | None = None,
) -> DataFrame:
    """The dashboard's selection: entities, year range and, where given, one indicator."""
    if entities is not None:
        df = df.filter(F.col(entity).isin(list(entities)))
    if years is not None:
        df = df.filter(F.col("year").between(*years))
    if indicator is not None:
        df = df.filter(F.col("inflation_indicator") == indicator)
    return df


def latest_names(df: DataFrame) -> DataFrame:
    """One name per country code: the one of the latest year.

    Rows are reduced to (code, name) with a hash aggregation first. Picking by name and year
    compares text, for which Spark sorts, and then has only a few rows to sort.
    """
    spellings = df.na.drop(subset=["country_code"]).groupBy("country_code", "country_name").agg(
        F.max("year").alias("year")
    )
    return spellings.groupBy("country_code").agg(
        F.max_by("country_name", F.struct("year", "country_name")).alias("country_name")
    )


def kpis(
    inflation: DataFrame, wages: DataFrame, countries: Sequence[str], years: tuple[int, int]
) -> DataFrame:
    """One row: average rate and its distance above target, average wage, size of the selection."""
    wage = select_rows(wages, countries, years).agg(
        F.when(F.count("*") == 0, DEFAULT_AVG_WAGE).otherwise(F.avg("avg_annual_wage")).alias("w")
    ).scalar()
    return (
        select_rows(inflation, countries, years)
        .agg(F.count("*").alias("n"), F.avg("inflation_rate").alias("mean"))
        .select(
            F.when(F.col("n") == 0, DEFAULT_AVG_INFLATION).otherwise(F.col("mean")).alias("avg_inflation"),
            F.when(F.col("n") == 0, DEFAULT_INFLATION_DELTA)
            .otherwise(inflation_delta(F.col("mean"))).alias("inflation_delta"),
            wage.alias("avg_wage"),
            F.lit(len(countries)).alias("countries"),
            F.lit(years[1] - years[0] + 1).alias("years"),
        )
    )


def inflation_over_time(
    inflation: DataFrame, countries: Sequence[str] | None = None, years: tuple[int, int] | None = None,
    indicator: str | None = None,
) -> DataFrame:
    rows = select_rows(inflation, countries, years, indicator=indicator)
    return group_mean(rows, ["year", "country_code", "country_name"])


def avg_by_country(
    inflation: DataFrame, countries: Sequence[str] | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Mean rate of each country code beside every name it goes by.

    Sums per (code, name) come first; the window then sees one row per name.
    """
    sums = (
        select_rows(inflation, countries, years).na.drop(subset=["country_code"])
        .groupBy("country_code", "country_name")
        .agg(F.sum("inflation_rate").alias("s"), F.count("inflation_rate").alias("n"))
    )
    code = Window.partitionBy("country_code")
    return sums.select(
        "country_code",
        F.try_divide(F.sum("s").over(code), F.sum("n").over(code)).alias("inflation_rate"),
        "country_name",
    )


def inflation_wage_join(
    inflation: DataFrame, wages: DataFrame, countries: Sequence[str] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Mean rate and mean wage of each country and year that has both."""
    rates = group_mean(select_rows(inflation, countries, years), ["country_code", "year"])
    pay = group_mean(select_rows(wages, countries, years), ["country_code", "year"], "avg_annual_wage")
    return rates.join(pay, ["country_code", "year"]).join(
        latest_names(inflation), "country_code", "left"
    )


def inflation_wage_correlation(joined: DataFrame) -> DataFrame:
    return joined.agg(pearson("inflation_rate", "avg_annual_wage").alias("correlation")).select(
        "correlation", correlation_strength(F.col("correlation")).alias("strength")
    )


def inflation_wage_matrix(joined: DataFrame) -> DataFrame:
    return corr_matrix(joined, ["inflation_rate", "avg_annual_wage"])


def inflation_wage_trend(joined: DataFrame) -> DataFrame:
    return trend_line(joined, "inflation_rate", "avg_annual_wage")


def commodity_trends(
    annual_prices: DataFrame, commodities: Sequence[str] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    rows = select_rows(annual_prices, commodities, years, entity="commodity")
    return group_trend(rows, "commodity", "year", "avg_annual_price")


def commodity_stats(
    annual_prices: DataFrame, commodities: Sequence[str] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Price statistics per commodity; rising when the latest price is above the earliest."""
    price = F.col("avg_annual_price")
    return (
        select_rows(annual_prices, commodities, years, entity="commodity")
        .groupBy("commodity")
        .agg(
            F.avg(price).alias("avg_price"), F.min(price).alias("min_price"),
            F.max(price).alias("max_price"), F.stddev_samp(price).alias("volatility"),
            (F.max_by(price, "year") > F.min_by(price, "year")).alias("rising"),
        )
    )


def commodity_stats_display(stats: DataFrame) -> DataFrame:
    return stats.select(
        "commodity", *[money_text(F.col(c), 2).alias(c) for c in ("avg_price", "min_price", "max_price")],
        F.format_string("%.2f", F.col("volatility")).alias("volatility"), "rising",
    )


def data_explorer(
    tables: dict[str, DataFrame], data_type: str, entities: Sequence[str], years: tuple[int, int]
) -> DataFrame:
    """Rows of one of the three explorable tables for the current selection."""
    if data_type not in DATA_TYPES:
        raise ValueError(f"unknown data type: {data_type}")
    table, entity = DATA_TYPES[data_type]
    return select_rows(tables[table], entities, years, entity=entity)


def filter_options(inflation: DataFrame, annual_prices: DataFrame) -> DataFrame:
    """What can be selected: countries with names, commodities, indicators and the year range.

    The first five countries and four commodities are preselected, and one indicator: 'CPI'
    where there is one, else the first. Both tables are read once: a row per country, name and indicator with its years, and
    a row per commodity, are written to the shared folder, and everything follows from them.
    """
    seen = inflation.groupBy("country_code", "country_name", "inflation_indicator").agg(F.min("year").alias("first"), F.max("year").alias("year"))
    named = annual_prices.select("commodity").na.drop().distinct()
    rows = stored(seen.unionByName(named, allowMissingColumns=True))

    def options(kind: str, values: DataFrame, label: str, *order: Column, chosen: int) -> DataFrame:
        place = F.row_number().over(Window.orderBy(*order))
        return values.select(F.lit(kind).alias("kind"), "value", F.col(label).alias("label"), (place <= chosen).alias("preselected"))

    value = F.col("value")
    countries = latest_names(rows.filter("commodity IS NULL")).withColumnRenamed("country_code", "value")
    commodities = rows.select(F.col("commodity").alias("value")).na.drop()
    indicators = rows.select(F.col("inflation_indicator").alias("value")).na.drop().distinct()
    span = rows.agg(F.min("first").cast("string").alias("first"), F.max("year").cast("string").alias("last"))
    years = span.select(F.inline(F.array(
        F.struct(F.lit("first_year").alias("kind"), F.col("first").alias("value")),
        F.struct(F.lit("last_year").alias("kind"), F.col("last").alias("value")),
    ))).select("kind", "value", F.col("value").alias("label"), F.lit(True).alias("preselected"))
    return (
        options("country", countries, "country_name", value, chosen=5)
        .unionByName(options("commodity", commodities, "value", value, chosen=4))
        .unionByName(options("indicator", indicators, "value", F.desc(value == "CPI"), value, chosen=1))
        .unionByName(years)
    )


def heatmap(
    inflation: DataFrame, year_columns: Sequence[int], countries: Sequence[str] | None = None,
    indicator: str = "CPI",
) -> DataFrame:
    """Mean rate per country, one column per year."""
    years = (min(year_columns), max(year_columns))
    rows = select_rows(inflation, countries, years, indicator=indicator).na.drop(subset=["country_name"])
    return long_to_wide(
        rows, ["country_name"], "year", {y: str(y) for y in year_columns}, F.avg, "inflation_rate"
    )


def volatility(
    inflation: DataFrame, countries: Sequence[str] | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    rows = select_rows(inflation, countries, years).na.drop(subset=["country_code", "country_name"])
    return rows.groupBy("country_code", "country_name").agg(*spread("inflation_rate"))


def comparison_series(
    inflation: DataFrame, countries: Sequence[str], years: tuple[int, int] | None = None,
    indicator: str = "CPI",
) -> DataFrame:
    """Yearly mean of one indicator per country; comparing takes at least two countries."""
    series = inflation_over_time(inflation, countries, years, indicator)
    return series if len(countries) >= 2 else series.filter(F.lit(False))


def comparison_stats(
    inflation: DataFrame, countries: Sequence[str], years: tuple[int, int] | None = None
) -> DataFrame:
    rows = select_rows(inflation, countries, years).na.drop(subset=["country_name"])
    stats = rows.groupBy("country_name").agg(
        F.count("inflation_rate").alias("data_points"), *spread("inflation_rate")
    )
    return stats if len(countries) >= 2 else stats.filter(F.lit(False))


def with_percent_texts(stats: DataFrame) -> DataFrame:
    """Display form of a statistics frame: percent texts beside the numbers."""
    return stats.withColumns({
        f"{c}_text": percent_text(F.col(c)) for c in ("mean", "std_dev", "min", "max")
    })


def comparison_display(stats: DataFrame) -> DataFrame:
    """Comparison table under its display headings."""
    texts = with_percent_texts(stats)
    headings = {
        "country_name": "Country", "data_points": "Data Points", "mean_text": "Average",
        "std_dev_text": "Volatility", "min_text": "Minimum", "max_text": "Maximum",
    }
    return texts.select(*[F.col(c).alias(h) for c, h in headings.items()])


def year_average(
    feed: DataFrame, countries: Sequence[str] | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Mean raw value by year over a group of countries."""
    return group_mean(select_rows(feed, countries, years), ["year"], "value", "avg_value").orderBy("year")


def inflation_ranking(df: DataFrame, country: str = "country_code") -> DataFrame:
    return group_mean(df, [country], "inflation_rate", "avg_inflation").orderBy(F.desc("avg_inflation"))


def real_wage_change(
    df: DataFrame, country: str = "country_code", value: str = "real_wage_adjusted"
) -> DataFrame:
    return change_first_to_last(df, country, value)
