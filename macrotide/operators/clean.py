"""Cleaning of the three feeds.

Year windows are (first, last), inclusive. The filters compare plain feed columns, so on
Parquet they reach the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.functions.parsing import (
    parse_date, parse_number, parse_year, strip_punctuation,
)
from macrotide.functions.percent import load_time_rate
from macrotide.operators.reshape import date_column, long_to_wide, unify_aliases
from macrotide.schemas import WAGE_COLUMNS, WAGE_FEED, YEAR_WINDOW

# Header names of the wage source, by priority.
WAGE_HEADER_ALIASES = {
    "country_code": ("country_code", "LOCATION", "Country"),
    "year": ("year", "TIME_PERIOD", "Time"),
    "value": ("value", "OBS_VALUE", "Value"),
}


def has_value(column: str) -> Column:
    return F.col(column).isNotNull() & ~F.isnan(F.col(column))


def clean_inflation(feed: DataFrame, years: tuple[int, int] = YEAR_WINDOW) -> DataFrame:
    return feed.filter(has_value("value") & F.col("year").between(*years)).select(
        "country_code",
        "country_name",
        "year",
        load_time_rate(F.col("value")).alias("inflation_rate"),
        F.col("indicator_name").alias("inflation_indicator"),
    )


def clean_commodities(feed: DataFrame, years: tuple[int, int] = YEAR_WINDOW) -> DataFrame:
    """Annual mean price per commodity; names lose outer blanks and punctuation other
    than parentheses (ASCII word characters only)."""
    name = strip_punctuation(F.trim("commodity"), keep="()")
    return (
        feed.filter(
            has_value("price") & F.col("year").between(*years) & F.col("month").between(1, 12)
        )
        .groupBy("year", name.alias("commodity"))
        .agg(F.avg("price").alias("avg_annual_price"))
    )


def clean_wages(
    feed: DataFrame, years: tuple[int, int] = YEAR_WINDOW,
    indicators: Mapping[str, str] = WAGE_COLUMNS,
) -> DataFrame:
    """One row per country and year with a column per indicator.

    ``indicators`` maps indicator to column name. Only listed indicators become columns, in
    every run the same ones. Of several values for one cell the smallest is taken.
    """
    rows = feed.filter(has_value("value") & F.col("year").between(*years))
    return long_to_wide(rows, ["country_code", "year"], "indicator", indicators, F.min, "value")


def clean_commodity_sheet(sheet: DataFrame) -> DataFrame:
    """Wide sheet (one column per commodity) to year, month, commodity, price.

    A sheet without commodity columns comes back unchanged.
    """
    key = date_column(sheet)
    if not [c for c in sheet.columns if c != key and not c.startswith("Unnamed")]:
        return sheet
    # Dates and numbers are parsed once, on the sheet row; only typed cells are unpivoted.
    names = [c for c in sheet.columns if c != key and not c.startswith("Unnamed")]
    date = parse_date(F.col(f"`{key}`").cast("string"))
    cells = F.array(*[
        F.struct(F.lit(c.strip()).alias("commodity"), parse_number(F.col(f"`{c}`").cast("string")).alias("price"))
        for c in names
    ])
    return (
        sheet.select(F.explode(F.array_compact(F.array(date))).alias("date"), cells.alias("cells"))
        .select(F.year("date").alias("year"), F.month("date").alias("month"), F.inline("cells"))
        .filter(F.col("price").isNotNull())
    )


def clean_wage_table(table: DataFrame, dataset_code: str) -> DataFrame:
    """Wage source with its own headers to the wage feed's columns.

    Without country, year or value column the result is empty.
    """
    unified = unify_aliases(table, WAGE_HEADER_ALIASES)
    if not set(WAGE_HEADER_ALIASES) <= set(unified.columns):
        return table.sparkSession.createDataFrame([], WAGE_FEED)
    return (
        unified.select(
            F.col("country_code").cast("string").alias("country_code"),
            parse_year(F.col("year").cast("string")).alias("year"),
            F.lit(dataset_code).alias("indicator"),
            parse_number(F.col("value").cast("string")).alias("value"),
        )
        .na.drop(subset=["year", "value"])
    )
