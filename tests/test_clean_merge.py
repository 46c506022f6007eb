import pytest
from pyspark.sql import functions as F

from support import values
from macrotide.operators.clean import (
    clean_commodities, clean_commodity_sheet, clean_inflation, clean_wage_table, clean_wages,
)
from macrotide.operators.joins import join_unique
from macrotide.operators.merge import derived_features, merge_datasets
from macrotide.operators.reshape import select_typed, unify_aliases, union_feeds
from macrotide.schemas import COMMODITY_FEED, INFLATION_FEED, WAGE_FEED

CPI, GDP = "consumer prices", "deflator"


@pytest.fixture
def inflation(spark):
    return spark.createDataFrame([
        ("USA", "United States", "A", CPI, 2020, 1.2), ("USA", "United States", "B", GDP, 2020, 0.9),
        ("USA", "United States", "A", CPI, 2021, 4.7), ("GBR", "United Kingdom", "A", CPI, 2020, -0.5),
        ("GBR", "United Kingdom", "A", CPI, 1999, 2.0), ("GBR", "United Kingdom", "A", CPI, 2031, 2.0),
        ("DEU", "Germany", "A", CPI, 2020, None), ("DEU", "Germany", "A", CPI, 2021, float("nan")),
        ("DEU", "Germany", "A", CPI, None, 1.0),
    ], INFLATION_FEED)


@pytest.fixture
def commodities(spark):
    return spark.createDataFrame([
        (2020, 1, " Gold ", 10.0), (2020, 2, "Gold!", 20.0), (2020, 13, "Gold", 999.0), (2020, 1, "Wheat", 5.0),
        (2020, 1, "Crude Oil (petroleum)", 31.0), (2020, 1, "Tea", 1000.0), (2021, 1, "Gold", 7.0),
        (2021, 1, "Gold", None), (2040, 1, "Gold", 1.0),
    ], COMMODITY_FEED)


@pytest.fixture
def wages(spark):
    return spark.createDataFrame([
        ("USA", 2020, "Average Annual Wages", 101.2), ("USA", 2020, "Real Wage Index", 101.0),
        ("USA", 2020, "Average Annual Wages", 200.0), ("USA", 2020, "Something else", 1.0),
        ("USA", 2021, "Unit Labour Costs", 3.0), ("GBR", 1990, "Average Annual Wages", 1.0),
    ], WAGE_FEED)


def test_clean_inflation(inflation):
    assert values(clean_inflation(inflation)) == [
        ("GBR", "United Kingdom", 2020, -0.5, CPI), ("USA", "United States", 2020, 0.012, CPI),
        ("USA", "United States", 2020, 0.9, GDP), ("USA", "United States", 2021, 0.047, CPI),
    ]


def test_clean_commodities(commodities):
    assert values(clean_commodities(commodities)) == [
        (2020, "Crude Oil (petroleum)", 31.0), (2020, "Gold", 15.0), (2020, "Tea", 1000.0), (2020, "Wheat", 5.0),
        (2021, "Gold", 7.0),
    ]


def test_clean_wages_has_fixed_columns(wages):
    wide = clean_wages(wages)
    assert wide.columns == [
        "country_code", "year", "avg_annual_wage", "unit_labour_cost", "hourly_earnings_growth", "real_wage_index",
    ]
    assert values(wide) == [("USA", 2020, 101.2, None, None, 101.0), ("USA", 2021, None, 3.0, None, None)]


@pytest.mark.parametrize("years", [None, (2000, 2030)])
def test_merge(inflation, commodities, wages, years):
    merged = merge_datasets(clean_inflation(inflation), clean_commodities(commodities), clean_wages(wages), years=years)
    rows = {(r.country_code, r.year, r.inflation_indicator): r for r in merged.collect()}
    assert len(rows) == 4
    usa = rows["USA", 2020, CPI]
    assert usa.commodity_price_index == pytest.approx((31.0 + 15.0 + 5.0) / 3)
    assert usa.real_wage_adjusted == pytest.approx(100.0)
    assert (usa.inflation_category, usa.economic_health_score) == ("Low", 5)
    assert rows["USA", 2020, GDP].economic_health_score == 1
    gbr = rows["GBR", 2020, CPI]
    assert (gbr.avg_annual_wage, gbr.real_wage_adjusted, gbr.inflation_category) == (None, None, "Deflation")
    assert rows["USA", 2021, CPI].economic_health_score == 4
    one = merge_datasets(
        clean_inflation(inflation), clean_commodities(commodities), clean_wages(wages), years=years, indicator=GDP
    )
    assert one.count() == 1


def test_derived_features_without_wage_columns(spark):
    frame = spark.createDataFrame([(0.02,)], "inflation_rate double")
    row = derived_features(frame).first()
    assert row.real_wage_adjusted is None and row.economic_health_score == 4


def test_join_unique_equals_join_under_skew(spark):
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("v"),
    ).union(spark.createDataFrame([(None, 1)], "k string, v long"))
    right = left.filter("k = 'hot' or k < 'k5'").select("k").distinct().withColumn("w", F.length("k"))
    for how in ("left", "inner"):
        got, want = join_unique(left, right, ["k"], how), left.join(right, "k", how)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_commodity_sheet(spark):
    sheet = spark.createDataFrame(
        [("2020M01", "1.5", "x", "n/a"), ("2020-02-01", None, "y", "3"), ("soon", "4", "z", "5")],
        "Period string, ` Gold ` string, `Unnamed: 2` string, Wheat string",
    )
    assert values(clean_commodity_sheet(sheet)) == [(2020, 1, "Gold", 1.5), (2020, 2, "Wheat", 3.0)]
    only_dates = spark.createDataFrame([("2020",)], "first string")
    assert clean_commodity_sheet(only_dates).columns == ["first"]
    first_column = spark.createDataFrame([("2020", 2.0)], "when string, Tea double")
    assert values(clean_commodity_sheet(first_column)) == [(2020, 1, "Tea", 2.0)]


def test_wage_table_aliases(spark):
    table = spark.createDataFrame(
        [("USA", None, "2015.0", "1.5"), (None, "GBR", "2016", "x"), (None, "FRA", "2016", "2"), ("DEU", "D", "soon", "3")],
        "LOCATION string, Country string, Time string, Value string",
    )
    assert values(clean_wage_table(table, "AWE")) == [("FRA", 2016, "AWE", 2.0), ("USA", 2015, "AWE", 1.5)]
    assert clean_wage_table(table.drop("Time"), "AWE").count() == 0
    assert unify_aliases(table, {"c": ("nope",)}).columns == table.columns


def test_select_typed_goes_by_name(spark):
    frame = spark.createDataFrame([("2.5", "2015", "USA"), ("x", "y", "GBR")], "value string, year string, country_code string")
    assert values(select_typed(frame, WAGE_FEED), "country_code", "year", "indicator", "value") == [
        ("GBR", None, None, None), ("USA", 2015, None, 2.5),
    ]


def test_union_feeds(spark, wages):
    assert union_feeds([None, wages, None, wages.drop("indicator")], WAGE_FEED, spark).count() == 12
    empty = union_feeds([None], WAGE_FEED, spark)
    assert empty.columns == WAGE_FEED.names and empty.count() == 0
