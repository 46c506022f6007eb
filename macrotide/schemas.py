"""Feed schemas, table layouts and keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

INFLATION_FEED = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("indicator_code", T.StringType()),
    T.StructField("indicator_name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

COMMODITY_FEED = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("commodity", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

WAGE_FEED = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("indicator", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

COUNTRY_FEED = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("iso2_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("income_level", T.StringType()),
])

# Feed vocabulary.
INFLATION_INDICATORS = {
    "NY.GDP.DEFL.KD.ZG": "GDP deflator (annual %)",
    "FP.CPI.TOTL.ZG": "Inflation, consumer prices (annual %)",
    "NY.GDP.DEFL.ZS": "GDP deflator: linked series (base year varies by country)",
}
WAGE_DATASETS = {
    "ULC_EEQ": "Unit Labour Costs - Total Economy",
    "ALFS_EMP": "Labour Force Statistics - Employment",
    "AWE": "Average Wages",
}
WAGE_COLUMNS = {
    "Average Annual Wages": "avg_annual_wage",
    "Unit Labour Costs": "unit_labour_cost",
    "Hourly Earnings Growth": "hourly_earnings_growth",
    "Real Wage Index": "real_wage_index",
}
KEY_COMMODITIES = ["Crude Oil (petroleum)", "Gold", "Wheat", "Aluminum", "Copper"]
DEFAULT_WAGE_COUNTRIES = [
    "USA", "GBR", "DEU", "FRA", "JPN", "CAN", "AUS", "ITA", "ESP", "NLD",
]
MAJOR_WAGE_COUNTRIES = DEFAULT_WAGE_COUNTRIES + ["BEL", "AUT", "CHE", "SWE", "NOR", "DNK"]
YEAR_WINDOW = (2000, 2030)


# Rows kept out of a table: the rule they break and the row as JSON.
REJECTED = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("row", T.StringType()),
])


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    default: str | None = None

    @property
    def max_length(self) -> int | None:
        if self.type.startswith("VARCHAR("):
            return int(self.type[len("VARCHAR("):-1])
        return None

    @property
    def spark_type(self) -> str:
        """Type to cast to; a VARCHAR limit is enforced by the table on write."""
        return "STRING" if self.max_length else self.type


@dataclass(frozen=True)
class Table:
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    load_key: tuple[str, ...]
    serial: bool = True
    by_year: bool = True
    parent: str | None = "countries"
    stamps: tuple[str, str] = field(default=("created_at", "updated_at"))

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


def _required(name: str, type_: str) -> Column:
    return Column(name, type_, required=True)


TABLES: dict[str, Table] = {
    "countries": Table(
        columns=(
            _required("country_code", "VARCHAR(3)"),
            _required("country_name", "VARCHAR(255)"),
            Column("region", "VARCHAR(100)"),
            Column("income_level", "VARCHAR(50)"),
        ),
        key=("country_code",),
        load_key=(),
        serial=False,
        by_year=False,
        parent=None,
    ),
    "inflation_rates": Table(
        columns=(
            _required("country_code", "VARCHAR(3)"),
            _required("year", "INT"),
            Column("inflation_rate", "DECIMAL(10,6)"),
            Column("inflation_indicator", "VARCHAR(255)"),
            Column("inflation_category", "VARCHAR(20)"),
            Column("data_source", "VARCHAR(50)", default="World Bank"),
        ),
        key=("country_code", "year", "inflation_indicator"),
        load_key=("country_code", "year"),
    ),
    "wage_index": Table(
        columns=(
            _required("country_code", "VARCHAR(3)"),
            _required("year", "INT"),
            Column("avg_annual_wage", "DECIMAL(12,2)"),
            Column("unit_labour_cost", "DECIMAL(10,4)"),
            Column("hourly_earnings_growth", "DECIMAL(8,4)"),
            Column("real_wage_index", "DECIMAL(10,4)"),
            Column("real_wage_adjusted", "DECIMAL(12,2)"),
            Column("data_source", "VARCHAR(50)", default="OECD"),
        ),
        key=("country_code", "year"),
        load_key=("country_code", "year"),
    ),
    "commodity_prices": Table(
        columns=(
            _required("year", "INT"),
            Column("month", "INT"),
            _required("commodity", "VARCHAR(255)"),
            Column("price", "DECIMAL(12,4)"),
            Column("avg_annual_price", "DECIMAL(12,4)"),
            Column("price_unit", "VARCHAR(50)"),
            Column("data_source", "VARCHAR(50)", default="IMF"),
        ),
        key=("year", "month", "commodity"),
        load_key=("year", "commodity"),
        parent=None,
    ),
    "economic_indicators": Table(
        columns=(
            _required("country_code", "VARCHAR(3)"),
            Column("country_name", "VARCHAR(255)"),
            _required("year", "INT"),
            Column("inflation_rate", "DECIMAL(10,6)"),
            Column("inflation_category", "VARCHAR(20)"),
            Column("avg_annual_wage", "DECIMAL(12,2)"),
            Column("unit_labour_cost", "DECIMAL(10,4)"),
            Column("real_wage_index", "DECIMAL(10,4)"),
            Column("real_wage_adjusted", "DECIMAL(12,2)"),
            Column("commodity_price_index", "DECIMAL(12,4)"),
            Column("economic_health_score", "INT"),
        ),
        key=("country_code", "year"),
        load_key=("country_code", "year"),
    ),
}
