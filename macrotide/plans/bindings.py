"""Feeds derived from the star-schema tables, for the registered queries.

Nations play the countries, return flags the inflation indicators, order priorities the wage
indicators and part types the commodities. Years run from 1995 to 2001.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.country import CountryLookup
from macrotide.operators.clean import clean_commodities, clean_inflation, clean_wages
from macrotide.operators.merge import merge_datasets
from macrotide.sources.json_feed import select_feed

YEARS = (1995, 2001)
WINDOW = (1996, 2001)
COUNTRIES = [f"N{k:02d}" for k in range(25)]
# The wage source covers members only: one country has no wages.
WAGE_MEMBERS = [c for c in COUNTRIES if c != "N07"]
BASKET = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]
COMMODITIES = sorted(BASKET + ["STANDARD"])
INDICATORS = ["indicator A", "indicator N", "indicator R"]
WAGE_INDICATORS = {
    "1-URGENT": "avg_annual_wage",
    "2-HIGH": "unit_labour_cost",
    "3-MEDIUM": "hourly_earnings_growth",
    "4-NOT SPECIFIED": "real_wage_index",
    "5-LOW": "5-LOW",
}
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


class Tables:
    """Reads the tables of one folder by name: ``Tables(spark, folder).lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        # Kept, as each read lists files and looks up the schema anew.
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame


def country_code(nation_key: Column) -> Column:
    return F.concat(F.lit("N"), F.lpad(nation_key.cast("string"), 2, "0"))


def country(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        country_code(F.col("n_nationkey")).alias("country_code"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region"),
    )


def inflation_feed(t: Tables) -> DataFrame:
    rows = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return (
        rows.groupBy("n_nationkey", "n_name", "l_returnflag", F.year("o_orderdate").alias("year"))
        .agg((F.round(F.avg(F.col("l_discount") - F.col("l_tax")) * 400, 6) + 0.0).alias("value"))
        .select(
            country_code(F.col("n_nationkey")).alias("country_code"),
            F.col("n_name").alias("country_name"),
            F.col("l_returnflag").alias("indicator_code"),
            F.concat(F.lit("indicator "), F.col("l_returnflag")).alias("indicator_name"),
            "year",
            "value",
        )
    )


def wage_feed(t: Tables, members: list[str] = WAGE_MEMBERS) -> DataFrame:
    index = F.col("indicator") == "4-NOT SPECIFIED"
    feed = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("indicator"))
        .agg(F.avg("o_totalprice").alias("value"))
        .select(
            country_code(F.col("c_nationkey")).alias("country_code"), "year", "indicator",
            F.when(index, F.col("value") / 2500).otherwise(F.col("value")).alias("value"),
        )
    )
    return select_feed(feed, members)


def commodity_feed(t: Tables) -> DataFrame:
    """Names carry blanks and punctuation that cleaning has to take off."""
    name = F.concat(F.lit("  "), F.col("p_type"), F.lit("-*. "))
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        name.alias("commodity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )


def rate_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("category"),
        (F.round((F.col("l_discount") - F.col("l_tax")) * 400, 6) + 0.0).alias("value"),
    )


def inflation(t: Tables, years: tuple[int, int] = YEARS) -> DataFrame:
    return clean_inflation(inflation_feed(t), years)


def annual_prices(t: Tables, years: tuple[int, int] = YEARS) -> DataFrame:
    return clean_commodities(commodity_feed(t), years)


def wages(t: Tables, years: tuple[int, int] = YEARS) -> DataFrame:
    return clean_wages(wage_feed(t), years, WAGE_INDICATORS)


def merged(t: Tables, years: tuple[int, int] = YEARS) -> DataFrame:
    return merge_datasets(
        inflation(t, years), annual_prices(t, years), wages(t, years), BASKET, years
    )


def country_lookup() -> CountryLookup:
    """The nations as a country list, each also under a name that carries its region."""
    return CountryLookup([
        (f"Q{chr(65 + k)}", f"N{k:02d}", f"NATION_{k}", f"TERRITORY {k} OF {REGIONS[k % 5]}")
        for k in range(25)
    ])


def country_spellings(t: Tables) -> DataFrame:
    """Customers with their country written in nine ways: name, name in other case, name with
    a suffix, region, two-letter code, three letters, a fixed alias, punctuation, a number."""
    way = F.col("c_custkey") % 9
    text = (
        F.when(way == 0, F.col("n_name"))
        .when(way == 1, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
        .when(way == 2, F.concat("n_name", F.lit(" (north)")))
        .when(way == 3, F.concat(F.lower("r_name"), F.lit(" union")))
        .when(way == 4, F.concat(F.lit("q"), F.char(F.col("n_nationkey") + 97)))
        .when(way == 5, F.lower(F.substring("c_mktsegment", 1, 3)))
        .when(way == 6, F.lit("uk"))
        .when(way == 7, F.lit("--"))
        .otherwise(F.concat(F.lit("#"), F.col("c_custkey").cast("string")))
    )
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", text.alias("country_code"))
    )
