"""Landed JSON pages of the form ``[meta, [record, ...]]``.

Each page is one document of bounded size (the service pages its answers), so pages are
parsed independently and the work spreads over the files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.parsing import parse_number, parse_year
from macrotide.schemas import INFLATION_INDICATORS

_INDICATOR_RECORDS = """array<struct<
    indicator: struct<id: string, value: string>,
    country: struct<id: string, value: string>,
    countryiso3code: string, date: string, value: string>>"""

_COUNTRY_RECORDS = """array<struct<
    id: string, name: string, iso2Code: string,
    region: struct<id: string, value: string>,
    incomeLevel: struct<id: string, value: string>>>"""


def read_documents(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per file, its text in ``value`` and its address in ``source``."""
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source"))


def _records(documents: DataFrame, text: str, schema: str) -> DataFrame:
    page = F.from_json(F.get_json_object(F.col(text), "$[1]"), schema)
    return documents.select(F.explode(page).alias("r"))


def parse_indicator_pages(
    documents: DataFrame, text: str = "value", indicator_code: str | None = None,
    indicators: Mapping[str, str] = INFLATION_INDICATORS,
) -> DataFrame:
    """Inflation feed. Pages without records and records without value give no row.

    ``indicator_code`` tags every record; without it the record's own indicator is used,
    with its name from ``indicators`` where listed there.
    """
    code = F.col("r.indicator.id") if indicator_code is None else F.lit(indicator_code)
    name = F.col("r.indicator.value")
    for known, known_name in indicators.items():
        name = F.when(code == known, known_name).otherwise(name)
    return (
        _records(documents, text, _INDICATOR_RECORDS)
        .filter(F.col("r.value").isNotNull())
        .select(
            F.col("r.countryiso3code").alias("country_code"),
            F.col("r.country.value").alias("country_name"),
            code.alias("indicator_code"),
            name.alias("indicator_name"),
            parse_year(F.col("r.date")).alias("year"),
            parse_number(F.col("r.value")).alias("value"),
        )
    )


def _unless_na(group: str) -> Column:
    return F.when(F.col(f"r.{group}.id") != "NA", F.col(f"r.{group}.value"))


def parse_country_pages(documents: DataFrame, text: str = "value") -> DataFrame:
    """Country list; a region or income level of 'NA' is null."""
    return _records(documents, text, _COUNTRY_RECORDS).select(
        F.col("r.id").alias("country_code"),
        F.col("r.name").alias("country_name"),
        F.col("r.iso2Code").alias("iso2_code"),
        _unless_na("region").alias("region"),
        _unless_na("incomeLevel").alias("income_level"),
    )


def select_feed(
    feed: DataFrame, countries: Sequence[str] | None = None,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """The part of a feed a request asks for; no country list means all countries."""
    if countries is not None:
        feed = feed.filter(F.col("country_code").isin(list(countries)))
    if years is not None:
        feed = feed.filter(F.col("year").between(*years))
    return feed
