"""The whole job: standardise the landed feeds, clean, merge, load, check.

Every stage that is read more than once is a written Parquet folder or table. Later stages
start from those files: a lost executor costs tasks, not stages, and Spark picks the joins
from real file sizes.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.country import CountryLookup
from macrotide.operators.clean import clean_commodities, clean_inflation, clean_wages
from macrotide.operators.load import country_rows
from macrotide.operators.merge import merge_datasets
from macrotide.operators.quality import constraint_report, table_counts, validate
from macrotide.operators.reshape import union_feeds
from macrotide.operators.sinks import create_schema, put_tables, save
from macrotide.operators.standardize import normalize_columns, split_coded, with_codes
from macrotide.operators.stats import describe_numeric, summary
from macrotide.schemas import (
    DEFAULT_WAGE_COUNTRIES, KEY_COMMODITIES, MAJOR_WAGE_COUNTRIES, TABLES, WAGE_COLUMNS, WAGE_DATASETS, WAGE_FEED,
    YEAR_WINDOW,
)
from macrotide.session import configure, shared_folder
from macrotide.sources import csv_feed, json_feed, xml_feed
from macrotide.sources.damaged import damaged_pages, damaged_xml


WAGE_SELECTIONS = {"all": None, "default": DEFAULT_WAGE_COUNTRIES, "major": MAJOR_WAGE_COUNTRIES}


@dataclass(frozen=True)
class Refreshed:
    merged: DataFrame
    unmapped: dict[str, DataFrame]
    rejected: DataFrame
    summary: DataFrame
    described: DataFrame
    checks: DataFrame
    constraints: DataFrame
    counts: DataFrame


def land(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}"
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh(
    spark: SparkSession, inflation: DataFrame, commodities: DataFrame, wages: DataFrame,
    database: str, folder: str | None = None, lookup: CountryLookup | None = None,
    years: tuple[int, int] = YEAR_WINDOW, basket: Sequence[str] = KEY_COMMODITIES,
    wage_indicators: Mapping[str, str] = WAGE_COLUMNS, damaged: DataFrame | None = None,
) -> Refreshed:
    """Run everything over landed feeds. The tables change all together or not at all (see ``put_tables``). A second run on the same feeds leaves them as they
    are; rows that break a rule of their table are kept aside in ``rejected``, with the documents in ``damaged`` (see ``sources.damaged``). Stages are written to ``folder``, which all executors
    must reach; without one, to a new folder under the session's ``spark.checkpoint.dir``."""
    folder = folder or f"{shared_folder(spark)}/refresh-{uuid.uuid4().hex}"
    lookup = lookup or CountryLookup.iso(spark)
    # Each raw feed is read and matched once; what was mapped and what was not comes from there.
    inflation, unmapped_inflation = split_coded(land(
        normalize_columns(with_codes(inflation, lookup), ["value"]), folder, "standardized_inflation"))
    wages, unmapped_wages = split_coded(land(with_codes(wages, lookup), folder, "standardized_wages"))
    unmapped = {"inflation": unmapped_inflation, "wages": unmapped_wages}
    commodities = land(commodities, folder, "standardized_commodities")

    rates = clean_inflation(inflation, years)
    prices = land(clean_commodities(commodities, years), folder, "annual_prices")
    pay = land(clean_wages(wages, years, wage_indicators), folder, "wages_by_year")
    merged = land(
        merge_datasets(rates, prices, pay, basket, years), folder, "merged"
    )

    create_schema(spark, database)
    loads = {
        "countries": country_rows(merged), "inflation_rates": merged, "wage_index": pay,
        "commodity_prices": prices, "economic_indicators": merged,
    }
    rejected = put_tables(loads, database, f"{folder.rstrip('/')}/tables")
    if damaged is not None:
        rejected.append(land(damaged, folder, "damaged"))
    tables = {name: spark.table(f"{database}.{name}") for name in TABLES}
    constraints = [
        constraint_report(table, name).select(F.lit(name).alias("table"), "*") for name, table in tables.items()]
    return Refreshed(
        merged, unmapped, reduce(DataFrame.unionByName, rejected), summary(merged), describe_numeric(merged),
        validate(tables), reduce(DataFrame.unionByName, constraints), table_counts(spark, tables, total="all"),
    )


def read_feeds(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three landed feeds in the formats they come in."""
    inflation = {
        "csv": lambda: csv_feed.read_inflation(spark, args.inflation),
        "json": lambda: json_feed.parse_indicator_pages(json_feed.read_documents(spark, args.inflation)),
    }[args.inflation_format]()
    commodities = {
        "csv": lambda: csv_feed.read_commodities(spark, args.commodities),
        "sheet": lambda: csv_feed.read_commodity_sheet(spark, args.commodities),
    }[args.commodity_format]()
    read_wages = {
        "csv": lambda path, dataset: csv_feed.read_wages(spark, path),
        "table": lambda path, dataset: csv_feed.read_wage_table(spark, path, dataset),
        "xml": lambda path, dataset: xml_feed.read_wage_xml(
            spark, path, dataset, row_tag=args.wage_tag, nested=args.wage_nested),
        "observations": lambda path, dataset: xml_feed.read_observations(spark, path, dataset),
    }[args.wage_format]
    datasets = args.wage_dataset * len(args.wages) if len(args.wage_dataset) == 1 else args.wage_dataset
    feeds = [read_wages(path, dataset) for path, dataset in zip(args.wages, datasets, strict=True)]
    wages = json_feed.select_feed(union_feeds(feeds, WAGE_FEED, spark), WAGE_SELECTIONS[args.wage_countries])
    return inflation, commodities, wages


def damaged_feeds(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Documents of the feeds that are read whole and cannot be parsed."""
    found = []
    if args.inflation_format == "json":
        found.append(damaged_pages(json_feed.read_documents(spark, args.inflation)))
    if args.wage_format == "observations":
        found += [damaged_xml(json_feed.read_documents(spark, path)) for path in args.wages]
    return reduce(DataFrame.unionByName, found) if found else None


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Standardise, merge, load and check the landed feeds.")
    parser.add_argument("--inflation", required=True)
    parser.add_argument("--inflation-format", choices=("csv", "json"), default="csv")
    parser.add_argument("--commodities", required=True)
    parser.add_argument("--commodity-format", choices=("csv", "sheet"), default="csv")
    parser.add_argument("--wages", required=True, nargs="+", help="one path per dataset")
    parser.add_argument("--wage-format", choices=("csv", "table", "xml", "observations"), default="csv",
                        help="xml: one element, named below; observations: every element that is one by its tag")
    parser.add_argument("--wage-dataset", default=["AWE"], nargs="+", help="code or name of each dataset: "
                        + ", ".join(f"{code} ({name})" for code, name in WAGE_DATASETS.items()))
    parser.add_argument("--wage-countries", choices=tuple(WAGE_SELECTIONS), default="all")
    parser.add_argument("--wage-tag", default="Obs", help="row element of an XML wage feed")
    parser.add_argument("--wage-nested", help="observation element inside the row element")
    parser.add_argument("--database", required=True)
    parser.add_argument("--folder", help="shared folder for the stages; default: spark.checkpoint.dir")
    parser.add_argument("--years", type=int, nargs=2, default=list(YEAR_WINDOW))
    parser.add_argument("--input-bytes", type=int, help="total input size, to size the shuffles")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> Refreshed:
    args = arguments(argv)
    spark = configure(
        SparkSession.builder.appName("macrotide-refresh"), input_bytes=args.input_bytes
    ).getOrCreate()
    done = refresh(
        spark, *read_feeds(spark, args), args.database, args.folder, years=tuple(args.years), damaged=damaged_feeds(spark, args),
    )
    for frame in (done.summary, done.described, done.checks, done.constraints, done.counts, done.rejected, *done.unmapped.values()):
        frame.show(10, truncate=False)
    return done


if __name__ == "__main__":
    main()
