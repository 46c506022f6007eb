"""Registered queries: name -> function of (spark, folder with the Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.country import CountryLookup
from macrotide.functions import normalize_percentage, load_time_rate, inflation_category
from macrotide.operators import analytics, clean, load, quality, reshape, sinks, standardize, stats, views
from macrotide.plans import bindings as b
from macrotide.plans.bindings import BASKET, COMMODITIES, COUNTRIES, INDICATORS, WINDOW, YEARS, Tables
from macrotide.plans.refresh import refresh
from macrotide.schemas import INFLATION_FEED, TABLES
from macrotide.session import new_folder
from macrotide.sources import csv_feed, damaged, json_feed, tables, xml_feed

Query = Callable[[Tables], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f: Query):
        return lambda spark, folder: f(Tables(spark, folder))
    return {name: bind(f) for name, f in _QUERIES.items()}


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Round what was summed, as another order of summing may differ in the last digits. The
    shift keeps exact halves (a mean of cents over 32 rows, say) off the rounding edge."""
    return df.withColumns({c: F.round(F.col(f"`{c}`") + 2e-8, digits) for c in columns})


MERGED_VALUES = [
    "inflation_rate", "avg_annual_wage", "unit_labour_cost", "hourly_earnings_growth",
    "real_wage_index", "5-LOW", "commodity_price_index", "real_wage_adjusted",
]


# Cleaning and merging

@query
def merge_datasets(t: Tables) -> DataFrame:
    return rounded(b.merged(t), MERGED_VALUES)


@query
def merge_one_indicator(t: Tables) -> DataFrame:
    merged = b.merge_datasets(
        b.inflation(t), b.annual_prices(t), b.wages(t), b.BASKET, YEARS, indicator=INDICATORS[0]
    )
    return rounded(merged, MERGED_VALUES)


@query
def load_inflation(t: Tables) -> DataFrame:
    return clean.clean_inflation(b.inflation_feed(t), WINDOW)


@query
def load_inflation_default_years(t: Tables) -> DataFrame:
    return clean.clean_inflation(b.inflation_feed(t))


@query
def load_commodity(t: Tables) -> DataFrame:
    return rounded(clean.clean_commodities(b.commodity_feed(t), WINDOW), ["avg_annual_price"])


@query
def load_wage_pivot(t: Tables) -> DataFrame:
    wages = clean.clean_wages(b.wage_feed(t), WINDOW, b.WAGE_INDICATORS)
    return rounded(wages, list(b.WAGE_INDICATORS.values()))


@query
def wide_to_long(t: Tables) -> DataFrame:
    """A sheet with a period column and one column per commodity, turned long again."""
    monthly = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.date_format("l_shipdate", "yyyy'M'MM").alias("Period"), "p_type",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )
    sheet = reshape.long_to_wide(
        monthly, ["Period"], "p_type", {c: f" {c} " for c in COMMODITIES}, F.avg, "price"
    ).withColumn("Unnamed: 7", F.lit("note"))
    return rounded(clean.clean_commodity_sheet(sheet), ["price"])


@query
def oecd_clean(t: Tables) -> DataFrame:
    table = b.wage_feed(t).select(
        F.col("country_code").alias("LOCATION"),
        F.concat(F.col("year").cast("string"), F.lit(".0")).alias("Time"),
        F.when(F.col("indicator") != "5-LOW", F.col("value").cast("string")).otherwise("n/a").alias("OBS_VALUE"),
        F.lit("unused").alias("FLAG"),
    )
    return rounded(clean.clean_wage_table(table, "AWE"), ["value"])


@query
def union_indicators(t: Tables) -> DataFrame:
    """Row-level feeds of two indicators, one without names, and one that could not be read."""
    base = t.lineitem.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("country_code"),
        F.year("l_shipdate").alias("year"), "l_discount", "l_tax",
    )
    catalogue = F.lit("FP.CPI.TOTL.ZG"), F.lit("Inflation, consumer prices (annual %)")
    discount = base.select(
        "country_code", F.lit("any").alias("country_name"), catalogue[0].alias("indicator_code"),
        catalogue[1].alias("indicator_name"), "year", (F.col("l_discount") + 0.0).alias("value"),
    )
    tax = base.select(
        "country_code", F.lit("TAX").alias("indicator_code"), "year", (F.col("l_tax") + 0.0).alias("value")
    )
    feeds = reshape.union_feeds([discount, None, tax], INFLATION_FEED, t.spark)
    return json_feed.select_feed(feeds, years=WINDOW)


# Percent rules and country codes

@query
def normalize_percentage_auto(t: Tables) -> DataFrame:
    return _normalized(t, "auto")


@query
def normalize_percentage_percentage(t: Tables) -> DataFrame:
    return _normalized(t, "percentage")


@query
def normalize_percentage_decimal(t: Tables) -> DataFrame:
    return _normalized(t, "decimal")


def _normalized(t: Tables, current_format: str) -> DataFrame:
    value = normalize_percentage(F.col("value"), current_format)
    return b.rate_rows(t).withColumn("value", value)


@query
def normalize_columns(t: Tables) -> DataFrame:
    """A number column, a text column with unparseable entries and one that is not there."""
    rows = b.rate_rows(t).withColumn(
        "reported", F.when(F.col("l_linenumber") == 1, "..").otherwise(F.col("value").cast("string"))
    )
    return standardize.normalize_columns(rows, ["value", "reported", "absent"])


@query
def percent_rules_composed(t: Tables) -> DataFrame:
    """Both percent rules in order, then rows per inflation band and year."""
    rate = load_time_rate(normalize_percentage(F.col("value")))
    return (
        b.rate_rows(t).withColumn("inflation_category", inflation_category(rate))
        .groupBy("year", "inflation_category").agg(F.count("*").alias("rows"))
    )


@query
def standardize_country(t: Tables) -> DataFrame:
    mapped, _ = standardize.standardize_countries(b.country_spellings(t), b.country_lookup())
    return mapped


@query
def unmapped_codes(t: Tables) -> DataFrame:
    _, unmapped = standardize.standardize_countries(b.country_spellings(t), b.country_lookup())
    return unmapped


# Views and documented questions

@query
def latest_economic_data(t: Tables) -> DataFrame:
    latest = views.latest_economic_data(b.merged(t), since=1999)
    return rounded(latest, ["inflation_rate", "avg_annual_wage", "real_wage_adjusted"])


@query
def latest_only(t: Tables) -> DataFrame:
    latest = views.latest_economic_data(b.merged(t), since=1999, latest_only=True)
    return rounded(latest, ["inflation_rate", "avg_annual_wage", "real_wage_adjusted"])


@query
def high_inflation(t: Tables) -> DataFrame:
    return rounded(views.high_inflation(b.merged(t)), ["inflation_rate"])


@query
def high_inflation_top10(t: Tables) -> DataFrame:
    return rounded(views.top_inflation(b.merged(t), 10, above=0.02), ["inflation_rate"])


@query
def wage_inflation_relationship(t: Tables) -> DataFrame:
    frame = views.wage_inflation(b.merged(t))
    return rounded(frame, ["inflation_rate", "avg_annual_wage", "real_wage_adjusted"])


@query
def wage_inflation_by_country(t: Tables) -> DataFrame:
    frame = views.wage_inflation_by_country(b.merged(t), since=1997)
    return rounded(frame, ["avg_inflation", "avg_real_wage"])


@query
def avg_and_max_by_country(t: Tables) -> DataFrame:
    frame = views.avg_and_max_by_country(b.merged(t))
    return rounded(frame, ["avg_inflation", "max_commodity_price"])


@query
def coverage(t: Tables) -> DataFrame:
    return views.coverage(b.merged(t))


@query
def anomalies(t: Tables) -> DataFrame:
    rates = b.rate_rows(t).select(
        F.col("category").alias("country_code"), "year", F.col("value").alias("inflation_rate")
    )
    return views.anomalies(rates)


@query
def inflation_page(t: Tables) -> DataFrame:
    rates = b.inflation(t).withColumn("inflation_category", inflation_category(F.col("inflation_rate")))
    return rounded(tables.inflation_page(rates, b.country(t)), ["inflation_rate"])


@query
def sql_over_frames(t: Tables) -> DataFrame:
    frame = tables.run_query(
        t.spark,
        """SELECT country_name, count(*) AS n, avg(inflation_rate) AS avg_inflation
           FROM {rates} WHERE year >= 1998 GROUP BY country_name""",
        rates=b.inflation(t),
    )
    return rounded(frame, ["avg_inflation"])


# Summaries and statistics

@query
def summary(t: Tables) -> DataFrame:
    """Some rows without a code, some without a year: both count as one more."""
    code, year = F.col("country_code"), F.col("year")
    return stats.summary(b.merged(t).withColumns({
        "country_code": F.when(code != "N05", code), "year": F.when(year != 1999, year)}))


@query
def describe_numeric(t: Tables) -> DataFrame:
    return rounded(stats.describe_numeric(b.merged(t)), ["mean", "stddev", "min", "max"], 4)


@query
def table_counts(t: Tables) -> DataFrame:
    return quality.table_counts(t.spark, {
        "countries": b.country(t), "inflation_rates": b.inflation_feed(t),
        "wage_index": b.wages(t), "commodity_prices": b.commodity_feed(t),
        "economic_indicators": b.merged(t), "not_there": None,
    }, total="all")


@query
def kpis(t: Tables) -> DataFrame:
    frame = analytics.kpis(b.inflation(t), b.wages(t), COUNTRIES, YEARS)
    return rounded(frame, ["avg_inflation", "inflation_delta", "avg_wage"], 5)


@query
def inflation_over_time(t: Tables) -> DataFrame:
    return rounded(analytics.inflation_over_time(b.inflation(t), COUNTRIES, WINDOW), ["inflation_rate"])


@query
def avg_by_country(t: Tables) -> DataFrame:
    return rounded(analytics.avg_by_country(b.inflation(t), COUNTRIES, WINDOW), ["inflation_rate"])


@query
def inflation_wage_join(t: Tables) -> DataFrame:
    return rounded(_joined(t), ["inflation_rate", "avg_annual_wage"])


def _joined(t: Tables) -> DataFrame:
    return analytics.inflation_wage_join(b.inflation(t), b.wages(t), COUNTRIES, YEARS)


@query
def correlation(t: Tables) -> DataFrame:
    return rounded(analytics.inflation_wage_correlation(_joined(t)), ["correlation"])


@query
def corr_matrix(t: Tables) -> DataFrame:
    return rounded(analytics.inflation_wage_matrix(_joined(t)), ["r"])


@query
def corr_matrix_rows(t: Tables) -> DataFrame:
    """Correlation of four measures over all rows."""
    rows = t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return rounded(stats.corr_matrix(rows, rows.columns), ["r"])


@query
def trend_line(t: Tables) -> DataFrame:
    frame = analytics.inflation_wage_trend(_joined(t))
    return rounded(frame, ["inflation_rate", "avg_annual_wage", "trend"], 4)


@query
def commodity_trends(t: Tables) -> DataFrame:
    frame = analytics.commodity_trends(b.annual_prices(t), COMMODITIES, YEARS)
    return rounded(frame, ["avg_annual_price", "trend"], 4)


@query
def commodity_stats(t: Tables) -> DataFrame:
    frame = analytics.commodity_stats(b.annual_prices(t), COMMODITIES, YEARS)
    return rounded(frame, ["avg_price", "min_price", "max_price", "volatility"])


@query
def data_explorer(t: Tables) -> DataFrame:
    frames = {
        "inflation_rates": b.inflation(t), "wage_index": b.wages(t),
        "commodity_prices": b.annual_prices(t),
    }
    return rounded(
        analytics.data_explorer(frames, "Inflation Rates", COUNTRIES, WINDOW), ["inflation_rate"]
    )


@query
def data_explorer_prices(t: Tables) -> DataFrame:
    prices = b.commodity_feed(t).withColumn("commodity", F.trim(F.regexp_replace("commodity", "[^A-Z]", "")))
    return analytics.data_explorer({"commodity_prices": prices}, "Commodity Prices", b.BASKET, WINDOW)


@query
def filter_options(t: Tables) -> DataFrame:
    return analytics.filter_options(b.inflation(t), b.annual_prices(t))


@query
def heatmap(t: Tables) -> DataFrame:
    years = list(range(YEARS[0], YEARS[1] + 1))
    frame = analytics.heatmap(b.inflation(t), years, COUNTRIES, INDICATORS[0])
    return rounded(frame, [str(y) for y in years])


@query
def histogram(t: Tables) -> DataFrame:
    rates = b.rate_rows(t).withColumn("inflation_rate", load_time_rate(F.col("value")))
    return rounded(stats.histogram(rates), ["bin_start", "bin_end"])


@query
def box_stats(t: Tables) -> DataFrame:
    rates = b.rate_rows(t).withColumn("inflation_rate", load_time_rate(F.col("value")))
    return rounded(stats.box_stats(rates), ["min", "q1", "median", "q3", "max"])


@query
def price_quantiles(t: Tables) -> DataFrame:
    """Deciles and quartiles of all unit prices by return flag."""
    prices = t.lineitem.select("l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    frame = stats.exact_quantiles(prices, "l_returnflag", "price", (0.1, 0.25, 0.5, 0.75, 0.9))
    return rounded(frame, ["low", "high", "q1", "q2", "q3", "q4", "q5"])


@query
def volatility(t: Tables) -> DataFrame:
    return analytics.volatility(b.inflation(t), COUNTRIES, WINDOW)


@query
def volatility_texts(t: Tables) -> DataFrame:
    """Percent texts of the rounded statistics."""
    texts = analytics.with_percent_texts(analytics.volatility(b.inflation(t), COUNTRIES, WINDOW))
    return texts.select("country_code", "mean_text", "std_dev_text", "min_text", "max_text")


@query
def comparison_series(t: Tables) -> DataFrame:
    frame = analytics.comparison_series(b.inflation(t), COUNTRIES, YEARS, INDICATORS[2])
    return rounded(frame, ["inflation_rate"])


@query
def comparison_stats(t: Tables) -> DataFrame:
    return analytics.comparison_stats(b.inflation(t), COUNTRIES, WINDOW)


@query
def comparison_display(t: Tables) -> DataFrame:
    return analytics.comparison_display(analytics.comparison_stats(b.inflation(t), COUNTRIES, WINDOW))


@query
def commodity_stats_display(t: Tables) -> DataFrame:
    return analytics.commodity_stats_display(
        analytics.commodity_stats(b.annual_prices(t), COMMODITIES, YEARS)
    )


@query
def year_average(t: Tables) -> DataFrame:
    return rounded(analytics.year_average(b.inflation_feed(t), COUNTRIES, YEARS), ["avg_value"])


@query
def inflation_ranking(t: Tables) -> DataFrame:
    return rounded(analytics.inflation_ranking(b.merged(t)), ["avg_inflation"])


@query
def real_wage_change(t: Tables) -> DataFrame:
    return rounded(analytics.real_wage_change(b.merged(t)), ["change_pct"], 4)


# Integrity

def _remaining(t: Tables) -> DataFrame:
    """Countries left after those of one region were removed."""
    return b.country(t).filter(F.col("region") != "EUROPE")


def _residents(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", b.country_code(F.col("c_nationkey")).alias("country_code"), "c_acctbal")


@query
def orphans(t: Tables) -> DataFrame:
    return quality.orphans(_residents(t), _remaining(t))


@query
def orphan_counts(t: Tables) -> DataFrame:
    return quality.orphan_counts(_residents(t), _remaining(t))


@query
def cascade_delete(t: Tables) -> DataFrame:
    return quality.cascade_delete(_residents(t), _remaining(t))


@query
def range_check(t: Tables) -> DataFrame:
    rates = b.rate_rows(t).withColumn("inflation_rate", normalize_percentage(F.col("value")))
    return rounded(quality.range_check(rates), ["min_rate", "max_rate"])


@query
def recency_check(t: Tables) -> DataFrame:
    return quality.recency_check(b.merged(t), since=2000)


@query
def key_violations(t: Tables) -> DataFrame:
    return quality.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def key_violations_merged(t: Tables) -> DataFrame:
    return quality.key_violations(b.merged(t), TABLES["economic_indicators"].key)


@query
def null_violations(t: Tables) -> DataFrame:
    return quality.null_violations(b.merged(t), ["country_code", "year", "avg_annual_wage", "commodity_price_index"])


@query
def length_violations(t: Tables) -> DataFrame:
    return quality.length_violations(b.country_spellings(t), {"country_code": 3})


@query
def code_violations(t: Tables) -> DataFrame:
    return quality.code_violations(b.country_spellings(t))


@query
def integrity_report(t: Tables) -> DataFrame:
    return quality.validate({
        "countries": _remaining(t), "inflation_rates": b.inflation(t),
        "wage_index": b.wages(t), "economic_indicators": b.merged(t),
    })


@query
def constraint_report(t: Tables) -> DataFrame:
    return quality.constraint_report(b.merged(t), "economic_indicators")


# Loading

@query
def typed_load(t: Tables) -> DataFrame:
    return load.conform(b.merged(t), "economic_indicators")


@query
def typed_load_prices(t: Tables) -> DataFrame:
    prices = b.commodity_feed(t).withColumn("commodity", F.trim(F.regexp_replace("commodity", "[^A-Z]", "")))
    return load.conform(prices, "commodity_prices")


@query
def typed_load_rates(t: Tables) -> DataFrame:
    return load.conform(b.merged(t), "inflation_rates")


@query
def typed_load_wages(t: Tables) -> DataFrame:
    wages = b.wages(t).withColumn("hourly_earnings_growth", F.col("hourly_earnings_growth") / 100)
    return load.conform(wages, "wage_index")


@query
def rejected_rows(t: Tables) -> DataFrame:
    """Rows that break a rule of a table: customers as countries, codes of two to five characters."""
    rows = t.customer.select(
        F.substring("c_name", -5, F.col("c_custkey") % 4 + 2).alias("country_code"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("country_name"))
    return load.rejected(rows, "countries").groupBy("table", "rule").agg(F.count("*").alias("rows"))


@query
def country_rows(t: Tables) -> DataFrame:
    return load.country_rows(b.inflation(t))


def _price_list(t: Tables, incoming: bool) -> DataFrame:
    rows = t.lineitem.filter((F.col("l_returnflag") == "R") == F.lit(incoming)).select(
        F.col("l_partkey").alias("commodity"), F.year("l_shipdate").alias("year"),
        F.col("l_extendedprice").alias("price"),
    )
    return load.one_per_key(rows, ["commodity", "year"])


@query
def upsert(t: Tables) -> DataFrame:
    """Price list of the returned goods put over that of all others, with marks for the stamps: known
    goods keep their ids, new ones get the next ids in the order of the key."""
    key = ["commodity", "year"]
    existing = load.with_dense_ids(_price_list(t, False), key).withColumns({
        "created_at": F.lit("first"), "updated_at": F.lit("first")})
    return load.upsert(existing, _price_list(t, True), key, now=F.lit("second"))


@query
def cascade_tables(t: Tables) -> DataFrame:
    """Rows that stay in three tables when the countries of a region are deleted."""
    countries = b.country(t)
    tables_ = {"countries": countries, "inflation_rates": b.inflation(t), "wage_index": b.wages(t)}
    left = quality.cascade(tables_, "countries", countries.filter(F.col("region") == "ASIA"))
    counts = [frame.groupBy("country_code").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "country_code", "rows")
              for name, frame in left.items()]
    return reduce(DataFrame.unionByName, counts)


@query
def dense_ids(t: Tables) -> DataFrame:
    """Ids without gaps after the last one given out, in the order of the key."""
    return load.with_dense_ids(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], after=1000)


@query
def serial_ids(t: Tables) -> DataFrame:
    """Ids of all rows: as many as rows, all above the last one given out."""
    return load.with_serial_id(t.lineitem.select("l_orderkey"), after=1000).agg(
        F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), (F.min("id") > 1000).alias("ascending")
    )


# Files written and read back

def _files(t: Tables, name: str, **frames: DataFrame) -> str:
    """A new folder with the frames as CSV, each with columns of its own order."""
    folder = new_folder(t.spark, name)
    for part, frame in frames.items():
        sinks.save(frame, f"{folder}/part={part}", "csv")
    return f"{folder}/*"


@query
def csv_files_inflation(t: Tables) -> DataFrame:
    feed = b.inflation_feed(t)
    odd = F.col("year") % 2 == 1
    return csv_feed.read_inflation(t.spark, _files(t, "inflation", a=feed.filter(odd), b=feed.filter(~odd).select(*reversed(feed.columns))))


@query
def csv_files_commodities(t: Tables) -> DataFrame:
    feed = b.commodity_feed(t).withColumn("price", F.round(F.col("price") + 2e-8, 4) + 0.0)
    return csv_feed.read_commodities(t.spark, _files(t, "prices", a=feed.select("price", "commodity", "month", "year")))


@query
def csv_files_wages(t: Tables) -> DataFrame:
    feed = b.wage_feed(t).withColumn("value", F.round(F.col("value") + 2e-8, 4) + 0.0)
    return csv_feed.read_wages(t.spark, _files(t, "wages", a=feed, b=feed.limit(0).select("value", "year")))


@query
def csv_files_wage_table(t: Tables) -> DataFrame:
    feed = b.wage_feed(t).filter("indicator = '2-HIGH'").select(
        (F.round(F.col("value") + 2e-8, 4) + 0.0).alias("OBS_VALUE"), F.lit("x, y").alias("NOTE"), F.col("year").alias("Time"), F.col("country_code").alias("LOCATION"))
    return csv_feed.read_wage_table(t.spark, _files(t, "table", a=feed), "2-HIGH")


@query
def sheet_files(t: Tables) -> DataFrame:
    """Wide sheets of two headers with three lines above them, one file each."""
    month = F.format_string("%dM%02d", F.year("l_shipdate"), F.month("l_shipdate"))
    prices = t.lineitem.groupBy(month.alias("month")).agg(F.max("l_discount").alias("one"), F.max("l_tax").alias("two")).filter("month IS NOT NULL")
    folder = new_folder(t.spark, "sheets")
    for name, header, cells in (("a", 'Period,Gold,"Oil, crude"', ("month", "one", "two")), ("b", '"Oil, crude",Period,Wheat', ("two", "month", "one"))):
        lines = prices.agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(",", *[F.col(c).cast("string") for c in cells]))), "\n").alias("lines"))
        lines.select(F.concat(F.lit(f"prices\nmonthly\n\n{header}\n"), "lines").alias("value")).write.text(f"{folder}/{name}")
    return csv_feed.read_commodity_sheet(t.spark, f"{folder}/*")


@query
def json_files(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "json")
    sinks.save(b.inflation_feed(t), path, "JSON")
    return t.spark.read.schema(INFLATION_FEED).json(path)


@query
def parquet_by_year(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "parquet")
    sinks.save(b.inflation_feed(t), path, by_year=True)
    return t.spark.read.parquet(path).filter(F.col("year").between(*WINDOW))


@query
def exported_view(t: Tables) -> DataFrame:
    path = sinks.export_view(b.wages(t).select("country_code", "year", F.round(F.col("avg_annual_wage") + 2e-8, 2).alias("wage")), new_folder(t.spark, "export"), "Wage Index")
    return csv_feed.read_csv(t.spark, path).select("country_code", F.col("year").cast("int").alias("year"), F.col("wage").cast("double").alias("wage"))


@query
def view_by_name(t: Tables) -> DataFrame:
    tables.register_views({"wages_by_name": b.wages(t)})
    return tables.load_table(t.spark, "wages_by_name", "SELECT country_code, count(*) AS years FROM wages_by_name GROUP BY country_code")


@query
def xml_files(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "xml")
    text = F.format_string('<Obs REF_AREA="%s" TIME_PERIOD="%d" OBS_VALUE="%s"/>', F.col("country_code"), F.col("year"), F.round(F.col("value") + 2e-8, 2).cast("string"))
    whole = b.wage_feed(t).filter("indicator = '1-URGENT'").groupBy("year").agg(F.concat(
        F.lit("<Data>"), F.array_join(F.collect_list(text), ""), F.lit("</Data>")).alias("value"))
    whole.select("value").write.text(path)
    return xml_feed.read_observations(t.spark, path, "AWE")


@query
def damaged_documents(t: Tables) -> DataFrame:
    """Pages, sheets and XML of which some are cut short or lack what they should have, by feed and rule."""
    k, code = F.col("l_linenumber"), F.col("l_suppkey").cast("string")
    page = F.concat(F.lit('[{"page":1},[{"countryiso3code":"'), code, F.lit('","value":1}]]'))
    pages = F.when(k == 1, F.substring(page, 1, 20)).when(k == 2, F.lit('[{"page":1},{"message":"no"}]')).when(k == 3, F.lit('[{"page":1},null]')).otherwise(page)
    sheet = F.concat(F.lit("a\nb\nc\nPeriod,Gold\n2020M01,"), code)
    sheets = F.when(k == 1, F.lit("a\nb")).when(k == 2, F.replace(sheet, F.lit(",Gold"), F.lit(",\"Gold"))).when(k == 3, F.lit("")).otherwise(sheet)
    xml = F.concat(F.lit('<D><Obs TIME="2020" VALUE="'), code, F.lit('"/></D>'))
    texts = F.when(k == 1, F.replace(xml, F.lit("</D>"), F.lit(""))).when(k == 2, F.lit("plain")).when(k == 3, F.substring(xml, 1, 15)).otherwise(xml)
    found = [f(t.lineitem.select(text.alias("value"))) for f, text in (
        (damaged.damaged_pages, pages), (damaged.damaged_sheets, sheets), (damaged.damaged_xml, texts))]
    return reduce(DataFrame.unionByName, found).groupBy("table", "rule").agg(F.count("*").alias("rows"))


@query
def refreshed_tables(t: Tables) -> DataFrame:
    """The whole job in a database of its own: the rates it holds, with their ids."""
    folder = new_folder(t.spark, "refresh")
    database = "refresh_" + folder.rsplit("-", 1)[-1]
    lookup = CountryLookup([(code, code, f"NATION_{code}", None) for code in COUNTRIES], custom={})
    sinks.create_schema(t.spark, database, f"{folder}/tables")
    # prices per month, so that what is landed stays small
    prices = b.commodity_feed(t).groupBy("year", "month", "commodity").agg(F.round(F.avg("price"), 4).alias("price"))
    hourly = F.col("indicator") == "3-MEDIUM"
    pay = b.wage_feed(t).withColumn("value", F.when(hourly, F.col("value") / 100).otherwise(F.col("value")))
    refresh(t.spark, b.inflation_feed(t), prices, pay, database, f"{folder}/stages", lookup, YEARS, BASKET, b.WAGE_INDICATORS)
    return t.spark.table(f"{database}.inflation_rates").drop("created_at", "updated_at", "inflation_category")


# Source documents, one per row, built from the row and parsed back

@query
def parse_indicator_json(t: Tables) -> DataFrame:
    def record(indicator: str, value) -> Column:
        return F.to_json(F.struct(
            F.struct(F.lit(indicator).alias("id"), F.lit(f"name of {indicator}").alias("value")).alias("indicator"),
            F.struct(F.lit("xx").alias("id"), F.col("l_linestatus").alias("value")).alias("country"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("countryiso3code"),
            F.year("l_shipdate").cast("string").alias("date"),
            value.alias("value"),
        ))
    page = F.concat_ws(
        ",", record("FP.CPI.TOTL.ZG", F.col("l_discount") + 0.0), record("TAX", F.col("l_tax") + 0.0),
        record("TAX", F.lit(None).cast("double")),
    )
    documents = t.lineitem.select(F.concat(F.lit('[{"page":1},['), page, F.lit("]]")).alias("value"))
    return json_feed.parse_indicator_pages(documents)


@query
def parse_country_json(t: Tables) -> DataFrame:
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    level = F.when(F.col("c_mktsegment") == "BUILDING", "NA").otherwise(F.col("c_mktsegment"))
    record = F.to_json(F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("n_name").alias("name"),
        F.lit("Q1").alias("iso2Code"),
        F.struct(F.col("n_regionkey").cast("string").alias("id"), F.col("r_name").alias("value")).alias("region"),
        F.struct(level.alias("id"), F.col("c_mktsegment").alias("value")).alias("incomeLevel"),
    ))
    documents = named.select(F.concat(F.lit('[{"page":1},['), record, F.lit("]]")).alias("value"))
    return json_feed.parse_country_pages(documents)


@query
def parse_csv_feed(t: Tables) -> DataFrame:
    """Sheets of two kinds, which differ in the order of their columns, with three lines above the
    header, a quoted name and an unnamed column."""
    date, gold = F.date_format("l_shipdate", "yyyy'M'MM"), (F.col("l_discount") + 0.0).cast("string")
    oil = F.concat(F.lit('"'), (F.col("l_tax") + 0.0).cast("string"), F.lit('"'))
    above = F.lit("prices\nmonthly\n\n")
    one = F.concat(above, F.lit('Period,Gold,"Oil, crude",\n'), F.concat_ws(",", date, gold, oil, F.lit("note")))
    two = F.concat(above, F.lit('"Oil, crude",,Gold,Period\n'), F.concat_ws(",", oil, F.lit("5"), gold, date))
    documents = t.lineitem.select(F.when(F.col("l_linenumber") % 2 == 0, one).otherwise(two).alias("value"))
    return csv_feed.parse_commodity_sheets(documents)


@query
def parse_xml_feed(t: Tables) -> DataFrame:
    text = F.format_string(
        '<Series REF_AREA="S%d"><Obs TIME_PERIOD="%d" OBS_VALUE="%s"/><Obs TIME_PERIOD="%d" OBS_VALUE="%s"/></Series>',
        F.col("l_suppkey"), F.year("l_shipdate"), (F.col("l_discount") + 0.0).cast("string"),
        F.year("l_shipdate") + 1, (F.col("l_tax") + 0.0).cast("string"),
    )
    schema = "_REF_AREA string, Obs array<struct<_TIME_PERIOD: string, _OBS_VALUE: string>>"
    return xml_feed.parse_wage_documents(t.lineitem.select(text.alias("value")), schema, "AWE")


@query
def parse_observations(t: Tables) -> DataFrame:
    """Documents that mix observation elements of several names, prefixes and depths with others, with attributes in any
    order, escaped text, and elements in comments, which do not count."""
    text = F.format_string(
        '<?xml version="1.0"?><d:Data xmlns:d="urn:x"><!-- <Obs TIME="1900" VALUE="1"/> --><Series REF_AREA="none"><Obs TIME_PERIOD="%d" OBS_VALUE="%s"'
        ' REF_AREA="S%d"/><g:Group><g:Obs OBS_VALUE = \'%s\' NOTE="a &lt; b" COUNTRY="S&amp;%d"\n TIME="%d.0"></g:Obs></g:Group></Series>'
        '<m:OBSERVATION period_time="%d" value="n/a"/><Observations count="2"/><Object TIME="1901" VALUE="2"/></d:Data>',
        F.year("l_shipdate"), (F.col("l_discount") + 0.0).cast("string"), F.col("l_suppkey"), (F.col("l_tax") + 0.0).cast("string"),
        F.col("l_suppkey"), F.year("l_shipdate") + 1, F.col("l_linenumber") + 2000,
    )
    return xml_feed.parse_observations(t.lineitem.select(text.alias("value")), "AWE")
