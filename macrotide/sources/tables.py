"""Tables by name, SQL text and external databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    return spark.createDataFrame(list(rows), columns)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def run_query(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL text; ``{name}`` in it stands for a frame. Errors are raised, not hidden."""
    return spark.sql(query, **frames)


def load_table(spark: SparkSession, name: str, query: str | None = None) -> DataFrame:
    return spark.table(name) if query is None else run_query(spark, query)


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
    partition_column: str | None = None, bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """External table. With a partition column (``year``, say) it is read by several tasks."""
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    lower, upper = bounds
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=dict(properties),
    )


def inflation_page(inflation_rates: DataFrame, countries: DataFrame) -> DataFrame:
    """Rates with country names, newest first. Rates of unlisted countries have no name."""
    names = countries.select("country_code", "country_name")
    return (
        inflation_rates.filter(F.col("inflation_rate").isNotNull())
        .drop("country_name")
        .join(names, "country_code", "left")
        .select(
            "country_code", "country_name", "year", "inflation_rate",
            "inflation_indicator", "inflation_category",
        )
        .orderBy(F.desc("year"), "country_code")
    )
