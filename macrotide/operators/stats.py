"""Statistics: means, summaries, quantiles, histograms, correlation, least-squares lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.functions.bands import inflation_category
from macrotide.operators.clean import has_value
from macrotide.operators.joins import join_unique

SUMMARY_COLUMNS = ("inflation_rate", "avg_annual_wage", "commodity_price_index")


def group_mean(
    df: DataFrame, keys: Sequence[str], value: str = "inflation_rate", into: str | None = None
) -> DataFrame:
    """Mean by group; rows with a null key belong to no group."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.avg(value).alias(into or value))


def spread(value: str) -> list[Column]:
    """Mean, sample deviation, minimum and maximum, rounded half-even to 4 digits."""
    column = F.col(value)
    measures = {
        "mean": F.avg(column), "std_dev": F.stddev_samp(column),
        "min": F.min(column), "max": F.max(column),
    }
    return [F.bround(m, 4).alias(name) for name, m in measures.items()]


def summary(df: DataFrame) -> DataFrame:
    """Row count, numbers of countries and years and the year span, in one pass.

    Rows are counted per country and year first: several distinct counts over the rows
    themselves would make Spark copy each row once per count. A null is one more country or year.
    """
    def distinct(column: str) -> Column:
        return F.countDistinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))

    return df.groupBy("country_code", "year").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        distinct("country_code").alias("countries"),
        distinct("year").alias("years"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str] = SUMMARY_COLUMNS) -> DataFrame:
    """Count, mean, deviation, minimum and maximum per existing column, in one pass."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "column string, count long, mean double, stddev double, min double, max double")
    one_row = df.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(c)
        for c in present
    ])
    return one_row.select(F.inline(F.array(*[F.col(c) for c in present])))


def histogram(df: DataFrame, value: str = "inflation_rate", bins: int = 30) -> DataFrame:
    """Counts in equal-width bins over the value range; empty bins are left out."""
    rows = df.filter(has_value(value)).select(value)
    edge = rows.agg(
        F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("edge")
    ).scalar()
    low, high = F.col("__edge.low"), F.col("__edge.high")
    at = F.when(high > low, F.least(F.floor((F.col(value) - low) * bins / (high - low)), F.lit(bins - 1)))
    width = (high - low) / bins
    bin_ = F.coalesce(at, F.lit(0)).cast("int")
    return (
        rows.withColumn("__edge", edge)
        .groupBy(bin_.alias("bin"), (low + bin_ * width).alias("bin_start"),
                 (low + (bin_ + 1) * width).alias("bin_end"))
        .agg(F.count("*").alias("frequency"))
    )


def exact_quantiles(
    rows: DataFrame, group: str, value: str, probabilities: Sequence[float],
    accuracy: int = 50_000,
) -> DataFrame:
    """Exact interpolated quantiles per group, with count, minimum and maximum.

    ``percentile`` would hold the values of a group in one task. Instead a sketch of bounded
    size brackets each quantile: its rank error is at most n / accuracy, so the brackets,
    three errors wide on each side, contain the ranks wanted. One counting pass then
    keeps one count per distinct value inside the brackets and one for each stretch between
    them, which is all that has to be ordered; no row is copied. Where three errors are less than a rank, as in
    small groups, the bracket reaches to the ends.

    The brackets are one row per group; where they turn out small, adaptive execution
    broadcasts them.
    """
    rows = rows.select(group, value).filter(F.col(group).isNotNull() & has_value(value))
    margin = 3.0 / accuracy
    marks = [edge for p in probabilities for edge in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = rows.groupBy(group).agg(
        F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"),
        F.percentile_approx(value, marks, accuracy).alias("marks"),
    )
    few = F.col("n") * margin < 3
    edges = []
    for i, p in enumerate(probabilities):
        lower = F.when(few | F.lit(p - margin <= 0), F.col("low")).otherwise(F.col("marks")[2 * i])
        upper = F.when(few | F.lit(p + margin >= 1), F.col("high")).otherwise(F.col("marks")[2 * i + 1])
        edges += [lower.alias(f"__lower{i}"), upper.alias(f"__upper{i}")]
    bounds = sketch.select(group, "n", "low", "high", *edges)
    bracketed = join_unique(rows, bounds, [group], "inner")
    brackets = [(F.col(f"__lower{i}"), F.col(f"__upper{i}")) for i in range(len(probabilities))]
    v = F.col(value)
    inside = reduce(Column.__or__, [v.between(lower, upper) for lower, upper in brackets])
    # a value between brackets counts behind the end of the last bracket below it
    before = reduce(lambda a, b: F.greatest(a, b), [F.when(upper < v, upper) for _, upper in brackets] + [F.lit(None).cast("double")])
    keys = [group, "n", "low", "high"]
    cells = bracketed.groupBy(*keys, F.when(inside, v).otherwise(before).alias("cell"), (~inside).alias("between")).agg(F.count("*").alias("c"))
    running = Window.partitionBy(group).orderBy(F.asc_nulls_first("cell"), "between").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    end = F.col("end")
    start = end - F.col("c")

    def quantile(p: float) -> Column:
        position = F.lit(float(p)) * (F.col("n") - 1)

        def value_at(rank: Column) -> Column:
            return F.max(F.when((start <= rank) & (rank < end), F.col("cell")))

        below, above = value_at(F.floor(position)), value_at(F.ceil(position))
        share = F.max(position - F.floor(position))
        return below + (above - below) * share

    return cells.withColumn("end", F.sum("c").over(running)).groupBy(*keys).agg(
        *[quantile(p).alias(f"q{i + 1}") for i, p in enumerate(probabilities)])


def box_stats(df: DataFrame, value: str = "inflation_rate") -> DataFrame:
    """Five-number summary of the rates in each inflation band."""
    rows = df.select(inflation_category(F.col(value)).alias("inflation_category"), value)
    quartiles = exact_quantiles(rows, "inflation_category", value, (0.25, 0.5, 0.75))
    return quartiles.select(
        "inflation_category", F.col("n").alias("count"), F.col("low").alias("min"),
        "q1", F.col("q2").alias("median"), "q3", F.col("high").alias("max"),
    )


def pearson(x: str, y: str) -> Column:
    """Correlation over the rows that have both; null where one of them does not vary
    (``corr`` divides by zero there)."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    deviations = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), deviations)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns as (x, y, r), in one pass."""
    pairs = list(combinations(columns, 2))
    own = [F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"own_{i}") for i, c in enumerate(columns)]
    one_row = df.agg(*own, *[pearson(x, y).alias(f"pair_{i}") for i, (x, y) in enumerate(pairs)])

    def cell(x: str, y: str, r: str) -> Column:
        return F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(r).alias("r"))

    cells = [cell(c, c, f"own_{i}") for i, c in enumerate(columns)]
    for i, (x, y) in enumerate(pairs):
        cells += [cell(x, y, f"pair_{i}"), cell(y, x, f"pair_{i}")]
    return one_row.select(F.inline(F.array(*cells)))


def trend_line(df: DataFrame, x: str, y: str, into: str = "trend") -> DataFrame:
    """Least-squares line of y on x over all rows, its value at each row added."""
    fit = df.agg(
        F.struct(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")).alias("fit")
    ).scalar()
    return (
        df.withColumn("__fit", fit)
        .withColumn(into, F.col("__fit.slope") * F.col(x) + F.col("__fit.intercept"))
        .drop("__fit")
    )


def group_trend(df: DataFrame, group: str, x: str, y: str, into: str = "trend") -> DataFrame:
    """Least-squares line per group with more than one row, null in groups of one."""
    fits = df.groupBy(group).agg(
        F.count("*").alias("__n"), F.regr_slope(y, x).alias("__slope"),
        F.regr_intercept(y, x).alias("__intercept"),
    )
    line = F.col("__slope") * F.col(x) + F.col("__intercept")
    return (
        join_unique(df, fits, [group], "inner")
        .withColumn(into, F.when(F.col("__n") > 1, line))
        .select(*df.columns, into)
    )


def change_first_to_last(
    df: DataFrame, entity: str, value: str, order: str = "year", into: str = "change_pct"
) -> DataFrame:
    """Percent change from the earliest to the latest value of each entity. Of several values
    of one year the smallest is taken, so the order of the rows does not matter."""
    return (
        df.na.drop(subset=[entity, order])
        .groupBy(entity, order)
        .agg(F.min(value).alias("__value"))
        .groupBy(entity)
        .agg(F.min_by("__value", order).alias("__first"), F.max_by("__value", order).alias("__last"))
        .select(entity, ((F.try_divide("__last", "__first") - 1) * 100).alias(into))
    )
