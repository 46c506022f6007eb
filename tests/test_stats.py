import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from support import values
from macrotide.operators import analytics, stats, views


def interpolated(numbers, p):
    numbers = sorted(numbers)
    at = p * (len(numbers) - 1)
    low = int(at)
    high = min(low + 1, len(numbers) - 1)
    return numbers[low] + (numbers[high] - numbers[low]) * (at - low)


@pytest.mark.parametrize("accuracy", [20, 100, 50_000])
def test_exact_quantiles_of_awkward_groups(spark, accuracy):
    """Small accuracy makes the brackets narrow, as they are for very large groups."""
    rng = random.Random(7)
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(6000)],
        "constant": [3.0] * 700,
        "third equal": [1.0] * 500 + [rng.random() * 10 for _ in range(1000)],
        "heavy tail": [rng.paretovariate(0.5) for _ in range(900)],
        "one": [5.0], "two": [1.0, 2.0], "negative zero": [0.0, -0.0, 1.0],
    }
    rows = [(g, v) for g, numbers in groups.items() for v in numbers] + [("hot", None), (None, 1.0), ("hot", float("nan"))]
    rng.shuffle(rows)
    probabilities = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    frame = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in stats.exact_quantiles(frame, "g", "v", probabilities, accuracy).collect()}
    assert got.keys() == groups.keys()
    for g, numbers in groups.items():
        assert got[g].n == len(numbers)
        assert (got[g].low, got[g].high) == (min(numbers), max(numbers))
        for i, p in enumerate(probabilities, 1):
            assert got[g][f"q{i}"] == pytest.approx(interpolated(numbers, p)), (g, p)


def test_box_stats(spark):
    rates = [-0.1, -0.3, 0.01, 0.03, 0.03, 0.04, 0.07, 0.5, 0.7, 1.5, None]
    frame = spark.createDataFrame([(r,) for r in rates], "inflation_rate double")
    got = {r.inflation_category: tuple(r)[1:] for r in stats.box_stats(frame).collect()}
    assert got["Very High"] == pytest.approx((3, 0.5, 0.6, 0.7, 1.1, 1.5))
    assert got["Low"] == pytest.approx((1, 0.01, 0.01, 0.01, 0.01, 0.01))
    assert set(got) == {"Deflation", "Low", "Moderate", "High", "Very High"}


def test_histogram(spark):
    frame = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 5, 9.99, 10]] + [(None,)], "inflation_rate double")
    assert values(stats.histogram(frame, bins=10), "bin", "frequency") == [(0, 2), (1, 1), (5, 1), (9, 2)]
    same = spark.createDataFrame([(2.0,), (2.0,)], "inflation_rate double")
    assert values(stats.histogram(same)) == [(0, 2.0, 2.0, 2)]
    assert stats.histogram(same.limit(0)).count() == 0


def test_correlation_and_trend(spark):
    frame = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 5.0, 1.0), (3.0, 7.0, 1.0)], "x double, y double, k double")
    cells = {(r.x, r.y): r.r for r in stats.corr_matrix(frame, ["x", "y", "k"]).collect()}
    assert len(cells) == 9 and cells["x", "y"] == cells["y", "x"] == pytest.approx(1.0)
    assert cells["x", "x"] == 1.0 and cells["k", "k"] is None
    assert values(stats.trend_line(frame, "k", "y"), "trend") == [None, None, None]
    partial = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (9.0, None), (None, 9.0)], "inflation_rate double, avg_annual_wage double")
    assert tuple(analytics.inflation_wage_correlation(partial).first()) == (pytest.approx(-1.0), "Strong")
    assert tuple(analytics.inflation_wage_correlation(partial.limit(0)).first()) == (None, "Weak")
    line = stats.trend_line(frame, "x", "y").orderBy("x").collect()
    assert [r.trend for r in line] == pytest.approx([3.0, 5.0, 7.0])


def test_group_trend(spark):
    frame = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, 3.0), ("b", 2000, 9.0)], "commodity string, year int, avg_annual_price double")
    got = {(r.commodity, r.year): r.trend for r in analytics.commodity_trends(frame).collect()}
    assert got["a", 2001] == pytest.approx(3.0) and got["b", 2000] is None


def test_commodity_stats_and_texts(spark):
    frame = spark.createDataFrame([("a", 2001, 1.0), ("a", 2000, 3.0), ("b", 2000, 9.0)], "commodity string, year int, avg_annual_price double")
    got = values(analytics.commodity_stats(frame))
    assert got == [("a", 2.0, 1.0, 3.0, pytest.approx(2 ** 0.5), False), ("b", 9.0, 9.0, 9.0, None, False)]
    texts = analytics.commodity_stats_display(analytics.commodity_stats(frame)).filter("commodity = 'a'").first()
    assert tuple(texts) == ("a", "$2.00", "$1.00", "$3.00", "1.41", False)


def test_summary_and_description(spark):
    frame = spark.createDataFrame([("A", 2000, 1.0), ("A", 2001, 3.0), ("B", 2001, None)], "country_code string, year int, inflation_rate double")
    assert tuple(stats.summary(frame).first()) == (3, 2, 2, 2000, 2001)
    assert tuple(stats.summary(frame.limit(0)).first()) == (0, 0, 0, None, None)
    assert tuple(stats.describe_numeric(frame).first()) == ("inflation_rate", 2, 2.0, pytest.approx(2 ** 0.5), 1.0, 3.0)


def test_change_first_to_last(spark):
    frame = spark.createDataFrame(
        [("A", 2001, 110.0), ("A", 2000, 100.0), ("B", 2000, 0.0), ("B", 2001, 1.0), (None, 2000, 1.0)],
        "country_code string, year int, v double",
    )
    assert values(stats.change_first_to_last(frame, "country_code", "v")) == [("A", pytest.approx(10.0)), ("B", None)]


def test_small_frame_means(spark):
    frame = spark.createDataFrame([
        ("USA", "United States", 2020, 0.012), ("GBR", "United Kingdom", 2020, 0.009), ("DEU", "Germany", 2020, 0.004),
        ("USA", "United States", 2021, 0.047), ("GBR", "United Kingdom", 2021, 0.026), ("DEU", "Germany", 2021, 0.032),
        (None, None, 2021, 9.0),
    ], "country_code string, country_name string, year int, inflation_rate double")
    means = stats.group_mean(frame, ["country_code", "country_name"])
    assert {r.country_code: r.inflation_rate for r in means.collect()} == pytest.approx({"USA": 0.0295, "GBR": 0.0175, "DEU": 0.018})
    assert [r[0] for r in analytics.inflation_ranking(frame).collect()] == ["USA", "DEU", "GBR"]


def test_rank_equals_window_rank(spark):
    frame = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 11)).alias("country_code"),
        (F.lit(2020) + F.col("id") % 7).cast("int").alias("year"), F.col("id").alias("v"),
    )
    got = views.rank_latest(frame, "country_code", "year", "r")
    want = frame.withColumn("r", F.rank().over(Window.partitionBy("country_code").orderBy(F.desc("year"))).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_selections_that_compare_nothing(spark):
    frame = spark.createDataFrame([("A", "a", 2000, "CPI", 1.0)], "country_code string, country_name string, year int, inflation_indicator string, inflation_rate double")
    assert analytics.comparison_stats(frame, ["A"]).count() == 0
    assert analytics.comparison_series(frame, ["A"]).count() == 0
    assert analytics.comparison_series(frame, ["A", "B"]).count() == 1
    assert analytics.select_rows(frame, []).count() == 0
    with pytest.raises(ValueError):
        analytics.data_explorer({}, "Weather", [], (2000, 2001))


def test_names_follow_the_latest_year(spark):
    frame = spark.createDataFrame([("A", "old", 2000), ("A", "new", 2005), ("A", "mid", 2003)], "country_code string, country_name string, year int")
    assert values(analytics.latest_names(frame)) == [("A", "new")]


def test_kpis(spark):
    rates = spark.createDataFrame([("A", 2000, 0.01), ("A", 2001, 0.05), ("B", 2001, 0.5)], "country_code string, year int, inflation_rate double")
    wages = spark.createDataFrame([("A", 2000, 100.0), ("A", 2001, None)], "country_code string, year int, avg_annual_wage double")
    assert tuple(analytics.kpis(rates, wages, ["A"], (2000, 2001)).first()) == (pytest.approx(0.03), pytest.approx(0.01), 100.0, 1, 2)
    assert tuple(analytics.kpis(rates, wages, ["A"], (2000, 2000)).first())[:3] == (0.01, None, 100.0)
    assert tuple(analytics.kpis(rates, wages, ["A"], (2001, 2001)).first())[2] is None
    assert tuple(analytics.kpis(rates, wages, [], (2000, 2023)).first()) == (0.0245, 0.0045, 48500.0, 0, 24)


def test_filter_options(spark):
    rates = spark.createDataFrame(
        [(f"C{i}", f"name {i}", 2000 + i, kind) for i in range(7) for kind in ("A", "CPI")],
        "country_code string, country_name string, year int, inflation_indicator string",
    )
    prices = spark.createDataFrame([(c,) for c in "fedcba"], "commodity string")
    options = {(r.kind, r.value): (r.label, r.preselected) for r in analytics.filter_options(rates, prices).collect()}
    assert len(options) == 7 + 6 + 2 + 2
    assert [v for (k, v), (_, chosen) in sorted(options.items()) if k == "country" and chosen] == ["C0", "C1", "C2", "C3", "C4"]
    assert [v for (k, v), (_, chosen) in sorted(options.items()) if k == "commodity" and chosen] == ["a", "b", "c", "d"]
    assert options["indicator", "CPI"] == ("CPI", True) and options["indicator", "A"] == ("A", False)
    assert options["first_year", "2000"][1] and options["last_year", "2006"][1]
