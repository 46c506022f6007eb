import pytest
from pyspark.sql import functions as F

from macrotide.functions import (
    correlation_strength, health_score, inflation_category, inflation_delta, load_time_rate,
    money_text, nan_to_null, normalize_percentage, parse_date, parse_number, parse_year,
    percent_text, real_wage, strip, strip_punctuation, wage_inflation_relationship,
)


def column(spark, inputs, type_, f):
    """f applied to each input, in order."""
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {type_}")
    return [r[0] for r in frame.select("i", f(F.col("v")).alias("y")).orderBy("i").select("y").collect()]


@pytest.mark.parametrize("fmt, expected", [
    ("auto", [5.2, 0.052, 1.5, 1.5, 0.255, 0.025, 10.0, -10.0, -0.2, None]),
    ("percentage", [0.052, 0.00052, 1.5, 0.015, 0.255, 0.00025, 0.1, -0.1, -0.2, None]),
    ("decimal", [5.2, 0.052, 150.0, 1.5, 25.5, 0.025, 10.0, -10.0, -20.0, None]),
    ("anything else", [5.2, 0.052, 150.0, 1.5, 25.5, 0.025, 10.0, -10.0, -20.0, None]),
])
def test_normalize_percentage(spark, fmt, expected):
    inputs = [5.2, 0.052, 150.0, 1.5, 25.5, 0.025, 10.0, -10.0, -20.0, None]
    got = column(spark, inputs, "double", lambda v: normalize_percentage(v, fmt))
    assert got == pytest.approx(expected)


def test_normalize_percentage_of_text_and_nan(spark):
    assert column(spark, ["25.5", "abc", "", None], "string", normalize_percentage) == [0.255, None, None, None]
    assert column(spark, [float("nan"), 1.0], "double", normalize_percentage) == [None, 1.0]


def test_percent_rules_in_order(spark):
    inputs = [5.2, 150.0, 25.5, 1.5, 0.7, -5.0, 12.0, 103.98, 98.24, -20.0, 1.0]
    got = column(spark, inputs, "double", lambda v: load_time_rate(normalize_percentage(v)))
    assert got == pytest.approx([0.052, 0.015, 0.255, 0.015, 0.7, -5.0, 0.12, 0.010398, 0.9824, -0.2, 1.0])


def test_inflation_category_edges(spark):
    inputs = [-0.0001, 0.0, 0.02, 0.0201, 0.05, 0.0501, 0.10, 0.1001, None]
    assert column(spark, inputs, "double", inflation_category) == [
        "Deflation", "Low", "Low", "Moderate", "Moderate", "High", "High", "Very High", "Very High",
    ]


def test_health_score_edges(spark):
    rates = [0.01, 0.03, 0.0301, 0.05, 0.0501, 0.10, 0.1001, 0.0099, -0.01, -0.0101, None]
    high = column(spark, rates, "double", lambda v: health_score(v, F.lit(100.5)))
    par = column(spark, rates, "double", lambda v: health_score(v, F.lit(100.0)))
    unknown = column(spark, rates, "double", lambda v: health_score(v, F.lit(None).cast("double")))
    assert high == [5, 5, 4, 4, 2, 2, 1, 3, 3, 2, 2]
    assert par == unknown == [4, 4, 4, 4, 2, 2, 1, 3, 3, 2, 2]


def test_real_wage(spark):
    got = column(spark, [0.25, 0.0, -1.0, None], "double", lambda v: real_wage(F.lit(50000.0), v))
    assert got == [40000.0, 50000.0, None, None]


def test_labels(spark):
    assert column(spark, [101.0, 99.0, 100.0], "double", lambda v: wage_inflation_relationship(v, F.lit(100.0))) == [
        "Wage Growth Outpacing Inflation", "Inflation Outpacing Wage Growth", "Balanced",
    ]
    assert column(spark, [0.71, -0.71, 0.7, 0.41, 0.4, None], "double", correlation_strength) == [
        "Strong", "Strong", "Moderate", "Moderate", "Weak", "Weak",
    ]
    assert column(spark, [0.03, 0.02, 0.01], "double", inflation_delta) == [pytest.approx(0.01), None, None]


def test_parse_number(spark):
    inputs = ["5", " -2.5 ", "1e3", ".5", "5.", "5d", "1.5f", "0x1p3", "inf", "NaN", "..", "", "1,000", None]
    assert column(spark, inputs, "string", parse_number) == [
        5.0, -2.5, 1000.0, 0.5, 5.0, None, None, None, None, None, None, None, None, None,
    ]


def test_parse_year(spark):
    inputs = ["2015", "2015.0", " 2015 ", "2015.5", "n/a", "", None]
    assert column(spark, inputs, "string", parse_year) == [2015, 2015, 2015, None, None, None, None]


def test_parse_date(spark):
    inputs = ["2020", "2020-03", "2020-03-05", "2020M03", "2020M3", "2020/03/05", "03/05/2020", "Mar 2020", "later", None]
    got = [d and d.isoformat() for d in column(spark, inputs, "string", parse_date)]
    assert got == [
        "2020-01-01", "2020-03-01", "2020-03-05", "2020-03-01", "2020-03-01", "2020-03-05", "2020-03-05",
        "2020-03-01", None, None,
    ]


def test_text(spark):
    assert column(spark, ["\t a b \n", " "], "string", strip) == ["a b", ""]
    # ASCII word characters only, unless asked otherwise.
    assert column(spark, ["Café (x)!"], "string", lambda v: strip_punctuation(v, keep="()")) == ["Caf (x)"]
    assert column(spark, ["Côte d'Ivoire"], "string", lambda v: strip_punctuation(v, unicode=True)) == ["Côte dIvoire"]
    assert column(spark, [float("nan"), 2.0, None], "double", nan_to_null) == [None, 2.0, None]


def test_display(spark):
    assert column(spark, [0.0525, -0.01, None], "double", percent_text) == ["5.25%", "-1.00%", None]
    assert column(spark, [48500.4, None], "double", money_text) == ["$48,500", None]
    assert column(spark, [12.345], "double", lambda v: money_text(v, 2)) == ["$12.35"]
