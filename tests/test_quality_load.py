import pytest
from pyspark.sql import functions as F

from support import values
from macrotide.operators import load, quality
from macrotide.schemas import TABLES


@pytest.fixture
def child(spark):
    return spark.createDataFrame([("A", 1), ("A", 2), ("X", 3), (None, 4)], "country_code string, v int")


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([("A",), ("B",)], "country_code string")


def test_orphans_and_cascade(child, parent):
    assert values(quality.orphans(child, parent)) == [(None, 4), ("X", 3)]
    assert values(quality.orphan_counts(child, parent)) == [(None, 1), ("X", 1)]
    assert values(quality.cascade_delete(child, parent)) == [("A", 1), ("A", 2)]


def test_range_and_recency(spark):
    rates = spark.createDataFrame([(0.1,), (5.0,), (None,)], "inflation_rate double")
    assert tuple(quality.range_check(rates).first()) == (0.1, 5.0, True)
    assert tuple(quality.range_check(rates.limit(0)).first()) == (None, None, None)
    low = spark.createDataFrame([(-0.51,)], "inflation_rate double")
    assert quality.range_check(low).first().passed is False
    years = spark.createDataFrame([(2019,), (None,)], "year int")
    assert tuple(quality.recency_check(years).first()) == (0, False)
    assert quality.recency_check(years, 2019).first().passed is True


def test_keys_nulls_lengths_codes(spark):
    rows = spark.createDataFrame([("USA", 1), ("USA", 1), ("OECD", None), ("OECD", None), (None, 2)], "c string, k int")
    assert values(quality.key_violations(rows, ["c", "k"])) == [("USA", 1, 2)]
    assert values(quality.null_violations(rows, ["c", "k"])) == [("c", 1), ("k", 2)]
    assert values(quality.length_violations(rows, {"c": 3})) == [("c", 2)]
    assert values(quality.code_violations(rows, "c")) == [("OECD", 2)]


def test_conform(spark):
    frame = spark.createDataFrame(
        [("USA", 2020, 0.0123455, "x"), ("USA", None, 1.0, "x"), (None, 2020, 1.0, "x")],
        "country_code string, year int, inflation_rate double, extra string",
    )
    got = load.conform(frame, "inflation_rates")
    assert got.columns == [c.name for c in TABLES["inflation_rates"].columns]
    assert [str(v) for v in got.first()] == ["USA", "2020", "0.012346", "None", "None", "World Bank"]
    assert got.count() == 1
    too_large = spark.createDataFrame([("USA", 2020, 1e9)], "country_code string, year int, inflation_rate double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        load.conform(too_large, "inflation_rates").collect()


def test_one_per_key_is_deterministic(spark):
    frame = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (2, "c", 1.0)], "k int, a string, b double")
    assert values(load.one_per_key(frame, ["k"])) == values(load.one_per_key(frame.repartition(5), ["k"])) == [(1, "a", 9.0), (2, "c", 1.0)]


def test_serial_ids(spark):
    frame = load.with_serial_id(spark.range(1000).repartition(5).toDF("v"), after=10)
    ids = values(frame, "id")
    assert len(set(ids)) == 1000 and min(ids) == 11


def test_upsert(spark):
    existing = spark.createDataFrame(
        [(1, "A", 2020, 1.0, "t0", "t0"), (2, "B", 2020, 2.0, "t0", "t0")],
        "id int, country_code string, year int, rate double, created_at string, updated_at string",
    )
    incoming = spark.createDataFrame([("B", 2020, None), ("C", 2020, 5.0)], "country_code string, year int, rate double")
    got = load.upsert(existing, incoming, ["country_code", "year"], now=F.lit("t1"))
    assert values(got, "country_code", "id", "year", "rate", "created_at", "updated_at") == [
        ("A", 1, 2020, 1.0, "t0", "t0"), ("B", 2, 2020, None, "t0", "t1"), ("C", 3, 2020, 5.0, "t1", "t1"),
    ]
