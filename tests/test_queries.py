"""Every registered query against its SQL twin, and properties its plan must have."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from macrotide.plans import oracle, queries as registry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables not here")

QUERIES, ORACLE = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, frame.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from macrotide.operators.clean import clean_inflation
    from macrotide.operators.stats import group_mean
    from macrotide.schemas import INFLATION_FEED

    spark.createDataFrame([], INFLATION_FEED).write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    plan = plan_of(group_mean(clean_inflation(feed), ["country_code"]))
    assert "GreaterThanOrEqual(year,2000)" in plan and "LessThanOrEqual(year,2030)" in plan
    assert "IsNotNull(value)" in plan
    assert "ReadSchema: struct<country_code:string,year:int,value:double>" in plan


def test_standardising_moves_no_rows(spark):
    from macrotide.operators.standardize import standardize_countries
    from macrotide.plans.bindings import Tables, country_lookup

    mapped, _ = standardize_countries(
        Tables(spark, FOLDER).customer.withColumnRenamed("c_name", "country_code"), country_lookup()
    )
    plan = plan_of(mapped)
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
