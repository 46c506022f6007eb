import json
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from support import values
from macrotide.functions.country import CountryLookup
from macrotide.operators import sinks
from macrotide.operators.load import with_dense_ids
from macrotide.operators.quality import constraint_report
from macrotide.plans.refresh import main, refresh
from macrotide.session import new_folder, shared_folder, shuffle_partitions
from macrotide.schemas import COMMODITY_FEED, INFLATION_FEED, TABLES, WAGE_FEED


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([("USA", 2020, 1.5), ("GBR", 2021, None)], "country_code string, year int, v double")


@pytest.fixture
def database():
    return f"db_{uuid.uuid4().hex[:12]}"


@pytest.mark.parametrize("name", ["parquet", "CSV", "Json"])
def test_save_and_overwrite(spark, frame, tmp_path, name):
    path = str(tmp_path / "out")
    sinks.save(frame.limit(0), path, name)
    sinks.save(frame, path, name)
    reader = spark.read.option("header", True).option("inferSchema", True) if name == "CSV" else spark.read
    back = reader.format(name.lower()).load(path).select("country_code", "year", "v")
    assert values(back) == values(frame)


def test_save_by_year(spark, frame, tmp_path):
    sinks.save(frame, str(tmp_path / "out"), by_year=True)
    assert (tmp_path / "out" / "year=2020").is_dir()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert values(back.filter("year = 2021"), "country_code") == ["GBR"]


def test_unknown_format(frame, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        sinks.save(frame, str(tmp_path / "out"), "xml")


def test_export(spark, frame, tmp_path):
    path = sinks.export_view(frame, str(tmp_path), "Inflation Rates", date(2024, 3, 5))
    assert path.endswith("/inflation_rates_20240305.csv")
    assert spark.read.csv(path, header=True).count() == 2


def test_schema_is_idempotent_and_tables_check_lengths(spark, frame, database):
    sinks.create_schema(spark, database)
    sinks.create_schema(spark, database)
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r.isTemporary}
    assert names == set(TABLES) | {"latest_economic_data", "high_inflation_countries", "wage_inflation_correlation"}
    long_code = spark.createDataFrame([("EA19", 2020, 1.0)], "country_code string, year int, inflation_rate double")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds.*limit"):
        sinks.load_table(long_code, "inflation_rates", database)
    assert spark.table(f"{database}.inflation_rates").count() == 0


def test_loads_append_with_new_ids(spark, database):
    sinks.create_schema(spark, database)
    rates = spark.createDataFrame([("USA", 2020, 0.0123455), ("GBR", 2021, 0.5), ("GBR", None, 0.5)], "country_code string, year int, inflation_rate double")
    sinks.load_table(rates, "inflation_rates", database)
    sinks.load_table(rates, "inflation_rates", database)
    table = spark.table(f"{database}.inflation_rates")
    rows = table.collect()
    assert len(rows) == 4 and len({r.id for r in rows}) == 4
    assert {r.data_source for r in rows} == {"World Bank"} and all(r.created_at == r.updated_at for r in rows)
    assert [f.dataType.simpleString() for f in table.schema if f.name == "inflation_rate"] == ["decimal(10,6)"]
    countries = spark.createDataFrame([("USA", "United States"), ("USA", "United States"), ("GBR", "UK")], "country_code string, country_name string")
    sinks.load_countries(countries, database)
    sinks.load_countries(countries.filter("country_code = 'USA'"), database)
    assert values(spark.table(f"{database}.countries"), "country_code", "country_name", "region") == [("USA", "United States", None)]


def ids_of(spark, database, table="inflation_rates"):
    return {(r.country_code, r.year): r.id for r in spark.table(f"{database}.{table}").collect()}


def test_ids_are_unique_over_all_loads(spark, tmp_path, database):
    """Years loaded one after another, one of them again with more rows."""
    def put(codes, year, run):
        rows = spark.createDataFrame([(c, year, 0.5) for c in codes], "country_code string, year int, inflation_rate double")
        sinks.put_table(rows.repartition(3), "inflation_rates", database, str(tmp_path / run))
        return ids_of(spark, database)

    sinks.create_schema(spark, database)
    first = put(["DEU", "AUT", "FRA"], 2020, "a")
    assert first == {("AUT", 2020): 1, ("DEU", 2020): 2, ("FRA", 2020): 3}
    second = put(["FRA", "DEU"], 2021, "b")
    assert second == first | {("DEU", 2021): 4, ("FRA", 2021): 5}
    third = put(["ESP", "DEU", "AUT", "BEL", "FRA"], 2020, "c")
    assert third == second | {("BEL", 2020): 6, ("ESP", 2020): 7}
    spark.table(f"{database}.inflation_rates").filter("year = 2020 AND id < 6").write.mode("overwrite").parquet(str(tmp_path / "part"))
    spark.read.parquet(str(tmp_path / "part")).select(*spark.table(f"{database}.inflation_rates").columns).write.insertInto(
        f"{database}.inflation_rates", overwrite=True)
    assert put(["BEL"], 2020, "d")["BEL", 2020] == 8  # an id is never given out again


FIVE = {
    "countries": "country_code string, country_name string", "inflation_rates": "country_code string, year int, inflation_rate double",
    "wage_index": "country_code string, year int, avg_annual_wage double", "commodity_prices": "year int, commodity string, price double",
    "economic_indicators": "country_code string, year int, inflation_rate double",
}


def five_loads(spark, value, years=(2020, 2021), codes=("AUT", "DEU")):
    by_country = [(c, y, value) for c in codes for y in years]
    rows = {"countries": [(c, f"name {value}") for c in codes], "commodity_prices": [(y, "Gold", value) for y in years]}
    return {name: spark.createDataFrame(rows.get(name, by_country), schema) for name, schema in FIVE.items()}


def content(spark, database):
    return {name: sorted(tuple(str(v) for v in r) for r in spark.table(f"{database}.{name}").drop("created_at", "updated_at").collect()) for name in FIVE}


def test_a_failed_load_changes_no_table(spark, tmp_path, database):
    sinks.create_schema(spark, database)
    sinks.put_tables(five_loads(spark, 0.25), database, str(tmp_path / "a"))
    before = content(spark, database)
    broken = five_loads(spark, 0.5)
    broken["wage_index"] = broken["wage_index"].withColumn("avg_annual_wage", F.raise_error(F.lit("third load")).cast("double"))
    with pytest.raises(Exception, match="third load"):
        sinks.put_tables(broken, database, str(tmp_path / "b"))
    assert content(spark, database) == before and sinks.pending_load(spark, database) is None
    sinks.put_tables(five_loads(spark, 0.5), database, str(tmp_path / "c"))
    after = content(spark, database)
    assert all(after[name] != before[name] for name in FIVE)
    assert {r[0] for r in after["inflation_rates"]} == {r[0] for r in before["inflation_rates"]}  # the same ids


def test_an_interrupted_load_is_finished(spark, tmp_path, database, monkeypatch):
    """What fails while content is installed is installed by the next load, or by hand."""
    sinks.create_schema(spark, database)
    sinks.put_tables(five_loads(spark, 0.25), database, str(tmp_path / "a"))
    install, done = sinks.install, []

    def failing(spark, table, database, folder):
        if len(done) == 2:
            raise OSError("lost")
        done.append(table)
        install(spark, table, database, folder)

    monkeypatch.setattr(sinks, "install", failing)
    with pytest.raises(OSError, match="lost"):
        sinks.put_tables(five_loads(spark, 0.5), database, str(tmp_path / "b"))
    monkeypatch.setattr(sinks, "install", install)
    assert sinks.pending_load(spark, database) == (list(FIVE), str(tmp_path / "b"))
    sinks.finish_load(spark, database)
    assert sinks.pending_load(spark, database) is None
    found = content(spark, database)
    assert found["countries"] == [("AUT", "name 0.5", "None", "None"), ("DEU", "name 0.5", "None", "None")]
    assert all("0.5" in str(rows) and "0.25" not in str(rows) for rows in found.values())


def files_of(spark, database, table):
    return {r.f for r in spark.table(f"{database}.{table}").select(F.input_file_name().alias("f")).distinct().collect()}


def test_delete_reaches_all_tables(spark, tmp_path, database):
    sinks.create_schema(spark, database)
    loads = five_loads(spark, 0.25, (2020, 2021, 2022), ("AUT", "DEU"))
    only = spark.createDataFrame([("FRA", 2021, 1.0), ("FRA", 2023, 1.0)], FIVE["wage_index"])
    loads["wage_index"] = loads["wage_index"].union(only)
    loads["countries"] = loads["countries"].union(spark.createDataFrame([("FRA", "France")], FIVE["countries"]))
    sinks.put_tables(loads, database, str(tmp_path))
    before = {name: files_of(spark, database, name) for name in FIVE}
    deleted = dict(values(sinks.delete_cascade(spark, database, spark.createDataFrame([("FRA",), ("XXX",), ("FRA",)], "country_code string"))))
    assert deleted == {"countries": 1, "inflation_rates": 0, "wage_index": 2, "economic_indicators": 0}
    for name in ("countries", "inflation_rates", "wage_index", "economic_indicators"):
        assert "FRA" not in values(spark.table(f"{database}.{name}"), "country_code")
    after = {name: files_of(spark, database, name) for name in FIVE}
    assert after["inflation_rates"] == before["inflation_rates"] and after["commodity_prices"] == before["commodity_prices"]
    kept = {f for f in before["wage_index"] if "year=2020" in f or "year=2022" in f}
    assert kept and kept <= after["wage_index"] and not any("year=2023" in f for f in after["wage_index"])
    assert len(values(spark.table(f"{database}.wage_index").filter("year = 2021"))) == 2
    everything = sinks.delete_cascade(spark, database, spark.table(f"{database}.countries"))
    assert dict(values(everything))["inflation_rates"] == 6 and spark.table(f"{database}.economic_indicators").count() == 0
    assert spark.table(f"{database}.commodity_prices").count() == 3
    assert sinks.dependents("countries")[-1] == "countries" and set(sinks.dependents("countries")) == set(FIVE) - {"commodity_prices"}


def test_ids_go_on_where_there_is_no_mark(spark, tmp_path, database):
    sinks.create_schema(spark, database)
    rows = spark.createDataFrame([(c, y, 0.5) for c in ("AUT", "DEU") for y in (2019, 2020)], "country_code string, year int, inflation_rate double")
    sinks.load_table(rows, "inflation_rates", database)
    spark.sql(f"ALTER TABLE {database}.inflation_rates UNSET TBLPROPERTIES ('{sinks.LAST_ID}')")
    assert sinks.last_id(spark, f"{database}.inflation_rates") == 4
    sinks.put_table(rows.filter("year = 2019").withColumn("country_code", F.lit("FRA")).dropDuplicates(), "inflation_rates", database, str(tmp_path))
    assert ids_of(spark, database)["FRA", 2019] == 5


def test_dense_ids_follow_the_order(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k"), F.lit("x").alias("v")).repartition(13)
    found = [tuple(r) for r in with_dense_ids(rows, ["k"], after=5).orderBy("id").collect()]
    assert [r[0] for r in found] == list(range(6, 1006)) and [r[1] for r in found] == sorted(r[1] for r in found)
    assert with_dense_ids(rows.limit(0), ["k"]).count() == 0


def test_refresh(spark, tmp_path, database):
    cpi = "Inflation, consumer prices (annual %)"
    inflation = spark.createDataFrame([
        ("US", "United States", "FP.CPI.TOTL.ZG", cpi, 2020, 1.2), ("USA", "United States", "FP.CPI.TOTL.ZG", cpi, 2021, 15.0),
        ("Great Britain", "United Kingdom", "FP.CPI.TOTL.ZG", cpi, 2021, 2.5), ("Deutschland", "Germany", "FP.CPI.TOTL.ZG", cpi, 2021, 3.0),
        ("USA", "United States", "NY.GDP.DEFL.ZS", "deflator", 2021, 103.98),
    ], INFLATION_FEED)
    commodities = spark.createDataFrame([(2021, 1, "Gold", 10.0), (2021, 2, "Gold", 30.0), (2021, 1, "Wheat", 4.0)], COMMODITY_FEED)
    wages = spark.createDataFrame([("usa", 2021, "Average Annual Wages", 57500.0), ("GBR", 2021, "Average Annual Wages", 41000.0)], WAGE_FEED)
    done = refresh(spark, inflation, commodities, wages, database, str(tmp_path))
    assert values(done.merged, "country_code", "year", "inflation_rate", "commodity_price_index", "real_wage_adjusted") == [
        ("GBR", 2021, 0.025, 12.0, pytest.approx(40000.0)), ("USA", 2020, 0.012, None, None),
        ("USA", 2021, pytest.approx(0.010398), 12.0, pytest.approx(57500 / 1.010398)),
        ("USA", 2021, pytest.approx(0.15), 12.0, pytest.approx(50000.0)),
    ]
    assert values(done.unmapped["inflation"]) == ["Deutschland"]
    assert tuple(done.summary.first()) == (4, 2, 2, 2020, 2021)
    assert dict(values(done.checks)) == {
        "no_orphaned_inflation": True, "no_orphaned_wage": True, "reasonable_inflation_range": True, "has_recent_data": True,
    }
    counts = {"countries": 2, "inflation_rates": 4, "wage_index": 2, "commodity_prices": 2, "economic_indicators": 3, "all": 13}
    assert dict(values(done.counts)) == counts
    assert done.rejected.count() == 0 and done.described.count() == 3
    ids = {r.id for r in spark.table(f"{database}.inflation_rates").collect()}
    assert len(ids) == 4
    again = refresh(spark, inflation, commodities, wages, database, str(tmp_path / "again"))
    assert dict(values(again.counts)) == counts
    assert {r.id for r in spark.table(f"{database}.inflation_rates").collect()} == ids
    aggregate = spark.createDataFrame([("EA19", "Euro area", None, cpi, 2021, 2.0), ("FRA", "France", None, cpi, 2021, 2.0)], INFLATION_FEED)
    third = refresh(spark, aggregate, commodities, wages, database, str(tmp_path / "third"), lookup=CountryLookup([("FR", "FRA", "France", "French Republic")]))
    assert spark.table(f"{database}.inflation_rates").count() == 5
    refused = {(r.table, r.rule) for r in third.rejected.collect()}
    assert refused <= {(t, "country_code is longer than 3") for t in ("countries", "inflation_rates", "economic_indicators")}
    latest = spark.table(f"{database}.latest_economic_data")
    assert values(latest, "country_code", "year", "year_rank") == [("FRA", 2021, 1), ("GBR", 2021, 1), ("USA", 2020, 2), ("USA", 2021, 1)]
    assert spark.table(f"{database}.high_inflation_countries").count() == 0  # the smallest rate of a key is kept
    relations = spark.table(f"{database}.wage_inflation_correlation")
    assert values(relations, "wage_inflation_relationship") == ["Inflation Outpacing Wage Growth"] * 2
    report = {(r.constraint, r.subject): r.violations for r in constraint_report(spark.table(f"{database}.economic_indicators"), "economic_indicators").collect()}
    assert report["unique", "country_code, year"] == 0
    for name in ("standardized_inflation", "standardized_commodities", "standardized_wages", "merged"):
        assert (tmp_path / name).is_dir()


def test_refresh_from_files(spark, tmp_path, database):
    """Command line over landed files."""
    record = {"indicator": {"id": "FP.CPI.TOTL.ZG"}, "country": {"value": "Germany"}, "countryiso3code": "DEU", "date": "2021", "value": 3.1}
    (tmp_path / "pages.json").write_text(json.dumps([{"page": 1}, [record]]))
    (tmp_path / "sheet.csv").write_text("a\nb\nc\nPeriod,Gold\n2021M01,10\n2021M02,20\n")
    (tmp_path / "wages.csv").write_text("LOCATION,TIME_PERIOD,OBS_VALUE\nDEU,2021,51550\nXYZ,2021,1\n")
    (tmp_path / "index.csv").write_text("OBS_VALUE,LOCATION,TIME_PERIOD\n101.5,DEU,2021\n")
    done = main([
        "--inflation", str(tmp_path / "pages.json"), "--inflation-format", "json",
        "--commodities", str(tmp_path / "sheet.csv"), "--commodity-format", "sheet",
        "--wages", str(tmp_path / "wages.csv"), str(tmp_path / "index.csv"), "--wage-format", "table",
        "--wage-dataset", "Average Annual Wages", "Real Wage Index", "--wage-countries", "default",
        "--database", database, "--folder", str(tmp_path / "stages"),
    ])
    assert (tmp_path / "stages" / "merged").is_dir()
    assert values(done.merged, "country_code", "year", "inflation_rate", "commodity_price_index", "real_wage_adjusted", "real_wage_index") == [
        ("DEU", 2021, pytest.approx(0.031), 15.0, pytest.approx(50000.0), 101.5),
    ]


def test_shuffle_sizes():
    assert shuffle_partitions(1) == 200
    assert shuffle_partitions(10 * 1024 ** 4) == 40_960
    assert shuffle_partitions(100 * 1024 ** 4) == 409_600
    assert shuffle_partitions(100 * 1024 ** 4, most=50_000) == 50_000


def test_stages_of_one_machine_need_no_setting(spark):
    assert new_folder(spark, "a") != new_folder(spark, "a")
    assert new_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))

    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_folder(Elsewhere)


def test_shared_folder_is_the_clusters(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(spark)
