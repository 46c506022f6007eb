"""Writers: files, catalog tables, external databases."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.operators.load import (
    breaks, conform, country_rows, one_per_key, rejected, upsert, with_dense_ids, with_stamps,
)
from macrotide.schemas import REJECTED, TABLES
from macrotide.session import stored

FORMATS = ("parquet", "csv", "json")
#: Property of a table: the highest id ever given out.
LAST_ID = "macrotide.last_id"


def save(df: DataFrame, path: str, format: str = "parquet", by_year: bool = False) -> None:
    """Overwrite ``path`` in the named format (any case).

    CSV gets a header in every part file; parts are written in parallel and not merged.
    With ``by_year`` the files are laid out by year. Rows are rebalanced on it first, which
    splits large years and packs small ones.
    """
    name = format.lower()
    if name not in FORMATS:
        raise ValueError(f"Unsupported format: {format}")
    if by_year:
        df = df.hint("rebalance", "year")
    writer = df.write.mode("overwrite").format(name)
    if by_year:
        writer = writer.partitionBy("year")
    if name == "csv":  # outer blanks belong to a text
        writer = writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.save(path)


def export_name(data_type: str, day: date | None = None) -> str:
    """'Inflation Rates' on 5 March 2024 -> inflation_rates_20240305.csv"""
    return f"{data_type.lower().replace(' ', '_')}_{(day or date.today()):%Y%m%d}.csv"


def export_view(df: DataFrame, folder: str, data_type: str, day: date | None = None) -> str:
    path = f"{folder.rstrip('/')}/{export_name(data_type, day)}"
    save(df, path, "csv")
    return path


def _column_ddl(table: str) -> str:
    spec = TABLES[table]
    lines = ["id BIGINT"] if spec.serial else []
    for c in spec.columns:
        required = " NOT NULL" if c.required else ""
        default = f" DEFAULT '{c.default}'" if c.default else ""
        lines.append(f"{c.name} {c.type}{required}{default}")
    lines += [f"{s} TIMESTAMP DEFAULT current_timestamp()" for s in spec.stamps]
    return ", ".join(lines)


def _view_ddl(database: str) -> list[str]:
    source = f"{database}.economic_indicators"
    return [
        f"""CREATE OR REPLACE VIEW {database}.latest_economic_data AS
        WITH recent AS (SELECT * FROM {source} WHERE year >= 2020),
        per_year AS (SELECT country_code, year, count(*) AS n FROM recent GROUP BY country_code, year),
        ranks AS (
            SELECT country_code, year, 1 + coalesce(sum(n) OVER (
                PARTITION BY country_code ORDER BY year DESC
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS year_rank
            FROM per_year)
        SELECT r.country_code, country_name, r.year, inflation_rate, inflation_category,
               avg_annual_wage, real_wage_adjusted, economic_health_score, year_rank
        FROM recent r JOIN ranks k ON r.country_code <=> k.country_code AND r.year = k.year""",
        f"""CREATE OR REPLACE VIEW {database}.high_inflation_countries AS
        SELECT country_code, country_name, year, inflation_rate, inflation_category
        FROM {source} WHERE inflation_rate > 0.10 ORDER BY inflation_rate DESC""",
        f"""CREATE OR REPLACE VIEW {database}.wage_inflation_correlation AS
        SELECT country_code, country_name, year, inflation_rate, avg_annual_wage, real_wage_adjusted,
               CASE WHEN real_wage_adjusted > avg_annual_wage THEN 'Wage Growth Outpacing Inflation'
                    WHEN real_wage_adjusted < avg_annual_wage THEN 'Inflation Outpacing Wage Growth'
                    ELSE 'Balanced' END AS wage_inflation_relationship
        FROM {source}
        WHERE inflation_rate IS NOT NULL AND avg_annual_wage IS NOT NULL
          AND real_wage_adjusted IS NOT NULL""",
    ]


def create_schema(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Database, five tables and three views; what exists already is left alone. Without a location the warehouse holds them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for table, spec in TABLES.items():
        layout = " PARTITIONED BY (year)" if spec.by_year else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({_column_ddl(table)}) USING parquet{layout}"
        )
    for view in _view_ddl(database):
        spark.sql(view)


def last_id(spark: SparkSession, name: str) -> int:
    """The highest id ever given out in a table: its mark, else the highest id in it."""
    mark = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(LAST_ID)
    return int(mark) if mark is not None else spark.table(name).agg(F.max("id")).first()[0] or 0


def reserve_ids(spark: SparkSession, name: str, last: int) -> None:
    """Mark ids up to ``last`` as given out, before rows with them are written: a load that fails then leaves a
    gap and no id twice."""
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{LAST_ID}' = '{last}')")


def load_table(df: DataFrame, table: str, database: str, overwrite: bool = False) -> None:
    """Write rows into one of the tables, with ids and stamps where the table has them. Ids go on after the highest
    one ever given out, in the order of the key."""
    spark = df.sparkSession
    name = f"{database}.{table}"
    spec = TABLES[table]
    rows = with_stamps(conform(df, table))
    if spec.serial:
        last = last_id(spark, name)
        rows = with_dense_ids(rows, [c for c in rows.columns if c not in spec.stamps], last)
        reserve_ids(spark, name, last + rows.count())
    if spec.by_year:
        rows = rows.hint("rebalance", "year")
    rows.select(*spark.table(name).columns).write.insertInto(name, overwrite=overwrite)


def load_countries(merged: DataFrame, database: str) -> None:
    """Replace ``countries`` by one row per code of the frame, with its latest name."""
    load_table(country_rows(merged), "countries", database, overwrite=True)


#: Property of a database: the folder of a load whose content is complete but not yet installed.
PENDING = "macrotide.pending"


def prepare(df: DataFrame, table: str, database: str, folder: str) -> DataFrame:
    """Write the new content of a table to ``folder``, the table itself left alone, and return the rows that break
    a rule of it.

    Rows are put over those of the table by its key. Loading the same rows again changes nothing but stamps. New rows get
    ids after the highest one ever given out in the table, whatever years come in. Only the years that occur are read.
    """
    spark, name, spec = df.sparkSession, f"{database}.{table}", TABLES[table]
    stage = f"{folder.rstrip('/')}/{table}"
    save(rejected(df, table), f"{stage}_rejected")
    bad = spark.read.schema(REJECTED).parquet(f"{stage}_rejected")
    rows = one_per_key(conform(df.filter(~breaks(df, table)), table), spec.key)
    present = spark.table(name)
    last = last_id(spark, name) if spec.serial else 0
    if spec.by_year:
        years = rows.select(F.col("year").alias("__year")).distinct()
        present = present.join(years, F.col("year") == F.col("__year"), "left_semi")
    put = upsert(present, rows, spec.key, last_id=last, folder=f"{stage}_ids")
    save(put, stage)
    if spec.serial:
        highest = spark.read.schema(put.schema).parquet(stage).agg(F.max("id")).first()[0]
        reserve_ids(spark, name, max(last, highest or 0))
    return bad


def install(spark: SparkSession, table: str, database: str, folder: str) -> None:
    """Put prepared content in its place: the whole table, or the years that occur in it. Doing it twice does no harm."""
    name, spec = f"{database}.{table}", TABLES[table]
    content = spark.read.schema(spark.table(name).schema).parquet(f"{folder.rstrip('/')}/{table}").select(*spark.table(name).columns)
    replace(content, name, spec.by_year)


def replace(content: DataFrame, name: str, by_year: bool) -> None:
    """Overwrite a table, or only the years that occur in the content."""
    spark = content.sparkSession
    if by_year:
        content = content.hint("rebalance", "year")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic" if by_year else "static")
    try:
        content.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def put_table(df: DataFrame, table: str, database: str, folder: str) -> DataFrame:
    """Put rows over those of one table; see ``prepare``."""
    bad = prepare(df, table, database, folder)
    install(df.sparkSession, table, database, folder)
    return bad


def put_tables(loads: Mapping[str, DataFrame], database: str, folder: str) -> list[DataFrame]:
    """Put rows over those of several tables, all or none, and return the rows that break a rule, by table.

    The new content of all tables is written first; a failure up to there leaves the tables as they were.
    Then the folder is noted at the database and the content is installed. If that is interrupted, ``finish_load``
    installs it all from the folder, which the next load does by itself before it begins.
    """
    spark = next(iter(loads.values())).sparkSession
    finish_load(spark, database)
    bad = [prepare(rows, table, database, folder) for table, rows in loads.items()]
    note = f"{','.join(loads)}={folder}"
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{PENDING}' = '{note}')")
    finish_load(spark, database)
    return bad


def pending_load(spark: SparkSession, database: str) -> tuple[list[str], str] | None:
    """Tables and folder of a load that is complete but not installed."""
    about = spark.sql(f"DESCRIBE DATABASE EXTENDED {database}").where("info_name = 'Properties'").select("info_value").first()
    found = re.search(rf"\({re.escape(PENDING)},([^=()]+)=([^()]*)\)", about[0] if about else "")
    return (found[1].split(","), found[2]) if found else None


def finish_load(spark: SparkSession, database: str) -> None:
    """Install what is pending, if anything is."""
    if not (pending := pending_load(spark, database)):
        return
    tables, folder = pending
    for table in tables:
        install(spark, table, database, folder)
    spark.sql(f"ALTER DATABASE {database} SET DBPROPERTIES ('{PENDING}' = '=')")


def dependents(table: str) -> list[str]:
    """The tables that refer to a table, those that refer to them before them, and the table last."""
    children = [name for name, spec in TABLES.items() if spec.parent == table]
    return [t for child in children for t in dependents(child)] + [table]


def delete_cascade(spark: SparkSession, database: str, keys: DataFrame, table: str = "countries", key: str = "country_code") -> DataFrame:
    """Delete the rows of a table with the given keys and the rows of all tables that refer to them, children first.

    Only years that hold such rows are rewritten; a year that loses all its rows is dropped. Returns (table, rows) with
    the number of rows deleted.
    """
    keys = stored(keys.select(key).distinct())
    deleted = []
    for name in dependents(table):
        spec, rows = TABLES[name], spark.table(f"{database}.{name}")
        gone = rows.join(keys, key, "left_semi")
        if not spec.by_year:
            n = gone.count()
            if n:
                replace(stored(rows.join(keys, key, "left_anti").select(*rows.columns)), f"{database}.{name}", False)
        else:
            # a row per year: bounded by the number of partitions
            years = {r["year"]: r["n"] for r in gone.groupBy("year").agg(F.count("*").alias("n")).collect()}
            n = sum(years.values())
            if n:
                kept = stored(rows.filter(F.col("year").isin(list(years))).join(keys, key, "left_anti").select(*rows.columns))
                left = {r["year"] for r in kept.select("year").distinct().collect()}
                replace(kept, f"{database}.{name}", True)
                for year in sorted(set(years) - left):
                    spark.sql(f"ALTER TABLE {database}.{name} DROP IF EXISTS PARTITION (year = {year})")
        deleted.append((name, n))
    return spark.createDataFrame(deleted, "table string, rows bigint")


def load_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str],
    schema: str | None = None, batch_size: int = 10_000,
) -> None:
    """Append to a table of an external database; failures are raised."""
    target = f"{schema}.{table}" if schema else table
    df.write.option("batchsize", batch_size).jdbc(url, target, mode="append", properties=dict(properties))
