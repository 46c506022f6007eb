"""Rows shaped for the five tables: columns, types, defaults, ids, stamps and upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from macrotide.operators.analytics import latest_names
from macrotide.schemas import TABLES
from macrotide.session import new_folder, stored


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and type, from the columns ``df`` has.

    Absent columns take their default or null. Rows without the load key are dropped.
    Numbers round half-up to the table's scale; one too large for it is an error.
    """
    spec = TABLES[table]
    if spec.load_key:
        df = df.na.drop(subset=list(spec.load_key))
    columns = []
    for c in spec.columns:
        value = F.col(c.name) if c.name in df.columns else F.lit(c.default)
        columns.append(value.cast(c.spark_type).alias(c.name))
    rows = df.select(*columns)
    return rows.distinct() if table == "countries" else rows


def rules(df: DataFrame, table: str) -> dict[str, Column]:
    """What a row of ``df`` must not do to go into the table: lack a required value, be too long."""
    found = {}
    for c in TABLES[table].columns:
        if c.name in df.columns:
            if c.required:
                found[f"{c.name} is null"] = F.col(c.name).isNull()
            if c.max_length:
                found[f"{c.name} is longer than {c.max_length}"] = F.char_length(F.col(c.name)) > c.max_length
    return found


def breaks(df: DataFrame, table: str) -> Column:
    return reduce(Column.__or__, (F.coalesce(r, F.lit(False)) for r in rules(df, table).values()), F.lit(False))


def rejected(df: DataFrame, table: str) -> DataFrame:
    """(table, rule, row) of the rows that break a rule, with the first rule they break."""
    first = F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules(df, table).items()], F.lit(None).cast("string"))
    return df.select(F.lit(table).alias("table"), first.alias("rule"), F.to_json(F.struct(*df.columns)).alias("row")).filter(
        F.col("rule").isNotNull())


def country_rows(merged: DataFrame) -> DataFrame:
    """One (code, name) row per code, its latest name: the code is the key of ``countries``."""
    dated = merged if "year" in merged.columns else merged.withColumn("year", F.lit(0))
    return latest_names(dated)


def one_per_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, always the same one: the smallest in the order of the other columns,
    values before nulls.

    A plain aggregation, so copies are reduced in each task before the shuffle. A single other
    column is a plain minimum, which needs no sorting.
    """
    rest = [c for c in df.columns if c not in key]
    if len(rest) == 1:
        return df.groupBy(*key).agg(F.min(rest[0]).alias(rest[0])).select(*df.columns)
    order = [part for c in rest for part in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    kept = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("__row"))
    return kept.select(*[F.col(c) if c in key else F.col(f"__row.{c}").alias(c) for c in df.columns])


def with_serial_id(df: DataFrame, after: int = 0, into: str = "id") -> DataFrame:
    """Unique ascending ids above ``after``, assigned in each task without moving rows.
    Like a database sequence they may have gaps."""
    return df.select((F.monotonically_increasing_id() + F.lit(after + 1)).alias(into), *df.columns)


def with_dense_ids(
    df: DataFrame, order: Sequence[str], after: int = 0, into: str = "id", folder: str | None = None,
) -> DataFrame:
    """Ids ``after + 1``, ``after + 2`` and so on in the order of columns that name each row once.

    Rows are sorted by ranges and written with their task and place; the ids are the places plus
    the numbers of rows in the tasks before (one row per task). As the places are written, a lost executor gives
    nobody another id.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(
        df.orderBy(*order).select("*", F.spark_partition_id().alias("__task"), place.alias("__place")),
        folder or new_folder(df.sparkSession, "ids"))
    earlier = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = placed.groupBy("__task").agg(F.count("*").alias("__rows"))
    before = tasks.select("__task", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(before), "__task").select(
        (F.lit(after) + F.col("__before") + F.col("__place") + 1).alias(into), *df.columns)


def with_stamps(df: DataFrame, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return df.withColumns({"created_at": now, "updated_at": now})


def upsert(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], now: Column | None = None,
    keep: Sequence[str] = ("id", "created_at"), stamp: str = "updated_at", last_id: int | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Existing rows with those of ``incoming`` put over them by key.

    A row that existed keeps its id and creation stamp; whatever comes in is stamped now, and
    new rows get the ids after ``last_id`` (by default the highest of ``existing``) in the order of their key. Keys match null-safe.
    ``incoming`` must be unique on the key (see ``one_per_key``). One full outer join, so each
    side is shuffled once; with ids its result is written once to ``folder``, and only new rows are sorted.
    """
    now = F.current_timestamp() if now is None else now
    new = incoming.select(*[F.col(c).alias(f"__new_{c}") for c in incoming.columns], F.lit(True).alias("__new"))
    on = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in key]
    is_new = F.coalesce("__new", F.lit(False))
    columns = []
    for c in existing.columns:
        fresh = F.col(f"__new_{c}") if c in incoming.columns else None
        if c == stamp:
            value = F.when(is_new, now).otherwise(F.col(c))
        elif c == "created_at":
            value = F.coalesce(F.col(c), now)
        elif c in keep:
            value = F.coalesce(F.col(c), fresh) if fresh is not None else F.col(c)
        elif fresh is not None:
            value = F.when(is_new, fresh).otherwise(F.col(c))
        else:
            value = F.col(c)
        columns.append(value.alias(c))
    put = existing.join(new, on, "full_outer").select(*columns)
    if "id" not in existing.columns or "id" in incoming.columns:
        return put
    if last_id is None:
        last_id = existing.agg(F.max("id")).first()[0] or 0
    folder = folder or new_folder(existing.sparkSession, "upsert")
    put = stored(put, f"{folder}/put")
    numbered = with_dense_ids(put.filter(F.col("id").isNull()).drop("id"), key, last_id, folder=f"{folder}/new")
    return put.filter(F.col("id").isNotNull()).unionByName(numbered)
