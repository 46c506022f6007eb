"""CSV feeds: typed by column name, plain, and sheets with lines above their header."""

from __future__ import annotations

import csv
import io
import json
import re
import sys
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import BinaryIO
from urllib.parse import unquote

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from macrotide.functions.parsing import csv_cells, let, parse_date, parse_number, strip
from macrotide.operators.clean import clean_commodity_sheet, clean_wage_table
from macrotide.operators.reshape import DATE_COLUMNS, select_typed, union_feeds
from macrotide.schemas import COMMODITY_FEED, INFLATION_FEED, WAGE_FEED


HEADER_BYTES = 64 * 1024


def first_record(stream: BinaryIO, line: int = 1, step: int = HEADER_BYTES) -> list[str] | None:
    """Cells of the CSV record that begins on a line of a byte stream; line ends inside quotes belong to the
    cell. It reads ``step`` bytes, and as many again only while the record has not ended."""
    data = b""
    while True:
        more = stream.read(step)
        data += more
        above = data.split(b"\n", line - 1)
        rest = above[-1] if len(above) == line else b""
        ends = [m.start() for m in re.finditer(b"\n", rest)]
        # the record ends at the first line end outside quotes
        end = next((e for e in ends if rest.count(b'"', 0, e) % 2 == 0), None)
        if end is None and more:
            continue
        text = rest[:end].decode("utf-8", "replace").removeprefix("\ufeff").rstrip("\r")
        return next(csv.reader(io.StringIO(text, newline="")), []) if text.strip() else None


def opened(file: str) -> BinaryIO:
    """A file of any store that Arrow reads, by its address."""
    from pyarrow import fs

    address = re.sub("^s3[an]:", "s3:", file)
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_stream(path, buffer_size=HEADER_BYTES)


class FilesOfReader(InputPartition):
    def __init__(self, files: list[str]) -> None:
        self.files = files


class HeaderReader(DataSourceReader):
    """A row per file: its address and the cells of its header. Only the first bytes of each file are read."""

    def __init__(self, files: list[str], line: int) -> None:
        self.files, self.line = files, line

    def partitions(self) -> list[FilesOfReader]:
        return [FilesOfReader(self.files[k:k + 64]) for k in range(0, len(self.files), 64)]

    def read(self, partition: FilesOfReader) -> Iterator[tuple]:
        for file in partition.files:
            with opened(file) as stream:
                yield file, first_record(stream, self.line)


class Headers(DataSource):
    """Source ``csv_headers``: the header of each file, with the options ``files`` (a JSON list) and ``line``."""

    @classmethod
    def name(cls) -> str:
        return "csv_headers"

    def schema(self) -> str:
        return "file string, header array<string>"

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(json.loads(self.options["files"]), int(self.options["line"]))


def header_groups(
    spark: SparkSession, path: str | Sequence[str], header_line: int = 1
) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for every header that occurs.

    A task reads the first bytes of its files; the driver gets a header and a file list, as it would to plan
    any read.
    """
    files = spark.read.text(path).inputFiles()
    if not files:
        return []
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package
    spark.dataSource.register(Headers)
    found = spark.read.format("csv_headers").option("files", json.dumps(sorted(files))).option("line", header_line).load()
    groups = found.filter("header IS NOT NULL").groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    # listed as addresses, read as paths
    return [(header_columns(r["header"]), list(map(unquote, r["files"]))) for r in groups.orderBy("header").collect()]


def header_columns(cells: Sequence[str]) -> list[str]:
    """Column names of a header; unnamed cells are numbered."""
    return [(cell or "").strip() or f"Unnamed: {i}" for i, cell in enumerate(cells)]


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Any CSV with a header, every column as text. Each file is read by its own header and the
    files are united by column name. Files are split, but for those whose header has line ends in it."""
    frames = [
        spark.read.csv(files, header=True, schema=_text_schema(columns), enforceSchema=True,
                       multiLine=any("\n" in c for c in columns))
        for columns, files in header_groups(spark, path)
    ]
    if not frames:
        return spark.read.csv(path, header=True)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_inflation(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return select_typed(read_csv(spark, path), INFLATION_FEED)


def read_commodities(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return select_typed(read_csv(spark, path), COMMODITY_FEED)


def read_wages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return select_typed(read_csv(spark, path), WAGE_FEED)


def read_wage_table(spark: SparkSession, path: str | Sequence[str], dataset_code: str) -> DataFrame:
    return clean_wage_table(read_csv(spark, path), dataset_code)


def sheet_lines(documents: DataFrame, text: str = "value", header_line: int = 4) -> DataFrame:
    """(date, cells) of the data lines of sheets held as one text each: the date cell, and the other cells as
    (commodity, price) texts. Each sheet is read by its own header, in one pass and without a job ahead of it."""
    lines = F.split(F.col(text), r"\r?\n")

    def named(header: Column) -> Column:
        return F.transform(csv_cells(header), lambda c, i: F.coalesce(
            F.nullif(strip(c), F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))))

    def date_at(names: Column) -> Column:
        known = [F.when(F.array_contains(names, c), F.array_position(names, c)) for c in DATE_COLUMNS]
        return (F.coalesce(*known, F.lit(1)) - 1).cast("int")

    def rows(names: Column) -> Column:
        return let(date_at(names), lambda at: let(
            F.filter(F.sequence(F.lit(0), F.size(names) - 1), lambda i: (i != at) & ~names[i].startswith("Unnamed")),
            lambda kept: F.transform(
                F.filter(F.slice(lines, header_line + 1, F.greatest(F.size(lines), F.lit(1))), lambda line: F.trim(line) != ""),
                lambda line: let(csv_cells(line), lambda cells: F.struct(
                    F.get(cells, at).alias("date"),
                    F.transform(kept, lambda i: F.struct(names[i].alias("commodity"), F.get(cells, i).alias("price"))).alias("cells"))))))

    header = F.get(lines, F.lit(header_line - 1))
    found = F.when(F.trim(header) != "", let(named(header), rows))
    return documents.select(F.inline(found))


def parse_commodity_sheets(documents: DataFrame, text: str = "value", header_line: int = 4) -> DataFrame:
    """Commodity feed from whole sheets held as one text each, of any number of headers."""
    dated = sheet_lines(documents, text, header_line).select(F.explode(F.array_compact(F.array(parse_date(F.col("date"))))).alias("date"), "cells")
    return (
        dated.select(F.year("date").alias("year"), F.month("date").alias("month"), F.inline("cells"))
        .withColumn("price", parse_number(F.col("price"))).filter(F.col("price").isNotNull())
    )


def read_commodity_sheet(
    spark: SparkSession, path: str | Sequence[str], header_line: int = 4
) -> DataFrame:
    """Commodity feed from wide sheets saved as CSV, each read by its own header. Files are split
    like any CSV; the lines up to the header fall out as they do not start with a date."""
    frames = []
    for columns, files in header_groups(spark, path, header_line):
        sheet = spark.read.csv(files, schema=_text_schema(columns))
        frames.append(clean_commodity_sheet(sheet))
    return union_feeds([f for f in frames if f.columns == COMMODITY_FEED.names], COMMODITY_FEED, spark)
