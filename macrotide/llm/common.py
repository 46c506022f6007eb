"""Small helpers shared by the operators: tables, shared staging, words, executor-side batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from macrotide.session import new_folder, stored

#: Java form of the word separators: space, tab, line feed, vertical tab, form feed, return.
SPACES = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Rows of texts that a task turns into Python objects at once; workers keep the memory of their largest step.
SLICE = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared(spark: SparkSession) -> str:
    """A new path below the folder that all executors share, as spark.checkpoint.dir names it; see `new_folder`."""
    return new_folder(spark, "llm")


def staged(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back: later plans start from files
    that outlive any executor, and their sizes steer the joins."""
    return stored(frame, shared(frame.sparkSession))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text):
    """Number of words, in built-in functions only."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def bucket_of(name: str, modulus: int):
    """crc32 of an id written as text, modulo a number: the folds of the labelled rows."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % modulus


def bound_batches(spark: SparkSession, rows: int = SLICE) -> None:
    """Whole texts are sent to Python workers in batches of so many rows at most, where the session allows more: a batch is held
    on both sides, and workers and executors keep that memory. Results do not depend on it."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows))


def map_batches(
    frame: DataFrame, schema: StructType | str,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, list]]],
) -> DataFrame:
    """mapInArrow with a function from record batches to dictionaries of columns."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c := columns[f.name], pa.Array) and c.type == f.type
                 else pa.array(c, type=f.type) for f in arrow], schema=arrow)
        columns = None
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return frame.mapInArrow(run, from_arrow_schema(arrow))
