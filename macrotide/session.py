"""Session settings the jobs were written for.

The library functions never create a session; callers pass frames or their own session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution merges small shuffle partitions, splits skewed ones in joins and
# switches to a broadcast when a side turns out small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int = 200, most: int | None = None) -> int:
    """Shuffle partitions for an input of this size: about 256 MB each. Adaptive execution
    merges partitions that stay small but never splits those of an aggregation, so the
    number has to suit the largest shuffle. ``most`` bounds it where a cluster cannot serve so
    many; partitions grow then."""
    wanted = -(-input_bytes // PARTITION_BYTES)
    return max(cores, wanted if most is None else min(most, wanted))


def configure(
    builder: SparkSession.Builder, settings: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession.Builder:
    chosen = dict(SETTINGS)
    if input_bytes is not None:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, value in {**chosen, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors share, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir or name a folder on shared storage")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str = "stage") -> str:
    """A new path below the shared folder. Where none is set and everything runs on this machine, a temporary folder
    is named once for the session; on a cluster that is an error."""
    local = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if local and not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="run-"))
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written once and read back from there."""
    path = path or new_folder(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
