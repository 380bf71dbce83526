"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Left to the cluster on purpose: master, memory, executor counts and shuffle
# partitions.  AQE coalesces small shuffle partitions, splits skewed ones and
# turns a join into a broadcast join once the measured size allows it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_spark(app_name: str = "tradelake", **overrides: str) -> SparkSession:
    """A session with the engine's defaults; ``overrides`` use ``_`` in place of ``.``."""
    builder = SparkSession.builder.appName(app_name)
    settings = {**DEFAULTS, **{k.replace("_", "."): v for k, v in overrides.items()}}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tradelake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within are removed as each write ends, not when the driver happens to collect its garbage:
    a job of several writes then needs the disk of the largest, not of all."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str = "stage", codec: str | None = None, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Used where one result feeds several outputs: nothing is recomputed, and a
    lost executor costs a re-read of the written files.  ``codec`` replaces the session's Parquet codec.  A scan holds
    up to 4,096 rows of a row group at once, unpacked: where rows are very long, ``group_rows`` is the most of them in a row group.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", str(group_rows))
    with freed(df.sparkSession):
        writer.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
