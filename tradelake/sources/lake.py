"""Lake tables and event streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def for_date(df: DataFrame, process_date=None) -> DataFrame:
    """Rows of one ``trade_date``; yesterday by default."""
    day = (F.lit(str(process_date)).cast("date") if process_date is not None
           else F.date_sub(F.current_date(), 1))
    return df.filter(F.col("trade_date") == day)


def read_raw(spark: SparkSession, path: str, process_date=None, fmt: str = "parquet") -> DataFrame:
    """Raw trade events of one date, pruned to its partition."""
    return for_date(spark.read.format(fmt).load(path), process_date)


def read_dim(spark: SparkSession, path: str, cols=None, fmt: str = "parquet") -> DataFrame:
    """A reference table, reading only ``cols``."""
    df = spark.read.format(fmt).load(path)
    return df.select(*cols) if cols else df


def replay(spark: SparkSession, path: str, from_ts, to_ts, fmt: str = "parquet") -> DataFrame:
    """Raw events with from_ts <= event_ts < to_ts.

    The table is partitioned by year/month/day/hour; a condition on those columns alone
    picks the partitions, the exact one picks the rows.
    """
    lo, hi = F.lit(from_ts).cast("timestamp"), F.lit(to_ts).cast("timestamp")
    hour = F.make_timestamp(F.col("year").cast("int"), F.col("month").cast("int"),
                            F.col("day").cast("int"), F.col("hour").cast("int"),
                            F.lit(0), F.lit(0))
    return (
        spark.read.format(fmt).load(path)
        .filter((hour >= F.date_trunc("hour", lo)) & (hour < hi))
        .filter((F.col("event_ts") >= lo) & (F.col("event_ts") < hi))
    )


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Union of data sets whose columns differ; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_event_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                      options: dict | None = None) -> DataFrame:
    """Streaming (value STRING, _record_ts TIMESTAMP) from files or a message broker.

    ``_record_ts`` is the broker's record time, or the file's modification time.  The
    read position lives in the query's checkpoint.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    stream = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return stream.select(F.col("value").cast("string").alias("value"),
                             F.col("timestamp").alias("_record_ts"))
    return stream.select("value", F.col("_metadata.file_modification_time").alias("_record_ts"))
