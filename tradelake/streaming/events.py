"""Trade event streams: land, reject, aggregate, merge.

Events are parsed once, and each output is a query of its own with its own checkpoint.  File outputs are
exactly-once; the merge is idempotent, so a repeated batch changes nothing.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tradelake.functions.parse import parse_events, split_valid
from tradelake.operators import dedup, enrich, merge, windows
from tradelake.schemas import CURATED_PARTITIONS, TRADE_KEY
from tradelake.session import stage

WATERMARK = "10 seconds"
TRIGGER = {"processingTime": "60 seconds"}
RAW_PARTITIONS = ["trade_date", "year", "month", "day", "hour"]


def with_watermark(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return df.withWatermark("event_ts", delay)


def drop_redelivered(df: DataFrame, delay: str = WATERMARK,
                     keys=("trade_id", "event_type", "event_ts")) -> DataFrame:
    """Drop repeats of an event that arrive within the watermark delay."""
    return with_watermark(df, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_notional(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """The 5-minute aggregate over a watermarked stream."""
    return windows.notional_5m(with_watermark(df, delay))


def raw_layout(df: DataFrame) -> DataFrame:
    """Landed rows with their date-part partition columns."""
    part = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return df.withColumns({name: F.date_format("event_ts", fmt) for name, fmt in part.items()})


def write_raw(df: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Land all rows, late ones included, as Parquet by date and hour."""
    return (
        raw_layout(df).writeStream.format("parquet").partitionBy(*RAW_PARTITIONS)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER)).start()
    )


def dead_letters(df: DataFrame) -> DataFrame:
    """(key, value): the reason and original text of a rejected event as JSON."""
    value = F.to_json(F.struct("valid", "reason", "raw"), {"ignoreNullFields": "false"})
    return df.select(F.col("trade_id").alias("key"), value.alias("value"))


def write_dead_letters(df: DataFrame, path: str | None, checkpoint: str, trigger=None,
                       fmt: str = "json", options: dict | None = None) -> StreamingQuery:
    """Rejected events to files, or with ``fmt`` and ``options`` to a message topic."""
    writer = (dead_letters(df).writeStream.format(fmt).options(**(options or {}))
              .option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)))
    if path:
        writer = writer.option("path", path)
    return writer.start()


def write_metrics(df: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Closed windows of ``windowed_notional`` as files."""
    return (
        windows.flat(df).writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER)).start()
    )


def upsert_to_table(df: DataFrame, path: str, checkpoint: str, trigger=None,
                    keys=tuple(TRADE_KEY), partitions=tuple(CURATED_PARTITIONS),
                    guard: str | None = "updated_at", keyless: str | None = None,
                    schema: StructType | None = None) -> StreamingQuery:
    """Merge each micro-batch into the table; the guard makes a repeated batch harmless.

    Rows that lack a part of their key cannot be merged.  They go as they are to the folder
    ``keyless`` (default: the table's path and "-keyless"), below one folder per batch, which a
    repeated batch writes again.  A declared ``schema`` of the table saves each batch the footers of all files.
    """
    aside = keyless or f"{path.rstrip('/')}-keyless"

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = stage(batch, "batch")
        keyed, loose = merge.split_keyed(batch, keys)
        if not loose.isEmpty():
            loose.write.mode("overwrite").parquet(f"{aside}/batch={batch_id}")
        newest = dedup.latest(keyed, list(keys), guard, null_keys="drop")
        merge.upsert_table(batch.sparkSession, path, newest, keys, partitions, guard, schema=schema)

    return (df.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or TRIGGER)).start())


def write_parsed(parsed: DataFrame, path: str, checkpoint: str, trigger=None) -> StreamingQuery:
    """Parsed events, valid and rejected ones, as files that further queries read as a stream."""
    return (parsed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or TRIGGER)).start())


def start_all(events: DataFrame, instruments: DataFrame, counterparties: DataFrame,
              paths: dict[str, str], checkpoints: str, trigger=None) -> list[StreamingQuery]:
    """Dead letters, raw landing and window aggregate of one event stream, which is read and parsed once.

    ``events`` is (value, _record_ts); ``paths``: parsed, dead_letters, raw, metrics.  The first query lands the
    parsed events; the others read what it has landed.  All of them write files exactly once, so each may stop and start
    again by itself.  With a trigger that ends, the first query is waited for before the others start.
    """
    parsed = parse_events(events)
    landed = paths.get("parsed") or f"{paths['raw'].rstrip('/')}-parsed"
    first = write_parsed(parsed, landed, f"{checkpoints}/parsed", trigger)
    if {"availableNow", "once"} & set(trigger or ()):
        first.awaitTermination()
    else:  # a folder can be read as a stream before the first batch has come
        parsed.sparkSession.createDataFrame([], parsed.schema).write.mode("append").parquet(landed)
    valid, invalid = split_valid(parsed.sparkSession.readStream.schema(parsed.schema).parquet(landed))
    enriched = enrich.enrich_stream(valid, instruments, counterparties)
    return [
        first,
        write_dead_letters(invalid, paths["dead_letters"], f"{checkpoints}/dead_letters", trigger),
        write_raw(enriched, paths["raw"], f"{checkpoints}/raw", trigger),
        write_metrics(windowed_notional(enriched), paths["metrics"],
                      f"{checkpoints}/metrics", trigger),
    ]


class LateRows(StreamingQueryListener):
    """Writes down what watermarks drop: a row per micro-batch that dropped some, in a table below ``path``.

    Add it with ``spark.streams.addListener`` before the queries start.  Progress of any number of batches is
    kept, over restarts too; a batch that is repeated counts once.  An aggregate drops what its groups
    have become: one row per group and batch.
    """

    SCHEMA = "query string, batch long, dropped long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if dropped:
            row = [(str(progress.id), progress.batchId, dropped)]
            self.spark.createDataFrame(row, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Waits until all that a finished query has reported is written; progress is reported behind time."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, seconds)

    def totals(self) -> DataFrame:
        """(query, dropped) over all batches."""
        try:
            rows = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException:  # nothing was dropped yet
            rows = self.spark.createDataFrame([], self.SCHEMA)
        once = rows.groupBy("query", "batch").agg(F.max("dropped").alias("dropped"))
        return once.groupBy("query").agg(F.sum("dropped").alias("dropped"))
