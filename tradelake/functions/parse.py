"""JSON trade events: parse once, keep every row, say why a row is bad."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.schemas import EVENT_COLUMNS, REQUIRED_EVENT_FIELDS

# The text is parsed as one member of a wrapping object, followed by a closing mark, so
# that anything after the event's own closing brace is an error.
_MARK = "end-of-event"

_FIELDS = "struct<" + ",".join(
    f"{name}:{'decimal(20,4)' if name == 'notional' else 'string'}" for name in EVENT_COLUMNS
) + ",eventTimestamp:bigint,updatedAt:bigint>"

# timestamp_millis raises outside this range (years 1 to 9999)
_MIN_MILLIS, _MAX_MILLIS = -62135596800000, 253402300799999


def millis_to_ts(millis: Column) -> Column:
    """Epoch milliseconds to TIMESTAMP, NULL where the number is no usable time."""
    return F.timestamp_millis(F.when(millis.between(_MIN_MILLIS, _MAX_MILLIS), millis))


def missing_fields(keys: Column, required=tuple(REQUIRED_EVENT_FIELDS)) -> Column:
    """Sorted names of ``required`` keys absent from a parsed event's keys.

    A key that is present with a JSON null counts as present.
    """
    return F.array_except(F.array(*[F.lit(name) for name in sorted(required)]), keys)


def assign_event_time(df: DataFrame, millis: str = "event_millis",
                      record_ts: str = "_record_ts") -> DataFrame:
    """``event_ts`` from the payload, or the record's own time where that is unusable."""
    return df.withColumn("event_ts", F.coalesce(millis_to_ts(F.col(millis)), F.col(record_ts)))


def parse_events(df: DataFrame, value: str = "value", record_ts: str = "_record_ts") -> DataFrame:
    """Typed trade events plus ``valid``, ``reason``, ``raw`` and ``event_ts``.

    The text is parsed one time into a VARIANT; numbers keep all their digits and
    numeric text is accepted wherever a number is.  Bad text never fails the job.
    """
    wrapped = F.concat(F.lit('{"event":'), F.col(value), F.lit(f',"{_MARK}":1}}'))

    def keys_of(path):
        return F.map_keys(F.try_variant_get("_v", path, "map<string,variant>"))

    # Made by a generator, so that a filter on these columns stays above it; pushed
    # below, it would parse the text again for every column it uses.
    pieces = df.withColumn("_v", F.try_parse_json(wrapped)).select(F.inline(F.array(F.struct(
        F.col(value).alias("raw"),
        F.col(record_ts).cast("timestamp").alias("_record_ts"),
        keys_of("$").alias("_outer"),
        keys_of("$.event").alias("_keys"),
        F.try_variant_get("_v", "$.event", _FIELDS).alias("_e"),
    ))))
    is_json = (F.size("_outer") == 2) & F.array_contains("_outer", _MARK)
    missing = missing_fields(F.col("_keys"))
    reason = (
        F.when(~F.coalesce(is_json, F.lit(False)), F.lit("Malformed JSON"))
        .when(F.col("_keys").isNull(), F.lit("Not a JSON object"))
        .when(F.size(missing) > 0,
              F.concat(F.lit("Missing fields: {"), F.array_join(missing, ", "), F.lit("}")))
        .when(F.col("_e.notional").isNull(), F.lit("Bad notional"))
    )
    typed = pieces.select(
        "raw", "_record_ts", reason.alias("reason"),
        *[F.col(f"_e.{src}").alias(dst) for src, dst in EVENT_COLUMNS.items()
          if src not in ("tradeDate", "settlementDate")],
        F.try_to_date("_e.tradeDate").alias("trade_date"),
        F.try_to_date("_e.settlementDate").alias("settlement_date"),
        F.col("_e.eventTimestamp").alias("event_millis"),
        millis_to_ts(F.col("_e.updatedAt")).alias("updated_at"),
    )
    out = assign_event_time(typed)
    return out.select(
        "trade_id", "event_type", "instrument_id", "notional", "currency",
        F.coalesce("trade_date", F.to_date("event_ts")).alias("trade_date"),
        "settlement_date", "trader_id", "book_id", "counterparty_lei", "status",
        F.coalesce("updated_at", "event_ts").alias("updated_at"),
        "event_ts",
        F.col("reason").isNull().alias("valid"), "reason", "raw",
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by the ``valid`` flag; every row lands in exactly one."""
    flag = F.coalesce(F.col("valid"), F.lit(False))
    return df.filter(flag), df.filter(~flag)
