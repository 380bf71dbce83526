"""Keyed message shape: key, JSON value, headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.operators.ordered import with_place


def header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), F.encode(value.cast("string"), "UTF-8").alias("value"))


def to_keyed(df: DataFrame, key: str, headers: dict[str, Column] | None = None,
             order_by=None, value_cols=None, sequence: str | None = None) -> DataFrame:
    """(key STRING, value JSON STRING, headers ARRAY<STRUCT<key, value BINARY>>).

    NULL fields stay in the JSON.  With ``order_by`` each task sends its rows of one key in that order, but a key
    that holds a large share of the rows is spread over several tasks, which send side by side.  ``sequence``
    names a header with the row's place among all rows of its key, from 1 and without gaps, by which a
    consumer restores the order and sees what is missing.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    if sequence and not order:
        raise ValueError("a sequence needs an order")
    value_cols = list(value_cols or df.columns)
    headers = dict(headers or {})
    if sequence:
        df = with_place(df, key, order, "_place")
        headers[sequence] = F.col("_place")
    elif order:
        df = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    value = F.to_json(F.struct(*value_cols), {"ignoreNullFields": "false"})
    pairs = [header(name, col) for name, col in headers.items()]
    return df.select(
        F.col(key).cast("string").alias("key"),
        value.alias("value"),
        (F.array(*pairs) if pairs else
         F.array().cast("array<struct<key:string,value:binary>>")).alias("headers"),
    )


def split_publishable(df: DataFrame, mandatory=("trade_id", "instrument_id")):
    """(publishable, dead letters): rows lacking a mandatory key go to the second."""
    ok = F.lit(True)
    for name in mandatory:
        ok = ok & F.col(name).isNotNull()
    return df.filter(ok), df.filter(~ok)


def trade_messages(df: DataFrame, source_system: str, correlation_id: str = "correlation_id",
                   order_by="event_ts", sequence: str | None = None) -> DataFrame:
    """Trade events keyed by instrument with the three trace headers, and their sequence where it is named."""
    value_cols = [c for c in df.columns if c != correlation_id]
    return to_keyed(df, "instrument_id", {
        "correlationId": F.col(correlation_id),
        "sourceSystem": F.lit(source_system),
        "schemaVersion": F.lit("v1"),
    }, order_by=order_by, value_cols=value_cols, sequence=sequence)


def dead_letter_messages(df: DataFrame) -> DataFrame:
    """Failed publishes, keyed by trade id, without headers."""
    return to_keyed(df, "trade_id")
