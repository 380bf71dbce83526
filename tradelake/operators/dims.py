"""Slowly changing dimensions (type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.keys import surrogate_key
from tradelake.operators.ordered import versions, with_next


def build_scd2(changes: DataFrame, key: str, attrs, ts: str = "changed_at",
               sk: str | None = None) -> DataFrame:
    """Version rows from change rows: valid_from, valid_to, is_active.

    Repeated states are dropped; of several changes at one instant the greatest
    attribute values win.  Rows without key or time make no version.
    """
    states = (
        changes.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(key, F.col(ts).alias("valid_from"))
        .agg(F.max(F.struct(*attrs)).alias("_now"))
    )
    out = versions(states, key, "_now", "valid_from").select(
        key, "_now.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_active"))
    if sk:
        out = out.select(surrogate_key(key, "valid_from").alias(sk), *out.columns)
    return out


def overlapping_versions(dim: DataFrame, key: str) -> DataFrame:
    """Versions that overlap the next one of the same key: an as-of join would repeat facts."""
    far = F.lit("9999-12-31").cast("timestamp")
    starts = dim.groupBy(key, "valid_from").agg(
        F.max(F.coalesce("valid_to", far)).alias("valid_to"),
        F.count(F.lit(1)).alias("versions"),
    )
    ahead = with_next(starts, key, "valid_from", "next_valid_from")
    return (
        ahead.filter((F.col("versions") > 1) | (F.col("next_valid_from") < F.col("valid_to")))
        .select(key, "valid_from", "valid_to", "versions", "next_valid_from")
    )
