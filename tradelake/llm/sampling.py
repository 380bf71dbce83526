"""Bounded samples for fitting a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 1_000_000


def by_hash(rows: int, total: int, *columns: Column) -> Column:
    """True for about ``rows`` of ``total`` rows, chosen by a hash of the columns: the same rows each time,
    however the table is partitioned; all rows if there are no more than that."""
    if total <= rows:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), *columns), F.lit(STEPS)) < max(1, rows * STEPS // total)


def labelled_ids(labels: DataFrame, rows: int, *columns: str) -> DataFrame:
    """About ``rows`` labelled ids with their labels, one row an id; small enough to broadcast."""
    own = labels.filter(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    return own.filter(by_hash(rows, own.count(), F.col("doc_id")))
