"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import TRADE_KEY


def any_null(cols):
    cond = F.lit(False)
    for name in cols:
        cond = cond | F.col(name).isNull()
    return cond


def loose_number(keys) -> Column:
    """A number of its own for each row that lacks a part of its key, NULL for all others: grouped by the key and
    this, such rows stay by themselves and spread over all tasks."""
    return F.when(any_null(keys), F.monotonically_increasing_id())


def _orderable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def latest(df: DataFrame, keys, order="updated_at", ties=None, null_keys: str = "keep") -> DataFrame:
    """One row per key: highest ``order`` first, then lowest ``ties``.

    ``ties`` defaults to all other columns, so the choice never depends on row order.
    Rows with a NULL key belong to no key; they all stay (or are left out with
    ``null_keys="drop"``) and never pile up in one task.

    Spark keeps only the best row per key *before* the shuffle as well
    (WindowGroupLimit), so a key holding a large share of all rows sends one row per
    map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    if ties is None:
        ties = [f.name for f in df.schema.fields
                if f.name not in keys and f.name not in order and _orderable(f)]
    ranking = [F.col(c).desc_nulls_last() for c in order]
    ranking += [F.col(c).asc_nulls_last() for c in ties]
    if null_keys == "drop":
        rows, by = df.filter(~any_null(keys)), keys
    else:
        rows, by = df.withColumn("_loose", loose_number(keys)), [*keys, "_loose"]
    window = Window.partitionBy(*by).orderBy(*ranking)
    best = rows.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1)
    return best.select(*df.columns)


def as_of(df: DataFrame, ts, keys=tuple(TRADE_KEY), order="updated_at", ties=None) -> DataFrame:
    """The newest row per key as it stood at ``ts`` (inclusive), from the full history."""
    first = order if isinstance(order, str) else order[0]
    return latest(df.filter(F.col(first) <= F.lit(ts).cast("timestamp")), keys, order, ties)
