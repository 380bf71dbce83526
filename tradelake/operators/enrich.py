"""Reference-data lookups for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from tradelake.operators.lookup import lookup
from tradelake.operators.ordered import with_last

INSTRUMENT_COLUMNS = ["instrument_id", "instrument_name", "asset_class", "sector"]


def enrich_batch(df: DataFrame, instruments: DataFrame, small: bool | None = None) -> DataFrame:
    """Add name, asset class and sector by instrument; unmatched trades stay."""
    return lookup(df, instruments.select(*INSTRUMENT_COLUMNS), "instrument_id", small)


def current(dim: DataFrame) -> DataFrame:
    """The active version of each key; a missing flag counts as active."""
    return dim.filter(F.coalesce(F.col("is_active"), F.lit(True)))


def _spread(df: DataFrame, key: str):
    """0 for a row with a key, else a hash of the row: no key is found, so such rows need not meet in one task."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    return F.when(df[key].isNull(), F.xxhash64(*[df[c] for c in plain])).otherwise(0)


def _with_columns_of(df, dim, key, dim_key, cols, condition, small, spread=False):
    """Left lookup that adds ``cols`` of ``dim`` and no other column.

    With ``spread`` rows without key go to all tasks, at some bytes a row: for streams with state, whose plans Spark does not adapt to skew.
    """
    d = dim.select(*[F.col(c).alias(f"_d_{c}") for c in dim.columns])
    rows, match = df, (df[key] == d[f"_d_{dim_key}"]) & condition(d)
    if spread and df.schema[key].nullable:
        rows = df.withColumn("_spread", _spread(df, key))
        # 0 for every version, written so that it is not folded, for a constant would not be a key of the shuffle
        match = (rows["_spread"] == F.pmod(F.xxhash64(d[f"_d_{dim_key}"]), F.lit(1))) & match
    joined = lookup(rows, d, match, small)
    return joined.select(*[df[c] for c in df.columns],
                         *[d[f"_d_{c}"].alias(c) for c in cols])


def asof_dim(df: DataFrame, dim: DataFrame, key: str, ts: str, cols,
             dim_key: str | None = None, small: bool | None = None) -> DataFrame:
    """``cols`` of the version valid at ``ts``: valid_from <= ts < valid_to, open end = still valid.

    Versions of one key must not overlap (see ``dims.overlapping_versions``).
    """
    dim_key = dim_key or key
    at = df[ts].cast("timestamp")
    needed = dim.select(*dict.fromkeys([dim_key, *cols, "valid_from", "valid_to"]))
    return _with_columns_of(
        df, needed, key, dim_key, cols,
        lambda d: (at >= d["_d_valid_from"])
        & (d["_d_valid_to"].isNull() | (at < d["_d_valid_to"])),
        small,
    )


def asof_carried(df: DataFrame, dim: DataFrame, key: str, ts: str, cols, dim_key: str | None = None) -> DataFrame:
    """As ``asof_dim``, in work that does not grow with the versions per key: facts and versions are sorted
    together in ranges of key and time, and the last version is carried along.

    The choice where keys have more than some tens of versions, or one key has many versions and many facts;
    ``asof_dim`` compares a fact with every version of its key, but need not move the facts.
    """
    dim_key = dim_key or key
    at = df[ts].cast("timestamp")
    needed = dim.filter(F.col("valid_from").isNotNull()).select(*dict.fromkeys([dim_key, *cols, "valid_from", "valid_to"]))
    joined = with_last(df, key, at, needed, dim_key, "valid_from", "_version")
    valid = F.col("_version.valid_to").isNull() | (F.col(ts).cast("timestamp") < F.col("_version.valid_to"))
    return joined.select(*df.columns, *[F.when(valid, F.col(f"_version.{c}")).alias(c) for c in cols])


def current_dim(df: DataFrame, dim: DataFrame, key: str, cols,
                dim_key: str | None = None, small: bool | None = None, spread: bool = False) -> DataFrame:
    """``cols`` of the active version, whatever the trade's date."""
    dim_key = dim_key or key
    needed = current(dim).select(*dict.fromkeys([dim_key, *cols]))
    return _with_columns_of(df, needed, key, dim_key, cols, lambda d: F.lit(True), small, spread)


def plain_dim(df: DataFrame, dim: DataFrame, key: str, cols,
              dim_key: str | None = None, small: bool | None = None, spread: bool = False) -> DataFrame:
    """``cols`` of an unversioned dimension."""
    dim_key = dim_key or key
    needed = dim.select(*dict.fromkeys([dim_key, *cols]))
    return _with_columns_of(df, needed, key, dim_key, cols, lambda d: F.lit(True), small, spread)


def enrich_stream(df: DataFrame, instruments: DataFrame, counterparties: DataFrame,
                  small: dict[str, bool] | None = None) -> DataFrame:
    """Instrument name and class, counterparty name, for streams and batches alike.

    A trade of an unknown instrument keeps the stand-in name ``INSTRUMENT_<id>``.  No
    broadcast is forced, for the tables may grow while a stream runs: Spark looks
    at their size anew in every micro-batch.
    """
    small = small or {}
    named = current_dim(df, instruments, "instrument_id", ["instrument_name", "asset_class"],
                        small=small.get("instruments"), spread=True)
    named = plain_dim(named, counterparties, "counterparty_lei", ["counterparty_name"],
                      dim_key="lei_code", small=small.get("counterparties"), spread=True)
    stand_in = F.concat(F.lit("INSTRUMENT_"), F.col("instrument_id"))
    return named.withColumn("instrument_name", F.coalesce("instrument_name", stand_in))
