"""Work along the order of a key's rows without putting a whole key into one task.

Rows are sorted in ranges of (key, time), so a key with a third of all rows spreads over a third of all
tasks.  One pass over each range does the work and marks the rows at its two ends, which need something from
a range before or behind; what was found is written once, and only the marked rows, a few per range, are
looked at again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from tradelake.session import stage
from tradelake.ship import ship

def in_ranges(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """The rows sorted in ranges; rows that are equal in all of ``order`` share a range."""
    ship(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def same(column: pa.Array, other: pa.Array) -> np.ndarray:
    """Where two columns are equal, a null being equal to a null."""
    if pa.types.is_nested(column.type):
        if pa.types.is_struct(column.type):
            fields = [same(column.field(i), other.field(i)) for i in range(column.type.num_fields)]
            null, other_null = (np.asarray(x.is_null()) for x in (column, other))
            return np.logical_and.reduce(fields, initial=True) & ~null & ~other_null | (null & other_null)
        return np.array([a == b for a, b in zip(column.to_pylist(), other.to_pylist())], bool)
    equal = pc.fill_null(pc.equal(column, other), False)
    equal = pc.or_(equal, pc.and_(column.is_null(), other.is_null()))
    if pa.types.is_floating(column.type):
        equal = pc.or_(equal, pc.fill_null(pc.and_(pc.is_nan(column), pc.is_nan(other)), False))
    return np.asarray(equal)


def _starts(column: pa.Array) -> np.ndarray:
    """Where a sorted column differs from the row before; the first row counts."""
    n = len(column)
    out = np.ones(n, bool)
    if n > 1:
        out[1:] = ~same(column.slice(1), column.slice(0, n - 1))
    return out


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _typed(fields: dict[str, DataType | str]) -> StructType:
    out = StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


def _paired(batches: Iterator[pa.RecordBatch], kept: Callable[[pa.Table], np.ndarray]) -> Iterator[tuple[pa.Table, np.ndarray, bool, bool]]:
    """The kept rows of a range, batch by batch, each but the last of the range with a row behind it.

    Yields (rows, whether the next one has the same key, first of the range?, last of the range?); where not
    last, the rows' own last row is only there to be looked at and comes again.
    """
    held, first = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        table = table.combine_chunks()
        table = table.take(pa.array(np.flatnonzero(kept(table)))).combine_chunks()
        held = table.slice(table.num_rows - 1, 1)
        if table.num_rows > 1:
            yield table, ~_starts(_column(table, table.column_names[0]))[1:], first, False
            first = False
    if held is not None:
        yield held, np.zeros(0, bool), first, True


def _next_of(column: pa.Array, follows: np.ndarray) -> pa.Array:
    """For each row but the last, or for a single one, the value of the row behind it, null where that is of another key."""
    if len(column) == 1:
        return pa.nulls(1, column.type)
    return column.slice(1).take(pa.array(np.arange(len(follows)), mask=~follows))


def _ends(n: int, first: bool, last: bool) -> tuple[pa.Array, pa.Array]:
    at = np.arange(n)
    return pa.array((at == 0) & first), pa.array((at == n - 1) & last)


# --- Versions ----------------------------------------------------------------------------

def versions(states: DataFrame, key: str, now: str, since: str) -> DataFrame:
    """(key, now, valid_from, valid_to): runs of equal states of a key; the last run has no end.

    ``states`` has columns ``key``, ``now`` and ``since``, and no two rows of a key at one time.
    """
    rows = states.select(F.col(key).alias("key"), F.col(now).alias("now"), F.col(since).alias("since"))
    of_key, of_now, of_time = (f.dataType for f in rows.schema.fields)
    schema = _typed({"key": of_key, "now": of_now, "valid_from": of_time, "valid_to": of_time, "first": "boolean", "last": "boolean"})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, follows, first, last in _paired(batches, lambda t: _starts(_column(t, "key")) | _starts(_column(t, "now"))):
            until = _next_of(_column(table, "since"), follows)
            table = table.slice(0, len(until))
            yield pa.RecordBatch.from_arrays([*(_column(table, c) for c in ("key", "now", "since")), until, *_ends(len(until), first, last)],
                                             schema.fieldNames())

    found = stage(in_ranges(rows, ["key", "since"]).mapInArrow(scan, schema), "versions")
    by_time = Window.partitionBy("key").orderBy("valid_from")
    edges = found.filter(F.col("first") | F.col("last")).withColumn("before", F.lag(F.struct("now")).over(by_time))
    # a range that goes on with the state of the one before begins no run
    goes_on = F.col("first") & F.col("before").isNotNull() & F.col("before.now").eqNullSafe(F.col("now"))
    edges = edges.withColumn("goes_on", F.coalesce(goes_on, F.lit(False)))
    change = F.when(~F.col("goes_on"), F.col("valid_from")).when(~F.col("last"), F.col("valid_to"))
    behind = by_time.rowsBetween(1, Window.unboundedFollowing)
    until = F.when(F.col("last"), F.first(change, ignorenulls=True).over(behind)).otherwise(F.col("valid_to"))
    columns = ["key", "now", "valid_from", "valid_to"]
    edges = edges.withColumn("valid_to", until).filter(~F.col("goes_on")).select(*columns)
    out = found.filter(~F.col("first") & ~F.col("last")).select(*columns).unionByName(edges)
    return out.withColumnsRenamed({"key": key, "now": now})


# --- The next row --------------------------------------------------------------------------

def with_next(df: DataFrame, key: str, ts: str, out: str) -> DataFrame:
    """Adds ``out``: the time of the next row of the same key; needs at most one row per (key, ts)."""
    rows = df.select(key, *(c for c in df.columns if c != key))
    schema = StructType([*rows.schema.fields, *_typed({"_next": df.schema[ts].dataType, "_first": "boolean", "_last": "boolean"}).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, follows, first, last in _paired(batches, lambda t: np.ones(t.num_rows, bool)):
            until = _next_of(_column(table, ts), follows)
            table = table.slice(0, len(until))
            yield pa.RecordBatch.from_arrays([*(_column(table, c) for c in table.column_names), until, *_ends(len(until), first, last)],
                                             schema.fieldNames())

    found = stage(in_ranges(rows, [key, ts]).mapInArrow(scan, schema), "next")
    by_time = Window.partitionBy(key).orderBy(ts)
    edges = found.filter(F.col("_first") | F.col("_last"))
    edges = edges.withColumn("_next", F.when(F.col("_last"), F.lead(ts).over(by_time)).otherwise(F.col("_next")))
    inner = found.filter(~F.col("_first") & ~F.col("_last"))
    return inner.unionByName(edges).select(*df.columns, F.col("_next").alias(out))


# --- Places --------------------------------------------------------------------------------

def with_place(df: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """Adds ``out``: the place of a row among those of its key in the given order, from 1, without gaps.

    Rows that are equal in key and order get places in no particular order; they may be any number, for ranges part them too.
    """
    rows = df.select("*", F.xxhash64(*df.columns).alias("_tie"))
    whole = StructType([*rows.schema.fields, *_typed({"_place": "long", "_range": "integer", "_begun": "boolean"}).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, held, count, begun = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key))
            starts, at = _starts(keys), np.arange(len(keys))
            of_run = np.cumsum(starts) == 1
            goes_on = held is not None and bool(same(keys.slice(0, 1), held)[0])
            place = at - np.maximum.accumulate(np.where(starts, at, 0)) + 1 + np.where(of_run & goes_on, count, 0)
            # the first key of a range may have begun in a range before
            begun = begun and (held is None or goes_on)
            flags = of_run & begun
            begun = bool(flags[-1])
            held, count = keys.slice(len(keys) - 1, 1), int(place[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(place), pa.array(np.full(len(place), number, np.int32)), pa.array(flags)], whole.fieldNames())

    found = stage(in_ranges(rows, [key, *order, "_tie"]).mapInArrow(scan, whole), "places")
    # the rows before a range that have its first key: they lie at the ends of ranges
    ends = found.groupBy(F.col("_range").alias("r")).agg(F.max(F.struct(key, "_place")).alias("end"))
    firsts = found.filter("_begun").select(F.col("_range").alias("_of"), F.col(key).alias("k")).distinct()
    before = firsts.join(ends, F.col("k").eqNullSafe(F.col(f"end.{key}")) & (F.col("r") < F.col("_of"))).groupBy("_of").agg(
        F.sum("end._place").alias("_before"))
    joined = found.join(F.broadcast(before), F.col("_range") == F.col("_of"), "left")
    place = F.col("_place") + F.when(F.col("_begun"), F.coalesce("_before", F.lit(0))).otherwise(0)
    return joined.select(*df.columns, place.alias(out))


# --- The last version ----------------------------------------------------------------------

def with_last(df: DataFrame, key: str, ts: Column, known: DataFrame, known_key: str, known_ts: str, out: str) -> DataFrame:
    """Adds ``out``: the row of ``known`` with the same key and the greatest time that is not after ``ts``, as a struct.

    The work grows with the rows of both sides, not with their pairs: they are sorted together, and the last row
    of ``known`` is carried along.
    """
    row, version = F.struct(*df.columns), F.struct(*known.columns)
    facts = df.select(F.col(key).alias("key"), ts.alias("ts"), F.lit(1).alias("side"), F.xxhash64(*df.columns).alias("tie"),
                      row.alias("row"), F.lit(None).cast(known.schema).alias("version"))
    told = known.filter(F.col(known_key).isNotNull()).select(
        F.col(known_key).alias("key"), F.col(known_ts).alias("ts"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("tie"),
        F.lit(None).cast(df.schema).alias("row"), version.alias("version"))
    rows = facts.unionByName(told)
    # the last version of a range is written as a row of its own, of side 0
    whole = StructType([*rows.drop("tie").schema.fields, *_typed({"range": "integer", "open": "boolean"}).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, held, first_key, names = TaskContext.get().partitionId(), None, None, whole.fieldNames()

        def built(table: pa.Table, version: pa.Array, opened: np.ndarray) -> pa.RecordBatch:
            n = table.num_rows
            return pa.RecordBatch.from_arrays([
                *(_column(table, c) for c in ("key", "ts", "side", "row")), version,
                pa.array(np.full(n, number, np.int32)), pa.array(opened)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if first_key is None:
                first_key = _column(table, "key").slice(0, 1)
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            keys, side = _column(table, "key"), np.asarray(_column(table, "side"))
            at = np.arange(len(side))
            last = np.maximum.accumulate(np.where(side == 0, at, -1))
            begins = np.maximum.accumulate(np.where(_starts(keys), at, 0))
            none = last < begins
            facts_at = pa.array(np.flatnonzero(side == 1))
            carried = _column(table, "version").take(pa.array(np.where(none, 0, last), mask=none))
            # only the first key of a range may have versions in a range before
            opened = none & (begins == 0) & bool(same(keys.slice(0, 1), first_key)[0])
            if len(facts_at):
                yield built(table.take(facts_at), carried.take(facts_at), opened[np.asarray(facts_at)])
            if last[-1] >= 0:
                held = table.slice(int(last[-1]), 1)
        if held is not None:
            yield built(held, _column(held, "version"), np.zeros(1, bool))

    found = stage(in_ranges(rows, ["key", "ts", "side", "tie"]).mapInArrow(scan, whole), "last")
    marks = found.filter("side = 0").select(F.col("key").alias("k"), F.col("range").alias("r"), F.col("version").alias("v"))
    # a range takes over the last version of the nearest range before it that has one of the same key
    opened = found.filter("side = 1 AND open").select("key", "range").distinct()
    carry = opened.join(marks, (F.col("key") == F.col("k")) & (F.col("r") < F.col("range"))).groupBy("key", "range").agg(
        F.max_by("v", "r").alias("carried")).select("range", "carried")
    filled = found.filter("side = 1").join(F.broadcast(carry), "range", "left")
    version = F.when(F.col("open"), F.col("carried")).otherwise(F.col("version"))
    return filled.select("row.*", version.alias(out))


# --- All rows of two sides -----------------------------------------------------------------

def full_match(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """(row, found): a full outer match on a key that no two rows of ``known`` share.

    Each row of ``df`` with the row of ``known`` of its key or null, and each other row of ``known`` with a null row.
    Rows without a key find nothing.  Both sides are read into one shuffle, and a key with a third of all rows is spread.
    """
    rows = df.select(F.col(key).alias("key"), F.lit(1).alias("side"), F.xxhash64(*df.columns).alias("tie"),
                     F.struct(*df.columns).alias("row"), F.lit(None).cast(known.schema).alias("found")).unionByName(
        known.select(F.col(known_key).alias("key"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("tie"),
                     F.lit(None).cast(df.schema).alias("row"), F.struct(*known.columns).alias("found")))
    whole = StructType([*rows.drop("tie").schema.fields, *_typed({"range": "integer", "open": "boolean", "last": "boolean"}).fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, held, used, first_key = TaskContext.get().partitionId(), None, False, None

        def built(table: pa.Table, found: pa.Array, opened: np.ndarray, last: bool) -> pa.RecordBatch:
            n = table.num_rows
            return pa.RecordBatch.from_arrays([
                *(_column(table, c) for c in ("key", "side", "row")), found, pa.array(np.full(n, number, np.int32)),
                pa.array(opened), pa.array(np.full(n, last))], whole.fieldNames())

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if first_key is None:
                first_key = _column(table, "key").slice(0, 1)
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            keys, side, at = _column(table, "key"), np.asarray(_column(table, "side")), np.arange(table.num_rows)
            told = (side == 0) & ~np.asarray(keys.is_null())
            starts = _starts(keys)
            begins = np.maximum.accumulate(np.where(starts, at, 0))
            last = np.maximum.accumulate(np.where(told, at, -1))
            none = (last < begins) | np.asarray(keys.is_null())
            met = np.zeros(table.num_rows, bool)  # rows of known with a row of the other side behind them
            met[:-1] = told[:-1] & (side[1:] == 1) & ~starts[1:]
            if held is not None:
                met[0] |= used
            facts = np.flatnonzero(side == 1)
            if len(facts):
                found = _column(table, "found").take(pa.array(np.where(none, 0, last), mask=none))
                opened = none & (begins == 0) & bool(same(keys.slice(0, 1), first_key)[0]) & ~np.asarray(keys.is_null())
                yield built(table.take(pa.array(facts)), found.take(pa.array(facts)), opened[facts], False)
            lone = np.flatnonzero((side == 0) & ~met & (at != last[-1]))
            if len(lone):
                rest = table.take(pa.array(lone))
                yield built(rest, _column(rest, "found"), np.ones(len(lone), bool), False)
            if last[-1] >= 0:
                held, used = table.slice(int(last[-1]), 1), bool(met[last[-1]])
        if held is not None:
            yield built(held, _column(held, "found"), np.array([not used]), True)

    result = stage(in_ranges(rows, ["key", "side", "tie"]).mapInArrow(scan, whole), "match", "zstd")
    # only the last row of known in a range can belong to rows at the beginning of ranges behind it
    ends = result.filter("side = 0 AND last").select(F.col("key").alias("k"), F.col("range").alias("r"), F.col("found").alias("f"))
    opened = result.filter("side = 1 AND open").select("key", "range").distinct()
    carry = opened.join(ends, (F.col("key") == F.col("k")) & (F.col("r") < F.col("range"))).select("range", F.col("f").alias("carried"))
    met = result.filter("side = 1").join(F.broadcast(carry), "range", "left").select(
        "row", F.when(F.col("open"), F.col("carried")).otherwise(F.col("found")).alias("found"))
    lone = result.filter("side = 0 AND open").join(F.broadcast(opened.select("key").distinct()), "key", "left_anti").select("row", "found")
    return met.unionByName(lone)
