"""Read side: trade search, paging, lifecycle, instruments, daily PnL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradelake.operators import dedup
from tradelake.operators.enrich import current
from tradelake.schemas import INSTRUMENT_ROW, TRADE_KEY, TRADE_ROW

# The most rows that a page and a nested list may have; more than that is refused.
PAGE_MAX = 1000
NESTED_MAX = 500
# Rows that one task may hold to find a page
DIRECT = 10_000
STEP = ["updated_at", "event_type", "status", "notional"]


def _checked(limit: int, most: int) -> int:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    return limit


def as_trade_rows(df: DataFrame, extra=()) -> DataFrame:
    """The 15-column trade row; amounts as floating point, zero stays zero."""
    amounts = {"notional", "notional_usd"}
    return df.select(*[F.col(c).cast("double").alias(c) if c in amounts else F.col(c)
                       for c in [*TRADE_ROW, *extra]])


def as_instrument_rows(df: DataFrame) -> DataFrame:
    """The 6-column instrument row."""
    return df.select(*INSTRUMENT_ROW)


def matching(df: DataFrame, from_date, to_date, asset_class=None, desk=None, book_id=None,
             status=None) -> DataFrame:
    """Trades of a date range (both ends included) that meet every given condition."""
    out = df.filter(F.col("trade_date").between(F.lit(str(from_date)).cast("date"),
                                                F.lit(str(to_date)).cast("date")))
    given = {"asset_class": asset_class, "desk": desk, "book_id": book_id, "status": status}
    for name, value in given.items():
        if value is not None:
            out = out.filter(F.col(name) == value)
    return out


def _above(col: str, value) -> Column:
    return F.col(col).isNotNull() if value is None else F.col(col) > value


def _after(cursor) -> Column:
    """Rows behind the cursor; a NULL sorts before all values, as in ``orderBy``."""
    trade_id, event_type = cursor
    return F.coalesce(_above("trade_id", trade_id) | (
        F.col("trade_id").eqNullSafe(trade_id) & _above("event_type", event_type)), F.lit(False))


def search_trades(df: DataFrame, from_date, to_date, asset_class=None, desk=None, book_id=None,
                  status=None, limit: int = 100, cursor=None, fields=None) -> DataFrame:
    """One keyset page in (trade_id, event_type) order, after ``cursor`` where given."""
    page = matching(df, from_date, to_date, asset_class, desk, book_id, status)
    if cursor is not None:
        page = page.filter(_after(cursor))
    page = page.orderBy(*TRADE_KEY).limit(_checked(limit, PAGE_MAX))
    return page.select(*fields) if fields else page.select(*TRADE_ROW, "event_type")


def search_connection(df: DataFrame, from_date, to_date, asset_class=None, desk=None,
                      book_id=None, status=None, limit: int = 100, cursor=None,
                      fields=None) -> DataFrame:
    """One row: the page's trades and page_info(page_count, has_next_page, next_cursor).

    Reads one row more than the page, at most 1001 in all.
    """
    size = _checked(limit, PAGE_MAX)
    fields = list(fields or [*TRADE_ROW, "event_type"])
    page = matching(df, from_date, to_date, asset_class, desk, book_id, status)
    if cursor is not None:
        page = page.filter(_after(cursor))
    page = page.orderBy(*TRADE_KEY).limit(size + 1)
    rows = page.agg(F.array_sort(F.collect_list(F.struct(
        *TRADE_KEY, F.struct(*fields).alias("trade")))).alias("r"))
    kept = F.slice("r", 1, size)
    more = F.size("r") > size
    last = F.element_at(kept, -1)
    cursor_type = "struct<trade_id:string,event_type:string>"
    return rows.select(
        F.transform(kept, lambda x: x["trade"]).alias("trades"),
        F.struct(
            F.size(kept).alias("page_count"),
            more.alias("has_next_page"),
            F.when(more, F.struct(last["trade_id"].alias("trade_id"),
                                  last["event_type"].alias("event_type")))
            .cast(cursor_type).alias("next_cursor"),
        ).alias("page_info"),
    )


def search_trades_page(df: DataFrame, from_date, to_date, asset_class=None, desk=None,
                       book_id=None, status=None, page: int = 0, size: int = 100,
                       fields=None) -> DataFrame:
    """Page number ``page`` of ``size`` rows in (trade_id, event_type) order, NULLs first.

    Rows of equal keys come in the order of a hash of the page's columns, so pages never
    overlap.  A page within the first ``DIRECT`` rows is read at once.  For one behind them the
    sorted keys are counted in ranges, again and again within the ranges that hold the page,
    until few rows are left; just those are read.  Nothing is written, and no task holds the
    rows that are skipped.
    """
    if page < 0:
        raise ValueError("page must not be negative")
    first = page * _checked(size, PAGE_MAX)
    columns = list(fields or [*TRADE_ROW, "event_type"])
    hits = matching(df, from_date, to_date, asset_class, desk, book_id, status)
    if first + size > DIRECT:
        hits, first = _around(hits, columns, first, size)
    return hits.orderBy(*TRADE_KEY, F.xxhash64(*columns)).offset(first).limit(size).select(*columns)


def _around(hits: DataFrame, columns: list[str], first: int, size: int) -> tuple[DataFrame, int]:
    """The rows of the ranges that hold a page, and where in them it begins."""
    spark = hits.sparkSession
    ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hashed, key = F.xxhash64(*columns), list(TRADE_KEY)
    while True:
        order = [F.col(c) for c in TRADE_KEY] + ([hashed.alias("_tie")] if len(key) > 2 else [])
        counted = hits.select(*order).repartitionByRange(ranges, *key).groupBy(F.spark_partition_id().alias("range")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high"))
        found = sorted(counted.collect(), key=lambda r: r["range"])  # one row per range
        at, held = 0, []
        for r in found:
            if at + r["rows"] > first and at < first + size:
                held.append((at, r))
            at += r["rows"]
        if not held:
            return hits.limit(0), 0
        before, rows = held[0][0], sum(r["rows"] for _, r in held)
        low, high = held[0][1]["low"], held[-1][1]["high"]
        hits = hits.filter(_from(key, low, hashed, False) & _from(key, high, hashed, True))
        first -= before
        if first + size <= DIRECT:
            return hits, first
        if len(key) > 2 and low == high:  # any of these rows will do, for they are all the same
            return hits.limit(min(size, rows - first)), 0
        if rows == at and len(key) > 2:  # the page parts two rows that are repeated very often
            return hits, first
        if rows == at:  # one key holds them all: go on by the hash of its rows
            key = [*TRADE_KEY, "_tie"]


def _from(key: list[str], bound, hashed: Column, below: bool) -> Column:
    """Rows not before ``bound`` in the order of ``key``, or not behind it; a NULL comes first."""
    out = F.lit(True)
    for name in reversed(key):
        column = hashed if name == "_tie" else F.col(name)
        value = bound[name]
        equal = column.eqNullSafe(F.lit(value))
        if value is None:
            beyond = F.lit(False) if below else column.isNotNull()
        elif below:
            beyond = column.isNull() | (column < value)
        else:
            beyond = F.coalesce(column > value, F.lit(False))
        out = F.coalesce(beyond, F.lit(False)) | (equal & out)
    return out


def find_trade(df: DataFrame, trade_id: str, fields=None) -> DataFrame:
    """The latest state of one trade; no row if it is unknown."""
    one = dedup.latest(df.filter(F.col("trade_id") == trade_id), "trade_id",
                       ["updated_at", "event_type"])
    return one.select(*fields) if fields else one


def latest_state(df: DataFrame) -> DataFrame:
    """The last lifecycle row of every trade."""
    return dedup.latest(df, "trade_id", ["updated_at", "event_type"])


def lifecycle_steps(df: DataFrame, ids=None) -> DataFrame:
    """Every step of some trades or of all, one row each, by trade and time.

    The sort splits a trade of any length over tasks.
    """
    rows = df.filter("trade_id IS NOT NULL") if ids is None else df.filter(F.col("trade_id").isin(list(ids)))
    return rows.select("trade_id", *STEP).orderBy("trade_id", *STEP)


def trade_lifecycle(df: DataFrame, ids=None) -> DataFrame:
    """(trade_id, events): each trade's full history in time order, for some ids or for all.

    A list is one cell and has to fit in a task; where a trade may have millions of steps, take
    ``lifecycle_steps``.
    """
    rows = df.filter("trade_id IS NOT NULL") if ids is None else df.filter(F.col("trade_id").isin(list(ids)))
    return rows.groupBy("trade_id").agg(F.array_sort(F.collect_list(F.struct(*STEP))).alias("events"))


def recent_trades(df: DataFrame, as_of, days: int = 7, limit: int = 100) -> DataFrame:
    """Per instrument the newest trades of the last ``days`` days up to ``as_of``.

    The per-instrument limit also applies before the shuffle (WindowGroupLimit), so a
    busy instrument sends at most ``limit`` rows per map task.
    """
    day = F.lit(str(as_of)).cast("date")
    k = _checked(limit, NESTED_MAX)
    window = Window.partitionBy("instrument_id").orderBy(
        F.col("trade_date").desc(), "trade_id", "event_type")
    recent = df.filter((F.col("trade_date") > F.date_sub(day, days)) & (F.col("trade_date") <= day)
                       & F.col("instrument_id").isNotNull())
    return (recent.withColumn("position", F.row_number().over(window))
            .filter(F.col("position") <= k))


def instruments_with_recent_trades(dim: DataFrame, fct: DataFrame, as_of, days: int = 7,
                                   limit: int = 100) -> DataFrame:
    """Active instruments, each with its list of recent trades (empty if it has none)."""
    rows = recent_trades(fct, as_of, days, limit)
    trade = F.struct("position", *[c for c in TRADE_ROW if c != "instrument_id"], "event_type")
    nested = rows.groupBy("instrument_id").agg(
        F.array_sort(F.collect_list(trade)).alias("recent_trades"))
    empty = F.array().cast(nested.schema["recent_trades"].dataType)
    return (as_instrument_rows(current(dim)).join(nested, "instrument_id", "left")
            .withColumn("recent_trades", F.coalesce("recent_trades", empty)))


def find_instrument(dim: DataFrame, instrument_id: str) -> DataFrame:
    return as_instrument_rows(current(dim).filter(F.col("instrument_id") == instrument_id))


def daily_pnl(agg: DataFrame, report_date, region: str | None = None) -> DataFrame:
    """The daily aggregate of one date, optionally of one region."""
    out = agg.filter(F.col("report_date") == F.lit(str(report_date)).cast("date"))
    return out if region is None else out.filter(F.col("region") == region)
