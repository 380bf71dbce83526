"""Trade fact and daily aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.functions.keys import surrogate_key
from tradelake.operators import enrich, quality
from tradelake.schemas import MONEY

FACT_COLUMNS = [
    "trade_sk", "trade_id", "event_type", "instrument_id", "instrument_name", "asset_class",
    "sector", "notional", "currency", "usd_rate", "notional_usd", "trade_date",
    "settlement_date", "trader_id", "trader_name", "desk", "book_id", "book_name", "region",
    "counterparty_lei", "counterparty_name", "credit_rating", "status", "created_at",
    "updated_at",
]
# columns that come as they are from the trades or a dimension
LOOKED_UP = {
    "instruments": ["instrument_name", "asset_class", "sector"],
    "traders": ["trader_name", "desk"],
    "books": ["book_name", "region"],
    "counterparties": ["counterparty_name", "credit_rating"],
}
TRADE_COLUMNS = [c for c in FACT_COLUMNS if c not in {"trade_sk", "usd_rate", "notional_usd", *sum(LOOKED_UP.values(), [])}]
MARKED_COLUMNS = [*TRADE_COLUMNS, *sum(LOOKED_UP.values(), [])]


def high_water_mark(target: DataFrame, col: str = "updated_at"):
    """The newest ``col`` of a table, or None if it is empty."""
    return target.agg(F.max(col)).first()[0]


def incremental_slice(source: DataFrame, target: DataFrame | None, col: str = "updated_at",
                      lookback: str | None = None) -> DataFrame:
    """Source rows newer than anything in ``target``; all rows if it is empty or absent.

    The mark is read first and enters the plan as a literal, so the source scan is
    pruned by it.  ``lookback`` (such as "2 days") moves the mark back to catch rows
    that arrived late or share the mark's time.  Rows without a time are in every slice,
    since nothing tells whether they were loaded; the upsert that follows takes them once.
    """
    mark = None if target is None else high_water_mark(target, col)
    if mark is None:
        return source
    since = F.lit(mark)
    if lookback:
        since = since - F.expr(f"INTERVAL {lookback}")
    return source.filter((F.col(col) > since) | F.col(col).isNull())


def with_audit(df: DataFrame, run_id: str) -> DataFrame:
    """Load time and run id."""
    return df.withColumns({"dbt_loaded_at": F.current_timestamp(),
                           "dbt_invocation_id": F.lit(run_id)})


def with_load_time(df: DataFrame, column: str = "loaded_at") -> DataFrame:
    """The time of the load, for dimensions and aggregates; a row that has one keeps it."""
    now = F.current_timestamp()
    return df.withColumn(column, F.coalesce(F.col(column), now) if column in df.columns else now)


def _fx(df: DataFrame, fx: DataFrame) -> DataFrame:
    rates = fx.select(F.col("currency"), F.col("rate_date").alias("trade_date"), "usd_rate")
    # rates that an aggregate made are only known by the size of its unmerged parts, one for each of its tasks, and the
    # trades would be moved to them; shuffled once more they are measured as they are, and broadcast while they are few
    return enrich.lookup(df, rates.hint("rebalance"), ["currency", "trade_date"])


def derived_columns() -> dict[str, Column]:
    """What follows from other columns of a fact row."""
    return {
        "notional_usd": (F.col("notional") * F.col("usd_rate")).cast(MONEY),
        "trade_sk": surrogate_key("trade_id", "event_type"),
    }


def build_fct_trades(trades: DataFrame, dims: dict[str, DataFrame], fx: DataFrame,
                     mode: str = "asof", checks=()) -> DataFrame:
    """One row per (trade_id, event_type) with five left lookups and the USD amount.

    ``mode="asof"`` takes the instrument and trader version valid on the trade date,
    ``mode="current"`` the active one.  A missing rate leaves the USD amount NULL.
    ``dims`` has instruments, traders, books and counterparties.

    With ``checks`` there is a column of their ``quality.marks`` on ``MARKED_COLUMNS`` as well, taken where each
    column comes from: a suite of them that reads no more than the marks need not have the columns moved.
    ``trades`` may have the marks of their own columns already.
    """
    if mode not in ("asof", "current"):
        raise ValueError(f"unknown mode: {mode}")

    def versioned(df, dim, key, cols):
        if mode == "asof":
            return enrich.asof_dim(df, dim, key, "trade_date", cols)
        return enrich.current_dim(df, dim, key, cols)

    def looked_up(df, name, join, key, **given):
        cols = LOOKED_UP[name]
        if not checks:
            return join(df, dims[name], key, cols, **given)
        found = join(df, dims[name].withColumn("_found", quality.marks(checks, cols)), key, [*cols, "_found"], **given)
        own = F.coalesce("_found", quality.null_marks(checks, cols))
        return found.withColumn(quality.MARKS, F.col(quality.MARKS).bitwiseOR(own)).drop("_found")

    if checks and quality.MARKS not in trades.columns:
        trades = trades.withColumn(quality.MARKS, quality.marks(checks, TRADE_COLUMNS))
    # the largest tables first: what joins them moves the trades, which grow with each lookup
    out = looked_up(trades, "counterparties", enrich.plain_dim, "counterparty_lei", dim_key="lei_code")
    out = looked_up(out, "instruments", versioned, "instrument_id")
    out = looked_up(out, "traders", versioned, "trader_id")
    out = _fx(out, fx)
    out = looked_up(out, "books", enrich.plain_dim, "book_id")
    return out.withColumns(derived_columns()).select(*FACT_COLUMNS, *([quality.MARKS] if checks else []))


def build_daily_pnl(fct: DataFrame, pnl_expr: Column | None = None,
                    exclude_status=()) -> DataFrame:
    """Daily totals per (report_date, book_id, asset_class); NULL classes form one group.

    Realised PnL has no rule of its own: pass a row expression, else it is NULL.
    """
    rows = fct.filter(~F.coalesce(F.col("status").isin(list(exclude_status)), F.lit(False))) \
        if exclude_status else fct
    pnl = F.sum(pnl_expr).cast(MONEY) if pnl_expr is not None else F.lit(None).cast(MONEY)
    return (
        rows.groupBy(F.col("trade_date").alias("report_date"), "book_id", "asset_class")
        .agg(F.max("book_name").alias("book_name"), F.max("region").alias("region"),
             F.sum("notional_usd").cast(MONEY).alias("total_notional_usd"),
             F.count(F.lit(1)).alias("trade_count"),
             pnl.alias("realized_pnl_usd"))
        .select("report_date", "book_id", "book_name", "region", "asset_class",
                "total_notional_usd", "trade_count", "realized_pnl_usd")
    )
