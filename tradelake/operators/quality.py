"""Row validation, declarative checks, freshness and counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.arrays import non_null
from tradelake.schemas import (
    ASSET_CLASSES,
    CURRENCY_PATTERN,
    FACT_DATE_FLOOR,
    LIFECYCLE,
    QUARANTINE_REASON,
)


# --- Batch validation -----------------------------------------------------------

def trade_rules() -> dict[str, Column]:
    """What a raw trade must satisfy to be curated."""
    return {
        "trade_id_present": F.col("trade_id").isNotNull(),
        "instrument_id_present": F.col("instrument_id").isNotNull(),
        "notional_present": F.col("notional").isNotNull(),
        "notional_positive": F.col("notional") > 0,
        "currency_iso": F.col("currency").rlike(CURRENCY_PATTERN),
        "status_known": F.col("status").isin(*LIFECYCLE),
    }


def failed_rules(rules: dict[str, Column] | None = None) -> Column:
    """Names of the rules a row breaks; an unknown (NULL) answer counts as broken."""
    rules = rules or trade_rules()
    return non_null([F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
                     for name, rule in rules.items()])


def _passes() -> Column:
    return F.coalesce(reduce(lambda a, b: a & b, trade_rules().values()), F.lit(False))


VERDICT = "_passes"


def judged(df: DataFrame) -> DataFrame:
    """``df`` with the verdict that ``validate`` splits by: taken before rows are moved, columns that nobody else reads stay behind."""
    return df.withColumn(VERDICT, _passes())


def validate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid); invalid rows carry a reason and the broken rules. Nothing is lost."""
    ok = F.col(VERDICT) if VERDICT in df.columns else _passes()
    return df.filter(ok).drop(VERDICT), _with_reasons(df.filter(~ok).drop(VERDICT))


def _with_reasons(invalid: DataFrame) -> DataFrame:
    return invalid.withColumn("quarantine_reason", F.lit(QUARANTINE_REASON)).withColumn("failed_checks", failed_rules())


# --- Counts ----------------------------------------------------------------------

def _counts(**frames: DataFrame) -> DataFrame:
    """One row with the row count of each frame, without a join."""
    names = list(frames)
    tagged = [df.select(F.lit(name).alias("name")) for name, df in frames.items()]
    return reduce(DataFrame.unionAll, tagged).agg(
        *[F.count_if(F.col("name") == name).alias(name) for name in names])


def run_metrics(df: DataFrame) -> DataFrame:
    """(valid_count, quarantined_count) of rows that are not split yet, in one pass."""
    return df.agg(F.count_if(_passes()).alias("valid_count"),
                  F.count_if(~_passes()).alias("quarantined_count"))


def observed(df: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while it is being written; no second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def backlog_gate(raw: DataFrame, curated: DataFrame, threshold: int = 10_000) -> DataFrame:
    """(landed, curated, backlog, proceed): hold downstream work while too much is unprocessed."""
    return _counts(landed=raw, curated=curated).withColumn(
        "backlog", F.col("landed") - F.col("curated")
    ).withColumn("proceed", F.col("backlog") <= threshold)


# --- Declarative checks ------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """A named test: either a condition that marks failing rows, or a unique key."""

    name: str
    fails: Column | None = None
    unique: tuple[str, ...] = ()
    null_is_value: bool = False
    reads: str | None = None  # the only column that ``fails`` reads, if it is one
    null_fails: bool = False  # the verdict on a NULL there


def _where(fails: Column, where: Column | None) -> Column:
    return fails if where is None else fails & where


def not_null(col: str, where: Column | None = None) -> Check:
    alone = where is None
    return Check(f"not_null_{col}", _where(F.col(col).isNull(), where), reads=col if alone else None, null_fails=alone)


def accepted_values(col: str, values) -> Check:
    return Check(f"accepted_values_{col}", ~F.col(col).isin(*values), reads=col)


def at_least(col: str, bound=0) -> Check:
    return Check(f"at_least_{col}", ~(F.col(col) >= F.lit(bound)), reads=col)


def matches(col: str, pattern: str) -> Check:
    return Check(f"matches_{col}", ~F.col(col).rlike(pattern), reads=col)


def on_or_after(col: str, day: str) -> Check:
    return Check(f"on_or_after_{col}", ~(F.col(col) >= F.to_date(F.lit(day))), reads=col)


def holds(name: str, condition: Column, where: Column | None = None) -> Check:
    """A row predicate; an unknown (NULL) answer passes."""
    return Check(f"holds_{name}", _where(~condition, where))


def max_length(col: str, n: int) -> Check:
    return Check(f"max_length_{col}", F.length(col) > n, reads=col)


def unique(col: str) -> Check:
    """No value twice; NULLs are ignored."""
    return Check(f"unique_{col}", unique=(col,))


def unique_combination(*cols: str) -> Check:
    """No combination twice; NULL is a value like any other."""
    return Check("unique_" + "_".join(cols), unique=tuple(cols), null_is_value=True)


MARKS = "_marks"
MOST_MARKS = 63  # bits of a long without its sign


def _early(checks, columns) -> list[tuple[int, Check]]:
    """The row checks that read one of ``columns`` and nothing else, by their place; those behind the last bit are left to the suite."""
    return [(i, c) for i, c in enumerate(checks[:MOST_MARKS]) if c.reads in columns]


def marks(checks, columns) -> Column:
    """Verdicts of the row checks on ``columns``, as the bits of a number: bit i is set where check i fails."""
    bits = [F.when(c.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in _early(checks, columns)]
    return reduce(Column.bitwiseOR, bits, F.lit(0).cast("long"))


def null_marks(checks, columns) -> Column:
    """``marks`` where all of ``columns`` are NULL, as after a lookup that finds nothing."""
    return F.lit(sum(1 << i for i, c in _early(checks, columns) if c.null_fails)).cast("long")


def _key(df: DataFrame, check: Check) -> Column:
    """The unique key's text as bytes; NULL for a row that stands for no key.

    A key of one text moves without the JSON around it, and hex digits, such as a surrogate key, at half their length.
    """
    if not check.null_is_value and len(check.unique) == 1 and df.schema[check.unique[0]].dataType == T.StringType():
        text = F.col(check.unique[0])
        packed = F.unhex(text)
        # the first byte tells the two forms apart, so different texts stay different keys
        return F.when(F.lower(F.hex(packed)) == text, F.concat(F.lit(b"h"), packed)).otherwise(F.concat(F.lit(b"t"), text.cast("binary")))
    key = F.to_json(F.struct(*check.unique), {"ignoreNullFields": "false"}).cast("binary")
    if check.null_is_value:
        return key
    return F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in check.unique]), key)


def run_suite(df: DataFrame, checks, marked=()) -> DataFrame:
    """(test, failures, status), one row per check, from one evaluation of ``df``.

    Each row stands once for the row checks and once under its key for every uniqueness check; a first
    aggregate counts per key, with partial counts before its shuffle, so the row checks and a key that very
    many rows share are one row per task there; a second one counts the keys that occur twice.  Checks on
    the columns ``marked`` are read from ``df``'s ``marks`` of the same checks, not from the columns.
    """
    early = {i for i, _ in _early(checks, marked)}
    rules = [(c, F.col(MARKS).bitwiseAND(F.lit(1 << i)) != 0 if i in early else c.fails) for i, c in enumerate(checks) if c.fails is not None]
    keyed = [c for c in checks if c.unique]
    counts = [f"c{i}" for i in range(len(rules))]
    stands = [F.struct(F.lit(-1).alias("check"), F.lit(b"").alias("key"))]
    stands += [F.struct(F.lit(i).alias("check"), _key(df, c).alias("key")) for i, c in enumerate(keyed)]
    rows = df.select(*[F.coalesce(fails, F.lit(False)).alias(n) for (_, fails), n in zip(rules, counts)],
                     F.inline(F.filter(F.array(*stands), lambda s: s["key"].isNotNull())))
    own = F.col("check") == -1
    per_key = rows.groupBy("check", "key").agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(own & F.col(n)).alias(n) for n in counts])
    found = per_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
                        *[F.count_if((F.col("check") == i) & (F.col("rows") > 1)).alias(f"u{i}") for i in range(len(keyed))])
    named = [*((c, n) for (c, _), n in zip(rules, counts)), *((c, f"u{i}") for i, c in enumerate(keyed))]
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(c.name).alias("test"), F.col(n).cast("long").alias("failures")) for c, n in named]))).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def checks_from_schema(schema: T.StructType, pk=(), null_is_value: bool = False) -> list[Check]:
    """NOT NULL, length and primary-key checks from a declared layout."""
    pk = [pk] if isinstance(pk, str) else list(pk)
    checks = [not_null(f.name) for f in schema.fields if not f.nullable or f.name in pk]
    checks += [max_length(f.name, f.metadata["length"])
               for f in schema.fields if f.metadata.get("length")]
    if len(pk) == 1:
        checks.append(unique(pk[0]))
    elif pk:
        checks.append(unique_combination(*pk))
    return checks


def fct_trades_checks() -> list[Check]:
    return [
        unique("trade_sk"), not_null("trade_sk"), not_null("trade_id"),
        not_null("event_type"), accepted_values("event_type", LIFECYCLE),
        not_null("notional"), at_least("notional", 0),
        not_null("notional_usd", where=F.col("currency") != "USD"),
        not_null("currency"), matches("currency", CURRENCY_PATTERN),
        not_null("trade_date"), on_or_after("trade_date", FACT_DATE_FLOOR),
        holds("settlement_not_before_trade", F.col("settlement_date") >= F.col("trade_date"),
              where=F.col("settlement_date").isNotNull()),
        not_null("status"), accepted_values("status", LIFECYCLE),
    ]


def dim_instruments_checks() -> list[Check]:
    return [
        unique("instrument_sk"), not_null("instrument_sk"), not_null("instrument_id"),
        not_null("asset_class"), accepted_values("asset_class", ASSET_CLASSES),
        not_null("currency"),
    ]


def daily_pnl_checks() -> list[Check]:
    return [
        unique_combination("report_date", "book_id", "asset_class"),
        not_null("report_date"), not_null("book_id"), at_least("total_notional_usd", 0),
    ]


# --- Freshness --------------------------------------------------------------------

def freshness(df: DataFrame, loaded_at: str, now, warn_hours: int, error_hours: int) -> DataFrame:
    """(max_loaded_at, status): pass, warn or error by the age of the newest row.

    A limit is broken only when the age exceeds it; an empty table is an error.
    """
    at = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")
    newest = F.col("max_loaded_at")
    status = (
        F.when(newest.isNull(), "error")
        .when(newest < at - F.make_interval(hours=F.lit(error_hours)), "error")
        .when(newest < at - F.make_interval(hours=F.lit(warn_hours)), "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("status", status)
