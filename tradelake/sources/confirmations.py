"""Counterparty confirmation files, all arrived files at a time.

Files come with envelopes (``schemas.ENVELOPE``).  The number of files is small next
to the number of rows; only file paths ever reach the driver, as in any Spark scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.arrays import non_null
from tradelake.functions.envelope import to_keyed
from tradelake.operators.dedup import latest
from tradelake.operators.lookup import lookup
from tradelake.operators.ordered import full_match
from tradelake.schemas import CONFIRMATION, CONFIRMATION_CSV, MONEY
from tradelake.sources.checksums import with_sha256
from tradelake.sources.chunks import plain_path
from tradelake.sources.csv_files import read_csv
from tradelake.sources.fpml import read_fpml

NUMBERS = ("notional", "price")


def _rejected(df: DataFrame, reason) -> DataFrame:
    reason = reason if isinstance(reason, Column) else F.lit(reason)
    return df.select("file_id", reason.alias("reason"))


# --- Ledger and integrity --------------------------------------------------------

def new_files(envelopes: DataFrame, ledger: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(new, duplicates): files without a completed ledger row; the first arrival counts.

    ``duplicates`` has (file_id, copies): arrivals that are not processed.
    """
    order = F.struct("received_at", "path")
    row = F.struct(*envelopes.columns)
    arrived = envelopes.groupBy("file_id").agg(
        F.min_by(row, order).alias("first"), F.count(F.lit(1)).alias("arrivals"))
    if ledger is None:
        known = arrived.withColumn("known", F.lit(False))
    else:
        done = (ledger.filter(F.col("state") == "COMPLETED").select("file_id").distinct()
                .withColumn("known", F.lit(True)))
        known = arrived.join(done, "file_id", "left").withColumn(
            "known", F.coalesce("known", F.lit(False)))
    copies = F.col("arrivals") - F.when(F.col("known"), 0).otherwise(1)
    return (
        known.filter(~F.col("known")).select("first.*"),
        known.select("file_id", copies.alias("copies")).filter(F.col("copies") > 0),
    )


def _paths(envelopes: DataFrame) -> list[str]:
    return [r["path"] for r in envelopes.select("path").distinct().collect()]


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that exist; only a list with a missing one is looked at in parts."""
    if not paths:
        return []
    try:
        spark.read.format("binaryFile").load(paths)
        return paths
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
    if len(paths) == 1:
        return []
    half = len(paths) // 2
    return _existing(spark, paths[:half]) + _existing(spark, paths[half:])


def read_files(spark: SparkSession, envelopes: DataFrame) -> DataFrame:
    """(path, sha256) of every file that exists; of large ones a task holds a piece at a time."""
    paths = _existing(spark, _paths(envelopes))
    if not paths:
        return spark.createDataFrame([], "path string, sha256 string")
    return with_sha256(spark.read.format("binaryFile").load(paths)).select("path", "sha256")


def verify_checksums(files: DataFrame, envelopes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound envelopes, rejected files): the content hash must equal the envelope's."""
    found = files.select(plain_path(F.col("path")).alias("_path"), F.col("sha256"))
    both = envelopes.join(found, plain_path(F.col("path")) == F.col("_path"), "left")
    same = F.coalesce(F.col("sha256") == F.lower("file_checksum"), F.lit(False))
    reason = F.when(F.col("sha256").isNull(), "FILE_NOT_FOUND").otherwise("CHECKSUM_MISMATCH")
    return both.filter(same).select(*envelopes.columns), _rejected(both.filter(~same), reason)


# --- CSV --------------------------------------------------------------------------

def _cell(source_name: Column) -> tuple[Column, Column]:
    """(present?, text) of a named cell."""
    at = F.array_position("names", source_name)
    return at > 0, F.get("values", (at - 1).cast("int"))


def apply_mapping(rows: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Confirmation columns from generic CSV rows.

    ``mapping`` (sender_duns, column, source_name) overrides the standard header names
    per sender, so files of all layouts are mapped in one pass.  A column the file
    lacks is '' or 0; an unreadable number marks the row in ``error``.
    """
    if mapping is not None:
        per_sender = mapping.groupBy("sender_duns").agg(F.map_from_entries(F.collect_set(
            F.struct("column", "source_name"))).alias("_map"))
        rows = lookup(rows, per_sender, "sender_duns")
    texts, bad = {}, []
    for standard, column in CONFIRMATION_CSV.items():
        source_name = F.lit(standard)
        if mapping is not None:
            source_name = F.coalesce(F.try_element_at("_map", F.lit(column)), source_name)
        present, text = _cell(source_name)
        if column in NUMBERS:
            number = F.when(present, text.try_cast(MONEY)).otherwise(F.lit(0).cast(MONEY))
            bad.append(F.when(number.isNull(), F.lit(column)))
            texts[column] = number
        else:
            texts[column] = F.coalesce(text, F.lit(""))
    broken = non_null(bad)
    return rows.select(
        *[texts[f.name].alias(f.name) for f in CONFIRMATION.fields if f.name in texts],
        "source_file_id",
        F.when(F.size(broken) > 0,
               F.concat(F.lit("Bad number: "), F.array_join(broken, ", "))).alias("error"),
    )


# --- Dispatch -----------------------------------------------------------------------

def read_all(spark: SparkSession, envelopes: DataFrame,
             mapping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): every file by its declared format.

    Rows carry ``error`` where a number is unreadable.  Rejects are whole files: an
    unknown or unimplemented format, or broken markup.
    """
    ids = envelopes.select(plain_path(F.col("path")).alias("path"),
                           F.col("file_id").alias("source_file_id"), "sender_duns")
    columns = [*CONFIRMATION.fieldNames(), "error"]
    parts, rejects = [], []
    csv_paths = _paths(envelopes.filter(F.col("file_format") == "CSV"))
    if csv_paths:
        parts.append(apply_mapping(lookup(read_csv(spark, csv_paths), ids, "path", how="inner"),
                                   mapping).select(*columns))
    fpml_paths = _paths(envelopes.filter(F.col("file_format") == "FPML"))
    if fpml_paths:
        rows, malformed = read_fpml(spark, fpml_paths)
        parts.append(lookup(rows, ids, "path", how="inner").select(*columns))
        rejects.append(_rejected(
            malformed.join(ids, "path").withColumnRenamed("source_file_id", "file_id"),
            "MALFORMED_XML"))
    fmt = F.col("file_format")
    rejects.append(_rejected(
        envelopes.filter(F.coalesce(~fmt.isin("CSV", "FPML"), F.lit(True))),
        F.when(fmt == "MT518", F.lit("Format not implemented: MT518"))
        .otherwise(F.concat(F.lit("Unsupported file format: "), F.coalesce(fmt, F.lit("none"))))))
    if not parts:
        empty = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONFIRMATION.fields)
        parts = [spark.createDataFrame([], empty + ", error string")]
    return (reduce(DataFrame.unionByName, parts), reduce(DataFrame.unionByName, rejects))


# --- Outcomes ------------------------------------------------------------------------

def file_outcomes(files: DataFrame, rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """(file_id, status, processed, failed, reason) per file: COMPLETE, PARTIAL or REJECTED."""
    counts = rows.groupBy(F.col("source_file_id").alias("file_id")).agg(
        F.count_if(F.col("error").isNull()).alias("processed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"))
    why = rejects.groupBy("file_id").agg(F.min("reason").alias("reason"))
    out = files.select("file_id").join(counts, "file_id", "left").join(why, "file_id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint"))
                           for c in ("processed", "failed")})
    status = (F.when(F.col("reason").isNotNull(), "REJECTED")
              .when(F.col("failed") > 0, "PARTIAL").otherwise("COMPLETE"))
    return out.select("file_id", status.alias("status"), "processed", "failed", "reason")


def _at(at) -> Column:
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def received(files: DataFrame, at=None) -> DataFrame:
    """Ledger rows for files that passed their checksum."""
    nothing = F.lit(None).cast("bigint")
    return files.select("file_id", F.lit("RECEIVED").alias("state"), nothing.alias("processed"),
                        nothing.alias("failed"), _at(at).alias("at"))


def completed(outcomes: DataFrame, at=None) -> DataFrame:
    """Ledger rows for finished files; a rejected file may be sent again."""
    state = F.when(F.col("status") == "REJECTED", "REJECTED").otherwise("COMPLETED")
    return outcomes.select("file_id", state.alias("state"), "processed", "failed",
                           _at(at).alias("at"))


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.select("file_id", "state", "processed", "failed", "at").write.mode("append").parquet(path)


def to_messages(rows: DataFrame, envelopes: DataFrame, source_system: str,
                file_header: str = "sourceFileId") -> DataFrame:
    """Confirmations keyed by trade id with four trace headers."""
    senders = envelopes.select(F.col("file_id").alias("source_file_id"), "sender_duns")
    named = lookup(rows, senders, "source_file_id")
    return to_keyed(named, "trade_id", {
        "sourceSystem": F.lit(source_system),
        "senderDuns": F.col("sender_duns"),
        file_header: F.col("source_file_id"),
        "schemaVersion": F.lit("v1"),
    }, value_cols=CONFIRMATION.fieldNames())


# --- Matching ------------------------------------------------------------------------

def reconcile(confirms: DataFrame, trades: DataFrame, tolerance: str = "0.0000", ties=None) -> DataFrame:
    """Confirmations against our trades: MATCHED, BREAK, MISSING_OURS, MISSING_THEIRS.

    ``confirms`` needs trade_id, our_ref, notional and currency (and price where both
    sides have one).  Our side is first cut to the newest state per trade, so a
    reference meets one row however often it is confirmed; of states of one time and event type ``ties`` choose, by
    default all columns, which are then moved.  A caller with one state per trade and event type gives none.  Both sides are read once, into one
    shuffle, in which a reference that very many confirmations share is spread.  Confirmations without a
    reference meet nothing; trades without id are left out.
    """
    with_price = "price" in confirms.columns and "price" in trades.columns
    compared = ["notional", "currency", *(["price"] if with_price else [])]
    ours = latest(trades, "trade_id", ["updated_at", "event_type"], ties, null_keys="drop").select(
        F.col("trade_id").alias("our_ref"), *[F.col(c).alias(f"our_{c}") for c in compared])
    theirs = confirms.select(F.nullif("our_ref", F.lit("")).alias("our_ref"),
                             F.col("trade_id").alias("their_ref"),
                             *[F.col(c).alias(f"their_{c}") for c in compared])

    def differs(c):
        same = F.col(f"our_{c}").eqNullSafe(F.col(f"their_{c}"))
        if c == "currency":
            return ~same
        near = F.abs(F.col(f"our_{c}") - F.col(f"their_{c}")) <= F.lit(tolerance).cast(MONEY)
        return ~(same | F.coalesce(near, F.lit(False)))

    breaks = non_null([F.when(differs(c), F.lit(c)) for c in compared])
    met = full_match(theirs, "our_ref", ours, "our_ref").select(
        F.col("found").isNotNull().alias("_ours"), F.col("row").isNotNull().alias("_theirs"),
        F.coalesce("row.our_ref", "found.our_ref").alias("our_ref"), "row.their_ref",
        *[F.col(f"{side}.{who}_{c}") for c in compared for side, who in (("found", "our"), ("row", "their"))])
    both = F.col("_ours") & F.col("_theirs")
    met = met.withColumn("breaks", F.when(both, F.array_join(breaks, ",")).otherwise(F.lit("")))
    status = (F.when(~F.col("_ours"), "MISSING_OURS").when(~F.col("_theirs"), "MISSING_THEIRS")
              .when(F.col("breaks") == "", "MATCHED").otherwise("BREAK"))
    return met.select("our_ref", "their_ref", status.alias("status"), "breaks",
                      *[f"{side}_{c}" for c in compared for side in ("our", "their")])
