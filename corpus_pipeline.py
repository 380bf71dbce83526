"""The corpus pipeline: stages over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  MinHash and BPE have no SQL, so the whole is tested against a
brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import bpe, minhash, rules, substrings, winnowing
from tradelake.llm.queries import ranks_path, table
from tradelake.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that no rule rejects.

    Each row is judged by its text alone, so equal texts share their verdict and repeated rows stay repeated; a null
    or empty text has too few words and goes.  Rows without doc_id are rows like others.
    """
    return rules.judged(docs).filter("rejected_by is null").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the one with the least doc_id, of rows equal in doc_id and text any one.

    Rows without doc_id come after all others.  Null and empty texts are one group; a text without words is like its
    equals only.
    """
    return minhash.deduplicated(docs).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the passages that an earlier document holds.

    A text that loses nothing stays as it is to the byte; of others the remaining words are joined by
    spaces, and n_chars counts them; a text that loses all its words goes.
    """
    cut = substrings.repeated_windows(docs, carry=["text", "lang", "source", "n_chars"])
    changed = F.col("n_removed") > 0
    return cut.filter(~(changed & (F.col("n_removed") == F.col("n_words")))).select(
        "doc_id", F.when(changed, F.col("kept")).otherwise(F.col("text")).alias("text"), "lang", "source",
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are not contaminated by the benchmark, as they were.

    Each row is judged by its text alone; null and empty texts hold no item and stay, repeated rows stay repeated.
    An empty benchmark, or one whose items have no words, contaminates nothing.
    """
    return winnowing.decontaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each text, and digests of them and of what they decode to."""
    out = bpe.encode_decode(docs, ranks_path(), carry=["lang", "source"])
    return out.select("doc_id", "lang", "source", "n_tokens", "tokens", "ids_sha256",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
