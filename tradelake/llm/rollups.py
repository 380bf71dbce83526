"""Token totals by source, language and tokenizer version, kept by signed deltas.

Nothing is counted twice: inserted, deleted and recounted documents become signed changes, a
batch of changes is summed to one row per key, and totals are the sum over all committed
batches.  A batch is committed by one entry of the log, so a batch that is sent again, or
whose first attempt broke off, counts once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm.ship import ship
from tradelake.session import scratch_path

KEY = ["source", "lang", "version"]
LOG_SCHEMA = "folder string, batch string"
CURRENT_SCHEMA = "generation long, folder string"
_ENCODINGS: dict[bytes, object] = {}


def count_tokens(docs: DataFrame, tokenizers: dict[str, tuple[str, str]]) -> DataFrame:
    """(doc_id, source, lang, version, n_tokens) of each row and tokenizer.

    ``tokenizers`` maps a version to the path of its rank file and its pattern; special tokens are ordinary text.
    A null or empty text has no tokens.
    """
    spark = docs.sparkSession
    ship(spark)
    files = {}
    for version, (path, pattern) in tokenizers.items():
        with open(path, "rb") as file:
            files[version] = file.read(), pattern
    known = spark.sparkContext.broadcast(files)  # vocabularies: a megabyte each, whatever the input

    def encoding(version: str):
        import tiktoken

        lines, pattern = known.value[version]
        if lines not in _ENCODINGS:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
            _ENCODINGS[lines] = tiktoken.Encoding(version, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return _ENCODINGS[lines]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            texts = [t or "" for t in batch.column(3).to_pylist()]
            for version in known.value:
                counts = np.fromiter((len(x) for x in encoding(version).encode_ordinary_batch(texts, num_threads=1)), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array([version] * len(texts), pa.string()), pa.array(counts)],
                    ["doc_id", "source", "lang", "version", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")))
    return rows.mapInArrow(run, "doc_id long, source string, lang string, version string, n_tokens long")


def inserted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(1))


def deleted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("sign", F.lit(-1))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """A document whose text, key or count changed leaves with its old count and comes with its new one."""
    return deleted(before).unionByName(inserted(after))


class Rollup:
    """Totals below a folder that all executors share.

    ``deltas`` holds a folder for each attempt, ``log`` one entry per committed batch, which names the
    attempt that counts.  One writer at a time may send a given batch.  Compacted totals are a generation of their own
    in a folder below the path, with ``deltas`` and ``log``; ``current`` names the generations, and the last one counts.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "rollup")

    def _generation(self) -> tuple[int, str]:
        """Number and folder of the generation that counts: the path itself until totals are compacted."""
        try:
            last = self.spark.read.schema(CURRENT_SCHEMA).parquet(f"{self.path}/current").agg(
                F.max(F.struct("generation", "folder")).alias("last")).first().last
        except AnalysisException:
            last = None
        return (0, self.path) if last is None else (last.generation, f"{self.path}/{last.folder}")

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self._generation()[1]}/log")
        except AnalysisException:  # nothing was committed yet
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def committed(self, batch: str) -> bool:
        return not self._log().filter(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch of changes (source, lang, version, sign, n_tokens); False if it is there already.

        Keys may be null.  Equal rows are changes of their own.  An empty batch is committed as well.
        """
        if self.committed(batch):
            return False
        folder = scratch_path(self.spark, "x").rsplit("/", 1)[1]
        delta = changes.groupBy(*KEY).agg(F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("tokens"))
        _, at = self._generation()
        delta.coalesce(1).write.parquet(f"{at}/deltas/{folder}")  # one row per key
        self.spark.createDataFrame([(folder, batch)], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{at}/log")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) over all committed batches; keys without documents and tokens are left out."""
        schema = "source string, lang string, version string, docs long, tokens long"
        _, at = self._generation()
        chosen = self._log().groupBy("batch").agg(F.min("folder").alias("folder"))  # had two attempts been logged, one counts
        folders = sorted(r.folder for r in chosen.collect())  # names of batches
        if not folders:
            return self.spark.createDataFrame([], schema)
        deltas = self.spark.read.schema(schema).parquet(*(f"{at}/deltas/{f}" for f in folders))
        sums = deltas.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.filter("docs != 0 or tokens != 0")

    def compact(self) -> None:
        """Folds all batches so far into one delta, for every reader of the path.  Their ids stay in the log, so they
        still count once if sent again.  Until its entry in ``current`` is written, the new generation counts for nobody."""
        totals, number = self.totals(), self._generation()[0] + 1
        batches = [r.batch for r in self._log().select("batch").distinct().collect()]
        folder = f"generation-{number}-{scratch_path(self.spark, 'x')[-8:]}"
        other = f"{self.path}/{folder}"
        totals.coalesce(1).write.parquet(f"{other}/deltas/all")
        entries = [("all" if i == 0 else "none", b) for i, b in enumerate(sorted(batches))]
        totals.limit(0).coalesce(1).write.parquet(f"{other}/deltas/none")
        self.spark.createDataFrame(entries, LOG_SCHEMA).coalesce(1).write.parquet(f"{other}/log")
        self._make_current(number, folder)

    def _make_current(self, number: int, folder: str) -> None:
        self.spark.createDataFrame([(number, folder)], CURRENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/current")
