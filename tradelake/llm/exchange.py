"""Corpus-wide comparison of hashed windows by blocks.

Rows with one number per window would make the shuffle several times larger than the
text.  Here a *chunk* of documents reports each distinct hash once, packed into one block
per hash range ("bucket"); a bucket compares the blocks of all chunks and answers with one
bit per reported hash.  A window that a third of all documents hold reaches its bucket
once per chunk, not once per document.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm.bytetext import U64
from tradelake.llm.ship import ship

CHUNK_DOCS = 256
LAST_RANK = np.int64(2**63 - 1)
BITS_SCHEMA = "kind int, chunk long, bucket int, bits binary"


def chunk_of(doc_id: Column, text: Column) -> Column:
    """The chunk of a document: 256 neighbouring ids.  Rows without an id are spread by text."""
    return F.when(doc_id.isNull(), -1 - F.pmod(F.xxhash64(text), F.lit(4096))).otherwise(
        F.floor(doc_id / F.lit(CHUNK_DOCS)).cast("long"))


def chunked(docs: DataFrame, carry: Mapping[str, str] | None = None) -> DataFrame:
    """(chunk, doc_id, text) of all rows, whatever else the table holds; ``carry`` names columns to bring
    along, by the name they get here."""
    ship(docs.sparkSession)
    ids, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(chunk_of(ids, text).alias("chunk"), ids.alias("doc_id"), text.alias("text"),
                       *(F.col(c).alias(k) for k, c in (carry or {}).items()))


def bucket_count(spark: SparkSession) -> int:
    """One bucket per shuffle partition: the setting that a user scales with the data."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The chunk in the order of doc_id, rows without one last, and the ranks of its rows.  Rows that
    share an id come in the order of their texts, so that each stage sees the same order."""
    ids = pa.compute.fill_null(table.column("doc_id"), int(LAST_RANK)).to_numpy()
    order = np.argsort(ids, kind="stable")
    if (np.diff(ids[order]) == 0).any():
        texts = np.array(table.column("text").to_pylist(), object)
        order = np.array(sorted(order, key=lambda i: (ids[i], texts[i] is not None, texts[i] or "")))
    return table.take(pa.array(order)), ids[order]


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each hash: n equal ranges, so that sorted hashes lie bucket by bucket."""
    return ((hashes >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


class Classes:
    """Positions with equal hashes: their order, and where each distinct hash begins in it."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.argsort(hashes, kind="stable")
        ordered = hashes[self.order]
        new = np.ones(len(ordered), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        self.first = np.flatnonzero(new)
        self.values = ordered[self.first]
        self.sizes = np.diff(np.append(self.first, len(ordered)))

    def least(self, ranks: np.ndarray) -> np.ndarray:
        """The least rank of each class."""
        return np.minimum.reduceat(ranks[self.order], self.first) if len(self.first) else ranks[:0]

    def spread(self, per_class: np.ndarray) -> np.ndarray:
        """A value per class, given to each of its positions."""
        out = np.empty(len(self.order), per_class.dtype)
        out[self.order] = np.repeat(per_class, self.sizes)
        return out


def cuts(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes: n + 1 positions."""
    return np.searchsorted(buckets_of(hashes, n), np.arange(n + 1))


def answers(table: pa.Table, kind: int) -> dict[int, np.ndarray]:
    """The bits that came back for one chunk, by bucket."""
    mine = table.filter(pa.compute.equal(table.column("kind"), kind))
    return {b: np.unpackbits(np.frombuffer(x, np.uint8))
            for b, x in zip(mine.column("bucket").to_pylist(), mine.column("bits").to_pylist())}


def gathered(bits: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """One flag per sorted hash; a bucket that did not answer means False throughout."""
    out = np.zeros(at[-1], bool)
    for b, own in bits.items():
        out[at[b]:at[b + 1]] = own[:at[b + 1] - at[b]]
    return out
