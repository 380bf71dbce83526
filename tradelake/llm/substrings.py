"""Substring dedup: Rabin-Karp hashes of every window of words, counted over the corpus."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradelake.llm import bytetext as bt
from tradelake.llm import exchange as ex

WINDOW = 13
OUT_SCHEMA = "doc_id long, n_words long, n_removed long, kept string, spans array<struct<start: long, end: long>>"
BLOCK_SCHEMA = "bucket int, chunk long, hashes binary, ranks binary"


def _chunk_windows(table: pa.Table, window: int):
    table, ranks = ex.ranked(table)
    words = bt.Words(table.column("text"))
    at, hashes = words.windows(window)
    classes = ex.Classes(hashes)
    return table, words, at, classes, ranks[words.doc[at]]


def repeated_windows(docs: DataFrame, window: int = WINDOW, carry: Sequence[str] = ()) -> DataFrame:
    """Removes words that an earlier document already holds in a window of ``window`` words.

    Returns per row of ``docs``: doc_id, n_words, n_removed, the kept words joined by one space
    and the maximal removal intervals as word numbers [start, end).  A word goes if it lies in
    a window whose words also stand in a document with a smaller doc_id; repeats within one
    document stay.  Null and empty texts have no words.  Rows without doc_id count as the last
    documents; rows that share a doc_id do not remove each other's words.  Other columns are
    not looked at; those named in ``carry`` come out as they went in, after the rest.  Two hashes of 64 bits stand for two windows: equal hashes are taken as
    equal words.
    """
    spark = docs.sparkSession
    n = ex.bucket_count(spark)
    shipped = {f"carry_{i}": c for i, c in enumerate(carry)}
    source = {k: "text" if c == "text" and docs.schema[c].dataType.simpleString() == "string" else k for k, c in shipped.items()}
    full = ex.chunked(docs, {k: c for k, c in shipped.items() if source[k] == k})  # the text is on its way already
    rows = full.select("chunk", "doc_id", "text")
    out_schema = ", ".join([OUT_SCHEMA, *(f"{k} {docs.schema[c].dataType.simpleString()}" for k, c in shipped.items())])

    def report(table: pa.Table) -> pa.Table:
        """One block per bucket: the chunk's distinct windows, each with its first document."""
        chunk = table.column("chunk")[0].as_py()
        *_, classes, ranks = _chunk_windows(table, window)
        least = classes.least(ranks)
        at = ex.cuts(classes.values, n)
        out = [(b, chunk, bt.pack_sorted(classes.values[i:j]), bt.pack(least[i:j].view(np.uint64)))
               for b, (i, j) in enumerate(zip(at[:-1], at[1:])) if j > i]
        names, types = ("bucket", "chunk", "hashes", "ranks"), (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table({k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate(zip(names, types))})

    def compare(table: pa.Table) -> pa.Table:
        """Marks the hashes whose first document in the corpus comes before the chunk's own."""
        hashes = [bt.unpack_sorted(x) for x in table.column("hashes").to_pylist()]
        ranks = np.concatenate([bt.unpack(x) for x in table.column("ranks").to_pylist()]).view(np.int64)
        ends = np.cumsum([len(x) for x in hashes])
        classes = ex.Classes(np.concatenate(hashes))
        later = classes.spread(classes.least(ranks)) < ranks
        bits = [(c, np.packbits(x).tobytes()) for c, x in
                zip(table.column("chunk").to_pylist(), np.split(later, ends[:-1])) if x.any()]
        return pa.table({
            "kind": pa.array([0] * len(bits), pa.int32()),
            "chunk": pa.array([c for c, _ in bits], pa.int64()),
            "bucket": pa.array([table.column("bucket")[0].as_py()] * len(bits), pa.int32()),
            "bits": pa.array([b for _, b in bits], pa.binary())})

    def remove(table: pa.Table, marks: pa.Table) -> pa.Table:
        table, words, at, classes, ranks = _chunk_windows(table, window)
        earlier = ex.gathered(ex.answers(marks, 0), ex.cuts(classes.values, n))
        gone = classes.spread(earlier) | (ranks > classes.spread(classes.least(ranks)))
        cover = bt.covered(at[gone], window, len(words))
        starts, ends, first = bt.runs(cover, words.first)
        text, offsets = words.join(~cover)
        counts = np.concatenate(([0], np.cumsum(cover)))[words.first]
        return pa.table({
            "doc_id": table.column("doc_id"),
            "n_words": pa.array(np.diff(words.first), pa.int64()),
            "n_removed": pa.array(np.diff(counts), pa.int64()),
            "kept": bt.string_array(text, offsets),
            "spans": bt.span_lists(starts, ends, first, words.first),
            **{k: table.column(c) for k, c in source.items()}})

    blocks = rows.groupBy("chunk").applyInArrow(report, BLOCK_SCHEMA)
    marks = blocks.groupBy("bucket").applyInArrow(compare, ex.BITS_SCHEMA)
    out = full.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(remove, out_schema)
    return out.withColumnsRenamed(shipped)
