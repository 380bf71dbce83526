"""Files cut into chunks that are read by themselves once their start state is known.

Whether a line break ends a CSV record, or a tag in an XML file is one, depends on all that
comes before it in the file.  So a file is cut into chunks of about a megabyte, each with
a summary of what it does to every state that it may start in.  The summaries are a
millionth of the text; following them from chunk to chunk, file by file, gives the state each
chunk really starts in, and then all chunks of all files are read side by side.  What lies
across a border is put together from the parts its chunks hand out.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.session import stage
from tradelake.ship import ship

TARGET, LIMIT = 1 << 20, 1 << 22
GROUP_ROWS = 16  # chunks that a reader unpacks at once; packed they are so small that a row group by bytes has thousands
PLACE = "path string, block long, seq int"
PLACE_COLUMNS = ["path", "block", "seq"]
OWNER = "struct<block: long, seq: int>"
DENSE = "zstd"  # for copies of the text


def plain_path(path: Column) -> Column:
    """A file path without ``file:`` scheme, to compare paths of different origin."""
    return F.regexp_replace(path, "^file:/+", "/")


def scanned_path(path: Column) -> Column:
    """The path that a scan reports percent-encoded, as it was given."""
    return plain_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """(path, block, values) of the stretches of a batch that come from one split of a file."""
    if not batch.num_rows:
        return
    paths, blocks = (pc.run_end_encode(batch.column(i)) for i in (0, 1))
    ends = sorted({*paths.run_ends.to_pylist(), *blocks.run_ends.to_pylist()})
    at = 0
    for end in ends:
        yield batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), batch.column(2).slice(at, end - at)
        at = end


def cut(spark: SparkSession, paths: list[str], separator: str, leading: bool,
        next_start: Callable[[bytes, int], int], summary: Callable[[bytes], dict], schema: str, name: str) -> DataFrame:
    """(path, block, seq, data, summary) of all files, written once and read back.

    The text is read in splits at ``separator``, which opens a piece (``leading``) or ends it.  A chunk is
    closed before the next piece that ``next_start`` finds (its place at or after another, or -1) after ``TARGET``
    bytes, and before any piece after ``LIMIT``.  ``seq`` counts the chunks of a split, and ``block`` orders the
    splits of a file.  Pieces may be as short as a tag, so they are joined and looked at by the batch.
    """
    ship(spark)
    mark = separator.encode()

    def piece_from(text: bytes, at: int) -> int:
        if leading:
            return text.find(mark, at)
        return text.find(mark, max(0, at - len(mark))) + len(mark) if at else 0

    def next_cut(text: bytes, at: int, size: int) -> int:
        """Where the chunk that has ``size`` bytes before ``at`` is to be closed, or the end."""
        places = [find(text, at + max(0, most - size)) for find, most in ((next_start, TARGET), (piece_from, LIMIT))
                  if at + most - size < len(text)]
        return min((p for p in places if 0 <= p < len(text)), default=len(text))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seq, held, size = None, 0, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            data = b"".join(held)
            yield pa.RecordBatch.from_pylist([{"path": key[0], "block": key[1], "seq": seq, "data": data, "summary": summary(data)}], out)

        for batch in batches:
            for path, block, values in runs(batch):
                fresh = (path, block) != key
                if fresh:
                    if held:
                        yield from close()
                    key, seq, held, size = (path, block), 0, [], 0
                text = pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), mark)[0].as_py()
                text = text + mark if not leading else text if fresh and block == 0 else mark + text
                at = 0
                while at < len(text):
                    end = next_cut(text, at, size)
                    if end > at:
                        held.append(text[at:end])
                        size += end - at
                    if end < len(text):
                        yield from close()
                        seq, held, size = seq + 1, [], 0
                    at = end
        if held:
            yield from close()

    pieces = spark.read.option("lineSep", separator).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"))
    whole = f"{PLACE}, data binary, summary {schema}"
    out = _arrow_schema(whole)
    return stage(pieces.mapInArrow(chunks, whole).withColumn("path", scanned_path(F.col("path"))), name, DENSE, GROUP_ROWS)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def followed(chunks: DataFrame, follow: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """What ``follow`` says of each chunk, given the summaries of one file in order; the text stays where it is."""
    whole = f"{PLACE}, {schema}"
    out = _arrow_schema(whole)

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["block"], r["seq"]))
        said = follow([r["summary"] for r in rows])
        at = [(r["block"], r["seq"]) for r in rows]
        return pa.Table.from_pylist([{"path": r["path"], "block": r["block"], "seq": r["seq"], **s, **(
            {} if s.get("owner") is None else {"owner": {"block": at[s["owner"]][0], "seq": at[s["owner"]][1]}})}
            for r, s in zip(rows, said)], out)

    return chunks.select(*PLACE_COLUMNS, "summary").groupBy("path").applyInArrow(run, whole)


def read(chunks: DataFrame, starts: DataFrame, parse: Callable[[dict], list[dict]], schema: str, *columns: str) -> DataFrame:
    """The rows that ``parse`` finds in each chunk; ``starts`` has the chunks whose start is not the usual one,
    and ``parse`` gets null for the others."""
    return parsed(_started(chunks, starts, columns), parse, schema)


def read_batches(chunks: DataFrame, starts: DataFrame, parse: Callable[[dict], Iterator[pa.RecordBatch]], schema: str, *columns: str) -> DataFrame:
    """As ``read`` for a ``parse`` that gives record batches."""
    return _parsed_batches(_started(chunks, starts, columns), parse, schema)


def _started(chunks: DataFrame, starts: DataFrame, columns) -> DataFrame:
    at = starts.select(*PLACE_COLUMNS, *columns, F.lit(True).alias("unusual"))
    return chunks.drop("summary").join(at, PLACE_COLUMNS, "left")


def parsed(frame: DataFrame, parse: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """The rows that ``parse`` makes of each row."""
    out = _arrow_schema(schema)

    def batches(row: dict) -> Iterator[pa.RecordBatch]:
        if rows := parse(row):
            yield pa.RecordBatch.from_pylist(rows, out)

    return _parsed_batches(frame, batches, schema)


def _parsed_batches(frame: DataFrame, parse: Callable[[dict], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # rows and trees have no cycles, and looking for them takes as long as building them
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield from parse(batch.slice(i, 1).to_pylist()[0])
        finally:
            gc.enable()

    return frame.mapInArrow(run, schema)


def assembled(parts: DataFrame, **more: Column) -> DataFrame:
    """(path, owner, data): what lies across chunks, put together from its parts in order."""
    pieces = F.sort_array(F.collect_list(F.struct("block", "seq", F.hex("data").alias("data"))))
    whole = parts.groupBy("path", "owner").agg(pieces.alias("parts"), *(c.alias(name) for name, c in more.items()))
    data = F.unhex(F.array_join(F.transform("parts", lambda p: p["data"]), ""))
    return whole.select("path", "owner", data.alias("data"), *more)
