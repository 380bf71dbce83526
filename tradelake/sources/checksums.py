"""SHA-256 of files: small ones are hashed whole, of large ones the pieces, in the order of the file."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.ship import ship
from tradelake.sources import chunks as ch

WHOLE = 64 << 20  # bytes of the largest file that a task holds at once
UNPACKED = r"\.(bz2|deflate|gz|lz4|snappy|zst|zstd)$"  # a text scan gives other bytes than these files have
BREAK, BOM = b"\n", b"\xef\xbb\xbf"
PIECES = "path string, block long, seq int, length long, size long, data binary"


def with_sha256(files: DataFrame, whole: int = WHOLE) -> DataFrame:
    """The rows of a ``binaryFile`` scan with ``sha256`` in place of the content.

    A file of more than ``whole`` bytes is read in lines, split by split, and what is read goes to one task that takes it in
    order and holds a piece at a time.  Only a packed file (see ``UNPACKED``) or a line is held whole, however long it is.
    """
    large = F.col("length") > whole
    named = files.filter(large).select("path", F.col("path").rlike(UNPACKED).alias("packed")).collect()

    def hashed(rows):
        return rows.withColumn("sha256", F.sha2("content", 256)).drop("content")

    if not named:
        return hashed(files)
    spark, parts = files.sparkSession, []
    if packed := [r["path"] for r in named if r["packed"]]:
        parts.append(hashed(spark.read.format("binaryFile").load(packed)).select("path", "sha256"))
    if plain := [r["path"] for r in named if not r["packed"]]:
        parts.append(by_pieces(spark, plain))
    found = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    found = found.select(ch.plain_path(F.col("path")).alias("_path"), "sha256")
    rows = files.filter(large).drop("content")
    late = rows.join(found, ch.plain_path(rows["path"]) == found["_path"], "left").drop("_path")
    return hashed(files.filter(~large)).unionByName(late)


def by_pieces(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256) of files that a text scan gives as they are."""
    ship(spark)
    lines = spark.read.option("lineSep", BREAK.decode()).text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_size").alias("length"))
    pieces = lines.mapInArrow(packed_pieces, PIECES).repartition("path").sortWithinPartitions("path", "block", "seq")
    return pieces.mapInArrow(hashed_pieces, "path string, sha256 string").withColumn("path", ch.scanned_path(F.col("path")))


def packed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each batch as one piece of their split, packed."""
    key, seq = None, 0
    for batch in batches:
        at = 0
        for path, block, values in ch.runs(batch):
            seq, key = seq + 1 if (path, block) == key else 0, (path, block)
            text = pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), BREAK)[0].as_py() + BREAK
            yield pa.RecordBatch.from_pydict({
                "path": [path], "block": [block], "seq": pa.array([seq], pa.int32()), "length": [batch.column(3)[at].as_py()],
                "size": [len(text)], "data": [pa.compress(text, "zstd", asbytes=True)]})
            at += len(values)


class _File:
    """The hash of a file from its lines, all with a break after them: the last may have had none, and a scan leaves out
    the mark of UTF-8 before the first.  The length of the file tells."""

    def __init__(self, path: str, length: int):
        self.path, self.length, self.size, self.ended = path, length, 0, False
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(BOM)

    def add(self, text: bytes) -> None:
        for found in (self.plain, self.marked):
            if self.ended:
                found.update(BREAK)
            found.update(memoryview(text)[:-1])
        self.size, self.ended = self.size + len(text), True

    def row(self) -> pa.RecordBatch:
        over = self.size - self.length
        if over not in (0, 1, -len(BOM), 1 - len(BOM)):
            raise ValueError(f"{self.path}: {self.size} bytes read of {self.length}")
        found = self.plain if over >= 0 else self.marked
        if over in (0, -len(BOM)):
            found.update(BREAK)
        return pa.RecordBatch.from_pydict({"path": [self.path], "sha256": [found.hexdigest()]})


def hashed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each file whose pieces come in order."""
    file = None
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if file is None or file.path != row["path"]:
                if file:
                    yield file.row()
                file = _File(row["path"], row["length"])
            file.add(pa.decompress(row["data"], row["size"], "zstd", asbytes=True))
    if file:
        yield file.row()
