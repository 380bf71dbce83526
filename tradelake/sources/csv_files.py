"""CSV files of any header, all at a time: records over several lines are found without reading a file as a whole."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.operators.lookup import lookup
from tradelake.session import stage
from tradelake.sources import chunks as ch

QUOTE, COMMA = b'"', b","
SUMMARY = "struct<plain: boolean, quoted: boolean, begins: boolean>"
RECORDS = f"{ch.PLACE}, head boolean, cells array<string>, owner {ch.OWNER}, data binary"
CELLS = pa.list_(pa.field("element", pa.string()))
OUT = pa.schema({"path": pa.string(), "block": pa.int64(), "seq": pa.int32(), "head": pa.bool_(), "cells": CELLS,
                 "owner": pa.struct({"block": pa.int64(), "seq": pa.int32()}), "data": pa.binary()})  # RECORDS for Arrow


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether the break after a line lies within quotes, given whether the one before it does.

    Quotes count at the beginning of a field alone; in a quoted field two quotes are one
    character.
    """
    for piece in line.split(b"\r"):
        quoted = _quoted_after(piece, quoted)
    return quoted


def _quoted_after(line: bytes, quoted: bool) -> bool:
    at = 0
    while True:
        if not quoted and line[at:at + 1] == QUOTE:
            quoted, at = True, at + 1
        if quoted:
            end = line.find(QUOTE, at)
            while end >= 0 and line[end + 1:end + 2] == QUOTE:
                end = line.find(QUOTE, end + 2)
            if end < 0:
                return True
            quoted, at = False, end + 1
        at = line.find(COMMA, at) + 1
        if not at:
            return False


def quoted_at_end(data: bytes, quoted: bool) -> tuple[bool, int, int]:
    """For lines that all end in a break: whether the last break is quoted, where the first record that begins
    here begins (or the end), and where the last record begins that is still open (or the end).

    Only lines that hold a quote are looked at.
    """
    first = None if quoted else 0
    start, end = 0, 0
    while (mark := data.find(QUOTE, end)) >= 0:
        at = data.rfind(b"\n", end, mark) + 1 or end
        end = data.index(b"\n", mark) + 1
        if not quoted:
            start = at
        quoted = quoted_after(data[at:end - 1], quoted)
        if first is None and not quoted:
            first = end
    return quoted, len(data) if first is None else first, start if quoted else len(data)


def summary(data: bytes) -> dict:
    quoted, first, _ = quoted_at_end(data, True)
    return {"plain": quoted_at_end(data, False)[0], "quoted": quoted, "begins": first < len(data)}


def follow(summaries: list[dict]) -> list[dict]:
    """Per chunk: whether it starts within quotes, and the chunk in which the open record began."""
    out, quoted, owner = [], False, None
    for i, s in enumerate(summaries):
        out.append({"quoted": quoted, "owner": owner if quoted else None})
        after = s["quoted" if quoted else "plain"]
        # in a chunk that comes out of quotes and ends in them, the open record is a new one
        if after and (not quoted or s["begins"]):
            owner = i
        quoted = after
    return out


def cells_of(data: bytes) -> list[list[str]]:
    """The records of whole lines, without blank ones."""
    csv.field_size_limit(2**31 - 1)
    return [r for r in csv.reader(io.StringIO(data.decode("utf-8", "replace"), newline="")) if r]


def _records_with_quotes(data: bytes) -> Iterator[tuple[int, int]]:
    """(begin, end) of the stretches of whole records that hold a quote; records between them are lines without."""
    end = 0
    while (mark := data.find(QUOTE, end)) >= 0:
        at = data.rfind(b"\n", end, mark) + 1 or end
        end = data.index(b"\n", mark) + 1
        quoted = quoted_after(data[at:end - 1], False)
        while quoted:
            line, end = end, data.index(b"\n", end) + 1
            quoted = quoted_after(data[line:end - 1], True)
        yield at, end


def cell_lists(data: bytes) -> pa.Array:
    """``cells_of`` as an Arrow column, in any order but for the first record: lines without quotes are split side by side."""
    odd, plain, at = [], [], 0
    for begin, end in _records_with_quotes(data):
        plain.append(data[at:begin])
        odd.append(data[begin:end])
        at = end
    plain.append(data[at:])
    text = b"".join(plain)
    if b"\r" in text.replace(b"\r\n", b"\n"):  # breaks that no splitting at lines finds
        return pa.array(cells_of(data), CELLS)
    lines = pc.split_pattern(pa.array([text.replace(b"\r\n", b"\n").decode("utf-8", "replace")]), "\n").values
    lists = pc.split_pattern(lines.filter(pc.not_equal(pc.binary_length(lines), 0)), ",")
    quoted = pa.array(cells_of(b"".join(odd)), CELLS)
    lists = lists.cast(CELLS)
    return pa.concat_arrays([lists, quoted] if plain[0].strip(b"\r\n") or not odd else [quoted, lists])


def parse_batches(chunk: dict) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in a chunk, and what it has of others; the first record of a file is its header."""
    data, quoted = chunk["data"], bool(chunk["quoted"])
    place = {k: chunk[k] for k in ch.PLACE_COLUMNS}
    top = chunk["block"] == 0 and chunk["seq"] == 0
    _, first, last = quoted_at_end(data, quoted)
    records = cell_lists(data[first:last]) if first < last else pa.array([], CELLS)
    if n := len(records):
        at = [pa.repeat(pa.scalar(place[c], OUT.field(c).type), n) for c in ch.PLACE_COLUMNS]
        head = pa.array(np.arange(n) == 0) if top else pa.nulls(n, pa.bool_())
        yield pa.RecordBatch.from_arrays([*at, head, records, *(pa.nulls(n, OUT.field(c).type) for c in ("owner", "data"))], schema=OUT)
    rest = []
    if quoted:
        rest.append({**place, "owner": chunk["owner"], "data": data[:first]})
    if last < len(data) and last >= first:
        owner = {"block": chunk["block"], "seq": chunk["seq"]}
        rest.append({**place, "owner": owner, "data": data[last:], "head": top and not n})
    if rest:
        yield pa.RecordBatch.from_pylist(rest, OUT)


def parse(chunk: dict) -> list[dict]:
    return [row for batch in parse_batches(chunk) for row in batch.to_pylist()]


def parse_whole(record: dict) -> list[dict]:
    return [{"path": record["path"], "head": record["head"], "cells": r} for r in cells_of(record["data"])]


def next_line(text: bytes, at: int) -> int:
    """The place of the first line that begins at or after another; the end if there is none."""
    return text.find(b"\n", at - 1) + 1 or len(text) if at else 0


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, head, cells): every record of the files, the header of each marked by ``head``."""
    kept = ch.cut(spark, paths, "\n", False, next_line, summary, SUMMARY, "csv-chunks")
    starts = stage(ch.followed(kept, follow, f"quoted boolean, owner {ch.OWNER}").filter("quoted"), "csv-starts")
    found = stage(ch.read_batches(kept, starts, parse_batches, RECORDS, "quoted", "owner"), "csv-records", ch.DENSE)
    head = F.coalesce("head", F.lit(False)).alias("head")
    whole = found.filter("cells is not null").select("path", head, "cells")
    across = ch.assembled(found.filter("cells is null"), head=F.bool_or("head"))
    return whole.unionByName(ch.parsed(across, parse_whole, "path string, head boolean, cells array<string>").select("path", head, "cells"))


def read_csv(spark: SparkSession, paths) -> DataFrame:
    """(path, names, values): every data row of files whose headers may differ.

    Blank lines are no rows.  Large files are read in chunks, whatever their quoted fields hold.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    rows = records(spark, paths)
    head = rows.filter("head").select("path", F.transform("cells", lambda n: F.ltrim(n, F.lit("﻿"))).alias("names"))
    return lookup(rows.filter("not head").select("path", F.col("cells").alias("values")), stage(head, "headers"), "path")
