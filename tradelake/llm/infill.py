"""Fill-in-the-middle: documents cut at line ends into prefix, middle and suffix, and rearranged.

A rolling hash over the bytes cuts each text into chunks whose borders depend on their content
alone, so passages that documents share give the same chunks.  A chunk is looked at once: its
summary (line ends, code points, marks inside, bytes at both borders) is kept in a cache under
its hash, and a chunk that has the hash is compared byte for byte before the summary is used.
Summaries add up: the sums of lines before each chunk tell which chunk holds the line end of a
cut, and the chunk's own summary tells where; a mark that lies across a border shows in the
bytes at both sides of it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm.ship import ship

MARKS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM_RATE = "7", 100, 50
WINDOW, MEAN, LEAST, MOST = 32, 256, 64, 4096
CACHED_BYTES = 32 << 20
NEWLINE = 0x0A
OUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """The ends of each text's chunks: where the hash of the last ``WINDOW`` bytes ends in zero bits, but no
    sooner than ``LEAST`` and no later than ``MOST`` bytes after the border before."""
    rolling = bt.mix(bt.Rolling(data).every(WINDOW))
    good = (np.flatnonzero((rolling & bt.U64(MEAN - 1)) == 0) + WINDOW).tolist()
    out = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        ends, at = [], start
        while at < end:
            # a window that reaches into the text before says nothing about this one
            i = bisect_left(good, max(at + LEAST, start + WINDOW))
            at = min(good[i] if i < len(good) else end, at + MOST, end)
            ends.append(at)
        out.append(ends)
    return out


@dataclass(frozen=True, slots=True)
class Summary:
    """What a chunk adds to its text: the byte after each of its line ends and the code points before that
    byte, all its code points, and whether a mark lies inside."""

    content: bytes
    line_ends: np.ndarray
    points_at: np.ndarray
    points: int
    marked: bool


class Cache:
    """Summaries by the hash of their chunk; of bounded size, and emptied when full."""

    def __init__(self, marks: Sequence[bytes]):
        self.marks, self.known, self.size = marks, {}, 0

    def of(self, key: int, content: bytes) -> Summary:
        same = self.known.get(key, ())
        for summary in same:
            if summary.content == content:
                return summary
        data = np.frombuffer(content, np.uint8)
        ends = np.flatnonzero(data == NEWLINE) + 1
        before = np.cumsum((data & 0xC0) != 0x80)
        summary = Summary(content, ends, before[ends - 1], int(before[-1]), any(m in content for m in self.marks))
        if self.size > CACHED_BYTES:
            self.known, self.size, same = {}, 0, ()
        self.known[key] = (*same, summary)
        self.size += len(content) + 16 * len(ends) + 200
        return summary


def across(left: bytes, right: bytes, marks: Sequence[bytes]) -> bool:
    """Whether a mark lies across the border of two chunks, each longer than a mark or the last of its text."""
    for mark in marks:
        reach = len(mark) - 1
        if mark[0] in left[-reach:] and mark in left[-reach:] + right[:reach]:
            return True
    return False


def rearranged(prefix: bytes, middle: bytes, suffix: bytes, form: str, marks: Sequence[bytes]) -> bytes:
    p, s, m = marks
    return b"".join((p, prefix, s, suffix, m, middle) if form == "psm" else (s, suffix, p, prefix, m, middle))


def seeds(doc_id: Column, seed: str) -> Column:
    """Four numbers of 32 bits from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)))


def infilled(docs: DataFrame, seed: str = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
             marks: Sequence[str] = MARKS) -> DataFrame:
    """Cuts each text at two line ends and rearranges the three parts.

    Returns per row of ``docs``: doc_id, the number of lines n, the form, the code points of prefix and middle, and
    the output: ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle), each part after its mark, or
    ``plain``, the text itself: for a text that is empty or null or holds a mark, and for all but ``rate`` of
    100 others.  ``spm_rate`` of 100 take the form ``spm``.  Cuts and forms are drawn from seed and doc_id, so
    rows that share an id are cut alike, and a row without id draws from an empty one.  Each row is worked on by
    itself; other columns are not looked at.
    """
    if not all(0 < len(m.encode()) <= LEAST for m in marks) or len(set(marks)) != 3:
        raise ValueError(f"three different marks of 1 to {LEAST} bytes are needed")
    raw_marks = [m.encode() for m in marks]
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(raw_marks)
        for batch in bt.portions(batches, "text"):
            yield one(batch, cache)

    def one(batch: pa.RecordBatch, cache: Cache) -> pa.RecordBatch:
        data, offsets = bt.text_bytes(batch.column(1))
        draws = np.asarray(batch.column(2).flatten()).reshape(-1, 4)
        per_text = chunk_ends(data, offsets)
        first = np.concatenate(([0], np.cumsum([len(e) for e in per_text])))
        ends = np.array([e for own in per_text for e in own], np.int64)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        hashes = (bt.mix(bt.Rolling(data).of(starts, ends)) ^ (ends - starts).astype(bt.U64)).tolist()
        raw = data.tobytes()
        found = [cache.of(h, raw[i:j]) for h, i, j in zip(hashes, starts.tolist(), ends.tolist())]
        lines = np.concatenate(([0], np.cumsum([len(s.line_ends) for s in found])))
        points = np.concatenate(([0], np.cumsum([s.points for s in found])))

        def cut(row: int, units: int) -> tuple[int, int]:
            """Byte and code point of the text after its first lines."""
            a, b = first[row], first[row + 1]
            if not units:
                return int(offsets[row]), 0
            line = lines[a] + units
            if line > lines[b]:  # the last line has no end
                return int(offsets[row + 1]), int(points[b] - points[a])
            j = int(np.searchsorted(lines, line)) - 1
            inner = int(line - lines[j]) - 1
            return int(starts[j] + found[j].line_ends[inner]), int(points[j] - points[a] + found[j].points_at[inner])

        rows = []
        for row, (i, j) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            own = found[first[row]:first[row + 1]]
            n = int(lines[first[row + 1]] - lines[first[row]]) + (i < j and raw[j - 1] != NEWLINE)
            h = draws[row].tolist()
            if i == j or h[2] % 100 >= rate or any(s.marked for s in own) or any(
                    across(x.content, y.content, raw_marks) for x, y in zip(own, own[1:])):
                rows.append((n, "plain", None, None, raw[i:j]))
                continue
            low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            (a, a_points), (b, b_points) = cut(row, low), cut(row, high)
            form = "spm" if h[3] % 100 < spm_rate else "psm"
            rows.append((n, form, a_points, b_points - a_points, rearranged(raw[i:a], raw[a:b], raw[b:j], form, raw_marks)))
        n, form, prefix, middle, output = zip(*rows)
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
            pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), seeds(doc_id, seed).alias("draws"))
    return rows.mapInArrow(run, OUT_SCHEMA)


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output was made of.  No part holds a mark, so the marks part the output alone."""
    parts = F.split(output, "|".join(re.escape(m) for m in marks))
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
