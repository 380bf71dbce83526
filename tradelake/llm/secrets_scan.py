"""Secrets in texts: fixed patterns, and random strings by the characters a token holds.

A vocabulary of byte pairs learned on text needs few tokens for words and many for random
strings, so a long run of key characters with few characters per token is reported, unless it is
something known that looks random: a digest in hex, a UUID, a number, or a name put together of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import bpe
from tradelake.llm import bytetext as bt
from tradelake.llm.ship import ship

# The patterns of the base scan, their order, and the least length of what they find
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
# Lengths in hex of MD5, SHA-1 and the SHA-2 family
DIGESTS = (32, 40, 56, 64, 96, 128)

LEAST_RUN = 20
PER_TOKEN = 2.2
WORD = 4
UUID = re.compile(rb"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
LABELLED_DIGEST = re.compile(rb"(md5|sha1|sha224|sha256|sha384|sha512)[-=_][A-Za-z0-9+/_=-]+", re.IGNORECASE)
HEX = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
PARTS = re.compile(rb"[+/_=-]+")
PART = re.compile(rb"[A-Za-z]*[0-9]*")
WORDS = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
OUT_SCHEMA = "doc_id long, spans array<struct<kind: string, start: long, end: long, per_token: double>>"


def table_of(characters: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters.encode())] = True
    return table


DIGITS, SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
HEX_TABLE = table_of(DIGITS + "abcdef")
ACCESS_TABLE = table_of(DIGITS + SMALL.upper())
KEY_TABLE = table_of(DIGITS + SMALL + SMALL.upper() + "+/_=-")


def known(run: bytes) -> bool:
    """A digest, a UUID, a number with or without signs, or a name: what looks random and is no secret.

    A name consists of parts between signs, each of words, then digits.  Its words have ``WORD`` letters on
    average, and it has no more digits than letters, unless it has no letters at all.
    """
    bare = run.strip(b"+/_=-")
    if UUID.fullmatch(bare) or LABELLED_DIGEST.fullmatch(run) or (len(bare) in DIGESTS and HEX.fullmatch(bare)):
        return True
    parts = PARTS.split(bare)
    words = WORDS.findall(bare)
    letters = sum(map(len, words))
    digits = sum(map(len, parts)) - letters
    return all(PART.fullmatch(p) for p in parts) and letters >= WORD * len(words) and (not words or digits <= letters)


def long_runs(table: np.ndarray, data: np.ndarray, offsets: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """The maximal runs of a class of characters that are long enough and lie in one text."""
    starts, ends, _ = bt.runs(table[data], offsets)
    keep = ends - starts >= least
    return zip(starts[keep].tolist(), ends[keep].tolist())


def scan_column(column: pa.Array, words: bpe.Vocabulary, least_run: int = LEAST_RUN, per_token: float = PER_TOKEN):
    """(row, kind, start, end, characters per token) of all spans, in the order of rows, starts and kinds;
    places are code points of the row's text."""
    data, offsets = bt.text_bytes(column)
    raw = data.tobytes()
    found = []
    for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        found += [(m.start(), m.end(), 0, None) for m in ASSIGN.finditer(raw, i, j) if m.end(2) - m.start(2) >= LEAST_VALUE]
    for i, j in long_runs(ACCESS_TABLE, data, offsets, LEAST_ACCESS):
        at = raw.find(b"AKIA", i, j - 1)
        if at >= 0 and j - at >= LEAST_ACCESS:
            found.append((at, j, 1, None))
    found += [(i, j, 2, None) for i, j in long_runs(HEX_TABLE, data, offsets, LEAST_HEX)]
    runs = [(i, j) for i, j in long_runs(KEY_TABLE, data, offsets, least_run) if not known(raw[i:j])]
    if runs:
        _, ends = words.encode_column(pa.array([raw[i:j].decode() for i, j in runs], pa.string()))
        for (i, j), tokens in zip(runs, np.diff(ends).tolist()):
            if j - i < per_token * tokens:
                found.append((i, j, 3, (j - i) / tokens))
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    out = []
    for i, j, kind, ratio in sorted(found, key=lambda f: (f[0], f[2])):
        row = int(np.searchsorted(offsets, i, "right")) - 1
        base = points[offsets[row]]
        out.append((row, KINDS[kind], int(points[i] - base), int(points[j] - base), ratio))
    return out


def secrets(docs: DataFrame, ranks_path: str, least_run: int = LEAST_RUN, per_token: float = PER_TOKEN) -> DataFrame:
    """The spans of each text that look like secrets.

    Returns per row of ``docs``: doc_id and the spans (kind, start, end in code points, end exclusive; characters
    per token of those found by the vocabulary), by start and then kind.  The kinds ``assign``, ``access`` and
    ``hex`` are the base scan; ``random`` are maximal runs of at least ``least_run`` letters, digits and ``+/_=-``
    that hold fewer than ``per_token`` characters per token and are nothing known.  Kinds may overlap.  A
    null or empty text has no spans; each row is worked on by itself, and other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    lines = spark.sparkContext.broadcast(bpe.read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in bt.portions(batches, "text"):
            words = words or bpe.vocabulary(lines.value)
            spans = [[] for _ in range(batch.num_rows)]
            for row, kind, start, end, ratio in scan_column(batch.column(1), words, least_run, per_token):
                spans[row].append({"kind": kind, "start": start, "end": end, "per_token": ratio})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPANS)], ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, OUT_SCHEMA)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("per_token", pa.float64())]))


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_of(spans: Column) -> Column:
    """The spans of the base scan."""
    return F.filter(spans, lambda s: s["kind"] != "random")
