"""Byte-level BPE: encoding by a monoid tree reduction, decoding by concatenation.

The encodings of two neighbouring pieces of bytes combine into the encoding of the whole, so a
piece is encoded in halves.  Where the halves meet, a window of tokens on both sides is encoded
anew and grown until the token left of it and its first token, and its last token and the token
right of it, are pairs that BPE itself would leave apart.  A row of tokens whose
neighbours are all such pairs is the one encoding of its bytes, so nothing outside can change.

The text is cut by the tokenizer's pattern first, and tokens never cross its matches: there
neighbours combine by concatenation.  Equal matches of a portion of texts are encoded once.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm.ship import ship

LEAF = 8
REMEMBERED = 1 << 19
LETTER, NUMBER, SPACE, OTHER = range(4)
# White space as the pattern's \s understands it
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Endings that follow an apostrophe as a match of their own
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")
OUT_SCHEMA = "doc_id long, tokens array<int>, n_tokens long, ids_sha256 string, decoded binary"


@lru_cache(None)
def kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        major = unicodedata.category(chr(c))[0]
        if major == "L":
            table[c] = LETTER
        elif major == "N":
            table[c] = NUMBER
    table[WHITE] = SPACE
    return table


def match_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin, for the code points of texts that lie between offsets.

    Letters, numbers and others form runs; of white space before something else the last
    character stands apart, and joins what follows if it is a plain space; an apostrophe that no
    other sign or space adjoins takes a short ending with it.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds()[points]
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    ends = begins[1:]
    start = begins[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~ends[:-1])
    start[blank] = True
    start[blank[points[blank] == 0x20] + 1] = False
    mark = np.flatnonzero((points == ord("'")) & start)
    mark = mark[~ends[mark]]
    mark = mark[kind[mark + 1] == LETTER]
    one = mark[np.isin(points[mark + 1], [ord(c) for c in SHORT_ENDINGS])]
    two = mark[~ends[mark + 1]]
    two = two[np.isin(points[two + 1] * 0x200000 + points[np.minimum(two + 2, n - 1)],
                      [ord(a) * 0x200000 + ord(b) for a, b in LONG_ENDINGS])]
    start[one + 1] = start[two + 1] = False
    for at, length in ((one, 2), (two, 3)):
        after = at + length
        start[after[after < n]] = True
    return np.flatnonzero(start)


class Vocabulary:
    """The ranks of a file of lines "base64 rank", and the tree reduction over them."""

    def __init__(self, lines: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines()) if a}
        size = max(self.ranks.values()) + 1
        pieces = [b""] * size
        for token, rank in self.ranks.items():
            pieces[rank] = token
        self.pieces = pieces
        lengths = np.array([len(p) for p in pieces], np.int64)
        self.lengths, self.ends = lengths, np.cumsum(lengths)
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.apart: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Plain BPE: again and again the pair of least rank, the leftmost of equals, is joined."""
        ranks, parts = self.ranks, [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def stays_apart(self, a: int, b: int) -> bool:
        """Whether BPE of the two tokens' bytes gives the two tokens."""
        found = self.apart.get((a, b))
        if found is None:
            if len(self.apart) > REMEMBERED:
                self.apart.clear()
            found = self.apart[a, b] = self.merge(self.pieces[a] + self.pieces[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings."""
        if not left or not right or self.stays_apart(left[-1], right[0]):
            return left + right
        i, j, grow = 1, 1, 1
        while True:
            window = self.merge(b"".join([self.pieces[t] for t in (*left[-i:], *right[:j])]))
            fine_left = i >= len(left) or self.stays_apart(left[-i - 1], window[0])
            fine_right = j >= len(right) or self.stays_apart(window[-1], right[j])
            if fine_left and fine_right:
                return left[:max(0, len(left) - i)] + window + right[j:]
            i = min(len(left), i + (0 if fine_left else grow))
            j = min(len(right), j + (0 if fine_right else grow))
            grow *= 2

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """The tokens of one match of the pattern; a match that is a token is that token."""
        found = self.known.get(piece)
        if found is None:
            whole = self.ranks.get(piece)
            found = (whole,) if whole is not None else tuple(self.tree(piece))
            if len(piece) <= 64:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                self.known[piece] = found
        return found

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts one after the other, and the n + 1 offsets between them."""
        data, offsets = bt.text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each code point
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = match_starts(points, np.searchsorted(lead, offsets))
        begin = lead[starts]
        end = np.append(begin[1:], len(data))
        hashes = bt.mix(bt.Rolling(data).of(begin, end) ^ bt.mix((end - begin).astype(bt.U64)))
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        chief = order[new]
        # the hash only proposes: a match that differs from its representative is encoded by itself
        other = np.setdiff1d(bt.unlike(data, begin, end, chief[number]), chief)
        number[other] = len(chief) + np.arange(len(other))
        chief = np.concatenate((chief, other))
        raw = data.tobytes()
        encoded = [self.encode(raw[i:j]) for i, j in zip(begin[chief].tolist(), end[chief].tolist())]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((t for e in encoded for t in e), np.uint32, int(sizes.sum()))
        at = np.cumsum(sizes) - sizes
        lengths = sizes[number]
        tokens = flat[bt.ranges(at[number], lengths)]
        before = np.concatenate(([0], np.cumsum(lengths)))
        return tokens, before[np.searchsorted(begin, offsets)]

    def decode(self, tokens: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after the other."""
        tokens = tokens.astype(np.int64)
        lengths = self.lengths[tokens]
        return self.data[bt.ranges(self.ends[tokens] - lengths, lengths)]


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(lines: bytes) -> Vocabulary:
    """The vocabulary of these lines, built once per Python worker."""
    key = hashlib.sha256(lines).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(lines)
    return _LOADED[key]


def read_ranks(path: str) -> bytes:
    """The rank file, read where the job is started: a vocabulary is a megabyte, whatever the input."""
    with open(path, "rb") as file:
        return file.read()


def encode_decode(docs: DataFrame, ranks_path: str, with_tokens: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Encodes each text and decodes its tokens again.

    Returns per row of ``docs``: doc_id, the tokens (null unless ``with_tokens``), their number, the
    SHA-256 of the tokens as little-endian 32-bit numbers, and the decoded bytes.  A null is an
    empty text and has no tokens.  Each row is worked on by itself: ties and repeated rows have
    equal results, and other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    lines = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        for batch in bt.portions(batches, "text"):
            words = words or vocabulary(lines.value)
            tokens, offsets = words.encode_column(batch.column(1))
            decoded = words.decode(tokens)
            ends = np.concatenate(([0], np.cumsum(words.lengths[tokens.astype(np.int64)])))[offsets]
            raw = tokens.astype("<u4").tobytes()
            at = (offsets * 4).tolist()
            own = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens.view(np.int32)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), own if with_tokens else pa.nulls(batch.num_rows, own.type),
                pa.array(np.diff(offsets)),
                pa.array([hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(at[:-1], at[1:])], pa.string()),
                bt.string_array(decoded, ends, pa.binary()), *(batch.column(2 + i) for i in range(len(carry)))],
                ["doc_id", "tokens", "n_tokens", "ids_sha256", "decoded", *carried])

    carried = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *(F.col(c).alias(own) for c, own in zip(carry, carried)))
    schema = ", ".join([OUT_SCHEMA, *(f"{own} {docs.schema[c].dataType.simpleString()}" for c, own in zip(carry, carried))])
    return rows.mapInArrow(run, schema).withColumnsRenamed(dict(zip(carried, carry)))
