"""Vectorised work on the UTF-8 bytes of a column of texts, for use inside Spark tasks.

All functions take whole columns at once: the texts of a batch lie one after the
other in one byte array, and words, windows and hashes are arrays over it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_2 = 0xD6E8FEB86659FD93 | 1
MASK64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over 64 output bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets between them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def portions(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` text bytes each (one row at least), so that
    the arrays built over a portion stay small whatever the batch size is."""
    for batch in batches:
        offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))[1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all ranges [start, start + length), one range after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)


PRIME = (1 << 61) - 1
SEGMENT, LONG_RANGE = 1 << 16, 1 << 14
_POWERS: dict[tuple[int, bool], np.ndarray] = {}
_WRAPPED: dict[bool, np.ndarray] = {}
SHORT = 32


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & U64(PRIME)) + (x >> U64(61))
    return x - U64(PRIME) * (x >= U64(PRIME))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2 ** 61 - 1, for numbers below it."""
    ah, al, bh, bl = a >> U64(31), a & U64(0x7FFFFFFF), b >> U64(31), b & U64(0x7FFFFFFF)
    middle = ah * bl + al * bh
    return _reduced(((ah * bh) << U64(1)) + (middle >> U64(30)) + ((middle & U64((1 << 30) - 1)) << U64(31)) + _reduced(al * bl))


def powers(n: int, base: int = BASE, inverse: bool = False) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 61 - 1; the inverse powers if asked for."""
    have = _POWERS.get((base, inverse))
    if have is None or len(have) < n:
        step = pow(base, -1, PRIME) if inverse else base % PRIME
        have = np.ones(1, U64) if have is None else have
        while len(have) < max(n, 1 << 16):
            have = np.concatenate((have, times(have, U64(pow(step, len(have), PRIME)))))
        _POWERS[base, inverse] = have
    return have[:n]


def wrapped_powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE ** 0 .. BASE ** (n - 1) modulo 2 ** 64; the inverse powers if asked for."""
    have = _WRAPPED.get(inverse)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), pow(BASE, -1, 1 << 64) if inverse else BASE, U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        if n <= 1 << 23:
            _WRAPPED[inverse] = have
    return have[:n]


class Rolling:
    """Prefix sums modulo 2 ** 64, cheap enough for a hash at every byte.  There are texts that collide, so it may only
    propose: places to cut, keys to bring together what is compared later."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        self.sums = np.zeros(self.n + 1, U64)
        np.cumsum((data.astype(U64) + U64(1)) * wrapped_powers(self.n), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Unmixed hashes of the ranges [start, end); equal bytes give equal hashes."""
        return (self.sums[ends] - self.sums[starts]) * wrapped_powers(self.n + 1, True)[starts]

    def every(self, k: int) -> np.ndarray:
        """The hash of the k bytes from each position on, as far as there are k."""
        m = max(0, self.n - k + 1)
        return (self.sums[k:k + m] - self.sums[:m]) * wrapped_powers(self.n + 1, True)[:m]


def unlike(data: np.ndarray, begin: np.ndarray, end: np.ndarray, chief: np.ndarray) -> np.ndarray:
    """The ranges whose bytes differ from those of their representative, which is another range."""
    size = end - begin
    differ = size != size[chief]
    same = np.flatnonzero(~differ & (chief != np.arange(len(chief))))
    whole, same = same[size[same] > SHORT], same[size[same] <= SHORT]
    # short ranges byte by byte over all of them, and what is longer as a whole
    for k in range(int(size[same].max(initial=0))):
        same = same[size[same] > k] if k else same
        differ[same] |= data[begin[same] + k] != data[begin[chief[same]] + k]
    if len(whole):
        raw = data.tobytes()
        differ[whole] = [raw[i:j] != raw[k:n] for i, j, k, n in zip(
            begin[whole].tolist(), end[whole].tolist(), begin[chief[whole]].tolist(), end[chief[whole]].tolist())]
    return np.flatnonzero(differ)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASE) -> np.ndarray:
    """Unmixed Rabin-Karp hashes of the ranges [start, end), which are in order; equal bytes give equal hashes.

    Modulo a power of two there are texts that collide for every base; modulo a prime two given ranges
    of n bytes collide for n of all bases at most.  The sums are built over one segment at a time, which fits a
    processor's cache; a range longer than ``LONG_RANGE`` has a digest in place of a sum.
    """
    out = np.empty(len(starts), U64)
    size, i = ends - starts, 0
    while i < len(starts):
        j = int(np.searchsorted(starts, starts[i] + SEGMENT))
        short = np.flatnonzero(size[i:j] <= LONG_RANGE) + i
        if len(short):
            at = starts[short[0]]
            out[short] = _summed(data[at:ends[short].max()], starts[short] - at, ends[short] - at, base)
        for k in (np.flatnonzero(size[i:j] > LONG_RANGE) + i).tolist():
            digest = blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8, salt=base.to_bytes(8, "little")).digest()
            out[k] = int.from_bytes(digest, "little") % PRIME
        i = j
    return out


def _summed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    power, value = powers(len(data), base), data.astype(U64) + U64(1)
    low, high = np.zeros(len(data) + 1, U64), np.zeros(len(data) + 1, U64)
    np.cumsum(value * (power & U64(0xFFFFFFFF)), out=low[1:])
    np.cumsum(value * (power >> U64(32)), out=high[1:])
    low, high = low[ends] - low[starts], high[ends] - high[starts]
    high = (high >> U64(29)) + ((high & U64((1 << 29) - 1)) << U64(32))
    return times(_reduced(_reduced(low) + _reduced(high)), powers(len(data) + 1, base, True)[starts])


@lru_cache(None)
def space_table() -> np.ndarray:
    """True for the bytes that part words: space, and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


@lru_cache(None)
def sign_table() -> np.ndarray:
    """True for all of ASCII but letters and digits."""
    table = np.zeros(256, bool)
    table[:128] = True
    table[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"]] = False
    return table


class Words:
    """The words of a column of texts: runs of bytes that are no gaps, by default no white space.
    ``lower`` turns A-Z into lower case.

    ``starts`` and ``ends`` are byte positions, ``doc`` is the row of each word, and the words
    of row i are numbers ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, gaps: np.ndarray | None = None, lower: bool = False):
        self.data, self.offsets = text_bytes(column)
        if lower:
            self.data = self.data + np.uint8(32) * ((self.data >= 65) & (self.data <= 90))
        n, rows = len(self.data), len(self.offsets) - 1
        inside = ~(space_table() if gaps is None else gaps)[self.data]
        edge = np.empty(n, bool)
        if n:
            edge[0] = inside[0]
            np.logical_and(inside[1:], ~inside[:-1], out=edge[1:])
            own = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
            edge[own] = inside[own]  # a text's first byte may begin a word
        self.starts = np.flatnonzero(edge)
        last = np.empty(n, bool)
        if n:
            last[-1] = inside[-1]
            np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
            own = self.offsets[1:][self.offsets[:-1] < self.offsets[1:]] - 1
            last[own] = inside[own]
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.doc = np.repeat(np.arange(rows), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, base: int = BASE) -> np.ndarray:
        return mix(range_hashes(self.data, self.starts, self.ends, base))

    def windows(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words of one text, and the windows' hashes."""
        h = self.hashes() if hashes is None else hashes
        m = len(h) - k + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        rolling = np.zeros(m, U64)
        for i in range(k):
            rolling *= U64(BASE)
            rolling += h[i:i + m]
        whole = np.flatnonzero(self.doc[:m] == self.doc[k - 1:])
        return whole, mix(rolling[whole])

    def join(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The kept words of each text joined by one space: bytes and offsets."""
        rows = len(self.offsets) - 1
        doc = self.doc[keep]
        sizes = self.ends[keep] - self.starts[keep]
        lengths = sizes + 1
        tail = np.ones(len(doc), bool)
        if len(doc):
            tail[:-1] = doc[1:] != doc[:-1]
        lengths[tail] -= 1
        at = np.cumsum(lengths)
        out = self.data[np.minimum(ranges(self.starts[keep], lengths), max(0, len(self.data) - 1))] if len(doc) else np.zeros(0, np.uint8)
        out[at[~tail] - 1] = 0x20
        per_row = np.bincount(doc, weights=lengths, minlength=rows).astype(np.int64)
        return out, np.concatenate(([0], np.cumsum(per_row)))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """True where one of the ranges [start, start + length) lies, over n positions."""
    edges = np.zeros(n + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + length, n), -1)
    return np.cumsum(edges[:n]) > 0


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross an offset: starts, ends, and first run per row."""
    n = len(mask)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], mask[:-1])) if n else mask
    starts = np.flatnonzero(mask & (~before | cut[:n]))
    after = np.concatenate((mask[1:], [False])) if n else mask
    ends = np.flatnonzero(mask & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def string_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow array over bytes and offsets."""
    kind = kind or pa.string()
    wide = pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)
    where = pa.py_buffer(np.ascontiguousarray(offsets, np.int64 if wide else np.int32))
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, where, pa.py_buffer(np.ascontiguousarray(data))])


def span_lists(starts: np.ndarray, ends: np.ndarray, first: np.ndarray, shift: np.ndarray) -> pa.Array:
    """One list of (start, end) per row, counted from the row's own beginning."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pair = pa.StructArray.from_arrays(
        [pa.array(starts - shift[row], pa.int64()), pa.array(ends - shift[row], pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pair)


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as byte planes, so that the planes of small numbers compress away."""
    return np.ascontiguousarray(values.astype(U64, copy=False).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(U64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit integers as packed differences."""
    steps = values.astype(U64, copy=True)
    steps[1:] -= values[:-1]
    return pack(steps)


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=U64)
