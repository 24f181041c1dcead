"""NumPy helpers that the operators share inside their tasks.

Everything here works on one Arrow batch; Spark decides what a batch holds.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE_BYTES = (9, 10, 11, 12, 13, 32)


def mix64(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def chain64(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix64(left * _ODD + right)


# One random 64-bit number for each byte value, and powers of an odd base with
# their inverses: a word's hash does not depend on where the word stands.
BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = 0xD1342543DE82EF95
_UNBASE = pow(_BASE, -1, 1 << 64)
_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        _POWERS["n"] = size
    return _POWERS["up"], _POWERS["down"]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans [start, end) of an array of byte codes."""
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mix64(spans + (ends - starts).astype(np.uint64) * _ODD)


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_CODES = BYTE_CODES[_LOWER]
# Kinds of bytes: 0 separates tokens, runs of one other kind are tokens.
WORDS = np.ones(256, np.uint8)
WORDS[list(_SPACE_BYTES)] = 0
WORDS_AND_MARKS = WORDS * np.uint8(2)
for _byte in range(0x80):
    if WORDS[_byte] and not chr(_byte).isalnum():
        WORDS_AND_MARKS[_byte] = 1


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = WORDS, most: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of every row, A-Z lower-cased, and n + 1 offsets into them.

    By default a token is a run of bytes other than space and U+0009 to U+000D.
    `most` hashes only so many first bytes of each.  Works in pieces of about
    CHUNK_BYTES that end at a token's end.
    """
    kind = kinds[data]
    first = kind > 0
    last = first.copy()
    first[1:] &= kind[1:] != kind[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    first[row_starts] = kind[row_starts] > 0
    last[:-1] &= (kind[1:] != kind[:-1]) | first[1:]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    if most is not None:
        ends = np.minimum(ends, starts + most)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, begin + CHUNK_BYTES, side="right")))
        end = ends[stop - 1]
        hashes[at:stop] = span_hashes(
            _LOWER_CODES[data[begin:end]], starts[at:stop] - begin, ends[at:stop] - begin
        )
        at = stop
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of size words of one array (empty if it is shorter)."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - size + 1]
    for k in range(1, size):
        out = chain64(out, words[k : len(words) - size + 1 + k])
    return out


def gather_ragged(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """pool[s : s + n] for every (s, n), joined."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return pool[:0]
    index = np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)
    return pool[index]


def row_slices(offsets: np.ndarray, most: int = 2 * CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `most` bytes together, or of one longer row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, stop
        at = stop


def crc_remainder(ids: pa.Array | pa.ChunkedArray, modulus: int) -> np.ndarray:
    """crc32 of each id's decimal text modulo a number; -1 where the id is null."""
    import zlib

    return np.fromiter(
        (-1 if i is None else zlib.crc32(b"%d" % i) % modulus for i in ids.to_pylist()),
        np.int64,
        len(ids),
    )


def local_path(path: str) -> str:
    """The POSIX path of a folder on a file system that all machines mount."""
    scheme, colon, rest = path.partition(":")
    if not colon or os.sep in scheme:
        return path
    if scheme != "file":
        raise ValueError(f"memory mapping needs a mounted file system, not {scheme}:")
    return "/" + rest.lstrip("/")
